"""Type 2 ticker dimension: first load, merge, loads out of order, whole history, and a check of its invariants."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barlake.operators.surrogate import dense_ids
from barlake.schemas import DIM_TICKER, OPEN_END, TRACKED
from barlake.session import store

RunDate = Column | str | None


def _day(run_date: RunDate) -> Column:
    if run_date is None:
        return F.current_date()
    return (run_date if isinstance(run_date, Column) else F.lit(run_date)).cast("date")


def _as_dimension(versions: DataFrame) -> DataFrame:
    return versions.select(*[F.col(name).cast(kind) for name, kind in DIM_TICKER.items()])


def initial(incoming: DataFrame, run_date: RunDate = None) -> DataFrame:
    """First load: every ticker becomes a current version, keys 1..n in symbol order."""
    opened = incoming.select(
        "symbol",
        *TRACKED,
        _day(run_date).alias("effective_from"),
        F.lit(OPEN_END).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    return _as_dimension(dense_ids(opened, "symbol", "ticker_key"))


def merge(existing: DataFrame, incoming: DataFrame, run_date: RunDate = None) -> DataFrame:
    """Fold one row per symbol of fresh attributes into the dimension.

    One full outer join of the current versions with ``incoming`` on symbol decides every case, and
    each joined pair unfolds into the versions it leaves behind:

    * absent or unchanged symbol -> the old version as it is
    * changed attributes (NULL-safe) -> the old version closed on ``run_date`` and a fresh one
    * new symbol -> a fresh version

    What the pairs leave behind is stored once; rows that stay and rows to be numbered are read from there.
    Fresh versions get keys above the highest existing one, in symbol order. Closed history is kept. A run
    date before the newest version would turn intervals around; it raises (``merge_between`` takes such loads).
    """
    newest = existing.agg(F.max("effective_from")).scalar()
    backdated = F.raise_error(F.lit("the run date lies before the newest version")).cast("date")
    day = F.when(newest > _day(run_date), backdated).otherwise(_day(run_date))
    old = existing.where("is_current").select(
        F.col("symbol"), F.struct(*DIM_TICKER).alias("old")
    )
    new = incoming.select(F.col("symbol"), F.struct("symbol", *TRACKED).alias("new"))
    pairs = old.join(new, "symbol", "full_outer")

    same = reduce(and_, [F.col(f"old.{a}").eqNullSafe(F.col(f"new.{a}")) for a in TRACKED])
    replaced = F.col("old").isNotNull() & F.col("new").isNotNull() & ~same
    kept = F.struct(
        *[F.col(f"old.{c}").alias(c) for c in ("ticker_key", "symbol", *TRACKED, "effective_from")],
        F.when(replaced, day).otherwise(F.col("old.effective_to")).alias("effective_to"),
        (~replaced).alias("is_current"),
    )
    fresh = F.struct(
        F.lit(None).cast("int").alias("ticker_key"),
        *[F.col(f"new.{c}").alias(c) for c in ("symbol", *TRACKED)],
        day.alias("effective_from"),
        F.lit(OPEN_END).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    left_behind = F.array_compact(
        F.array(
            F.when(F.col("old").isNotNull(), kept),
            F.when(F.col("old").isNull() | replaced, fresh),
        )
    )
    versions = store(pairs.select(F.inline(left_behind)))

    top = existing.agg(F.coalesce(F.max("ticker_key"), F.lit(0))).scalar()
    unkeyed = versions.where("ticker_key IS NULL").drop("ticker_key")
    keyed = dense_ids(unkeyed, "symbol", "ticker_key", start=top)
    parts = [existing.where("NOT is_current"), versions.where("ticker_key IS NOT NULL"), keyed]
    return reduce(DataFrame.unionByName, map(_as_dimension, parts))


def _attrs() -> Column:
    return F.struct(*TRACKED)


def _islands(pieces: DataFrame, touching: Column) -> DataFrame:
    """``pieces`` with ``_island``, which counts up where a version begins: at a symbol's first piece, at other
    attributes, and where ``touching`` says that a piece does not follow the one before at once."""
    along = W.partitionBy("symbol").orderBy("effective_from", "effective_to")
    same = _attrs().eqNullSafe(F.lag(_attrs()).over(along)) & F.coalesce(touching, F.lit(False))
    begins = pieces.withColumn("_begins", F.coalesce(~same, F.lit(True)).cast("int"))
    return begins.withColumn("_island", F.sum("_begins").over(along.rowsBetween(W.unboundedPreceding, 0)))


def history(observed: DataFrame) -> DataFrame:
    """The dimension that loads on every day of ``observed(symbol, date, *TRACKED)`` leave behind, in one pass.

    ``observed`` has one row per symbol and day at most: the attributes seen that day. Days on which a symbol
    is not seen change nothing. Equal attributes on days that follow each other are one version, which ends
    where the next one begins. Keys are dense in the order of first day and symbol, as loads day by day give
    them. A symbol's days are one window, so its part is bounded by the calendar.
    """
    along = W.partitionBy("symbol").orderBy("date")
    seen = observed.where(F.col("symbol").isNotNull() & F.col("date").isNotNull())
    before = F.lag(F.struct(_attrs().alias("attrs"))).over(along)
    starts = seen.withColumn("_before", before)
    starts = starts.where(F.col("_before").isNull() | ~_attrs().eqNullSafe(F.col("_before.attrs")))
    following = F.lead("date").over(along)
    versions = starts.select(
        "symbol", *TRACKED, F.col("date").alias("effective_from"),
        F.coalesce(following, F.lit(OPEN_END).cast("date")).alias("effective_to"), following.isNull().alias("is_current"),
    )
    return _as_dimension(dense_ids(store(versions), ["effective_from", "symbol"], "ticker_key"))


def merge_between(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Fold attributes that held from ``valid_from`` until ``valid_to`` into the dimension.

    ``incoming(symbol, *TRACKED, valid_from, valid_to)`` has one row per symbol; the interval is half-open and not
    empty. Versions of a symbol are cut at both ends of its interval, what lies between them is replaced,
    and pieces that touch and have equal attributes become one version again. Symbols that are not in
    ``incoming`` stay as they are.

    A version keeps its key as long as it keeps its first day, also if that day's attributes are replaced, and
    so does what is left of it when its first days are cut off: facts that carry a key stay right outside the
    interval. Other pieces get keys above the highest, in the order of first day and symbol. Versions of
    no length stay, unless they lie within the interval.
    """
    held = [F.col(a).alias(f"_new_{a}") for a in TRACKED]
    new = incoming.select(F.col("symbol").alias("_symbol"), "valid_from", "valid_to", *held)
    joined = existing.join(new, F.col("symbol") == F.col("_symbol"), "left")
    since, until = F.col("effective_from"), F.col("effective_to")
    begin, end = F.col("valid_from"), F.col("valid_to")
    empty, untouched = since == until, F.col("_symbol").isNull()
    whole = untouched | (empty & ((since < begin) | (since >= end)))

    def piece(key: Column, first: Column, last: Column, attrs: str = "") -> Column:
        return F.struct(
            key.alias("ticker_key"), "symbol", *[F.col(attrs + a).alias(a) for a in TRACKED], first.alias("effective_from"),
            last.alias("effective_to"), (~untouched).alias("_touched"),
        )

    key = F.col("ticker_key")
    pieces = F.array_compact(F.array(
        F.when(whole, piece(key, since, until)),
        F.when(~whole & ~empty & (since < begin), piece(key, since, F.least(until, begin))),
        F.when(~whole & ~empty & (since == begin), piece(key, begin, end, "_new_")),  # the new version, under its key
        F.when(~whole & ~empty & (until > end), piece(F.when(since > begin, key), F.greatest(since, end), until)),
    ))
    fresh = incoming.select(
        F.lit(None).cast("int").alias("ticker_key"), "symbol", *TRACKED, F.col("valid_from").alias("effective_from"),
        F.col("valid_to").alias("effective_to"), F.lit(True).alias("_touched"),
    )
    cut = store(joined.select(F.inline(pieces)).unionByName(fresh))

    along = W.partitionBy("symbol").orderBy("effective_from", "effective_to")
    again = _islands(cut.where("_touched"), F.col("effective_from") <= F.lag("effective_to").over(along))
    first = F.struct("effective_from", "effective_to")
    again = again.groupBy("symbol", "_island").agg(
        F.min_by("ticker_key", F.when(F.col("ticker_key").isNotNull(), first)).alias("ticker_key"),
        *[F.min_by(c, first).alias(c) for c in TRACKED],
        F.min("effective_from").alias("effective_from"), F.max("effective_to").alias("effective_to"),
    )
    current = (F.col("effective_to") == F.lit(OPEN_END).cast("date")).alias("is_current")
    again = store(again.select("ticker_key", "symbol", *TRACKED, "effective_from", "effective_to", current))
    top = existing.agg(F.coalesce(F.max("ticker_key"), F.lit(0))).scalar()
    unkeyed = again.where("ticker_key IS NULL").drop("ticker_key")
    keyed = dense_ids(unkeyed, ["effective_from", "symbol"], "ticker_key", start=top)
    rest = cut.where("NOT _touched").select("*", current)
    parts = [rest, again.where("ticker_key IS NOT NULL"), keyed]
    return reduce(DataFrame.unionByName, map(_as_dimension, parts))


def merge_late(existing: DataFrame, incoming: DataFrame, loads: DataFrame, run_date: RunDate) -> DataFrame:
    """Fold in a load of ``incoming(symbol, *TRACKED)`` that belongs to ``run_date``, whatever has been loaded since.

    ``loads(symbol, load_date)`` lists what other loads have seen, also where that changed nothing. The attributes
    hold from the run date until the symbol is seen again. So loads in any order leave the versions that the
    same loads leave in order, and that ``history`` finds in one pass (keys follow the order of loading). A
    load for a day that has one already takes its place.
    """
    day = _day(run_date)
    later = loads.where(F.col("load_date") > day).groupBy("symbol").agg(F.min("load_date").alias("_next"))
    dated = incoming.join(later, "symbol", "left").select(
        "symbol", *TRACKED, day.alias("valid_from"),
        F.coalesce("_next", F.lit(OPEN_END).cast("date")).alias("valid_to"),
    )
    return merge_between(existing, dated)


def violations(dim: DataFrame) -> DataFrame:
    """Symbols that break the dimension: more than one current version, or overlapping intervals."""
    by_start = W.partitionBy("symbol").orderBy("effective_from", "effective_to")
    overlap = F.lead("effective_from").over(by_start) < F.col("effective_to")
    flagged = dim.select("symbol", "is_current", F.coalesce(overlap, F.lit(False)).alias("overlap"))
    return (
        flagged.groupBy("symbol")
        .agg(F.count_if("is_current").alias("current_versions"), F.count_if("overlap").alias("overlapping"))
        .where("current_versions > 1 OR overlapping > 0")
    )

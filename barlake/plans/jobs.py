"""Batch jobs: bronze -> silver -> gold -> warehouse, run in that order."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions import calendar_date
from barlake.operators import scd2
from barlake.operators.bars import latest_bar, shape_contract, to_event_json
from barlake.operators.calendar import dim_date
from barlake.operators.dedup import clean
from barlake.operators.facts import fact_daily
from barlake.operators.partials import changed, daily_partials
from barlake.operators.replay import RECORD, accepted, still_rejected
from barlake.operators.tickers import Names, latest_attrs, seen_attrs
from barlake.operators.validation import error_reason
from barlake.plans.analytics import Star
from barlake.schemas import COMPANY_NAMES, FACT, GOLD_TABLES, NATURAL_KEY, ddl
from barlake.session import ensure_checkpoint_dir, store, tasks_sized_for
from barlake.sources import lake
from barlake.sources.jdbc import Warehouse, load_table


@dataclass(frozen=True)
class Layers:
    bronze: str
    silver: str
    gold: str

    @property
    def dim_date(self) -> str:
        return f"{self.gold}/dim_date"

    @property
    def dim_ticker(self) -> str:
        return f"{self.gold}/dim_ticker"

    @property
    def fact(self) -> str:
        return f"{self.gold}/fact_daily_prices"

    @property
    def star(self) -> str:
        """What readers see: snapshots of calendar and dimension, and for each day the run that wrote its facts."""
        return f"{self.gold}/star"

    @property
    def attributes(self) -> str:
        """Ticker attributes seen on each date."""
        return f"{self.gold}/ticker_attributes"

    @property
    def loads(self) -> str:
        """Symbols that each load has seen, by run date."""
        return f"{self.gold}/ticker_loads"

    @property
    def stale(self) -> str:
        """Run date of a late load whose facts may not be refreshed yet; empty if there is none."""
        return f"{self.gold}/fact_stale"

    @property
    def partials(self) -> str:
        """Partial sums of the daily bars, by load."""
        return f"{self.gold}/daily_partials"

    @property
    def fact_state(self) -> str:
        """Highest ticker key that the whole fact takes into account."""
        return f"{self.gold}/fact_state"


def checked_dates(spark: SparkSession, layers: Layers, dates: Iterable[str] | None) -> list[str] | None:
    """``dates`` as a list. A text that is no ISO date (yyyy-mm-dd) is a mistake, unless a bronze or
    silver partition has just that name."""
    if dates is None:
        return None
    dates = list(dates)
    for date in dates:
        stored = any(
            lake.exists(spark, lake.partition_path(spark, layer, "date", date)) for layer in (layers.bronze, layers.silver)
        )
        if not stored and not _is_date(date):
            raise ValueError(f"{date!r} is neither a date (yyyy-mm-dd) nor a stored partition")
    return dates


def refine_silver(
    spark: SparkSession, layers: Layers, dates: Iterable[str] | None = None
) -> dict[str, int]:
    """Rebuild silver, or only the given dates of it, and report the row counts of both layers.

    The natural key contains the event time and so the date: a date is cleaned from its own bronze
    partition alone, and refreshing the dates that got new events equals the full rebuild.
    """
    dates = checked_dates(spark, layers, dates)
    bronze = lake.read(spark, layers.bronze, dates)
    with tasks_sized_for(spark, lake.stored_bytes(spark, layers.bronze, dates)):
        written = lake.write_partitions(
            clean(bronze), layers.silver, "date", NATURAL_KEY, only=dates
        )
    # Counted from file footers: an observation ahead of the shuffle would count a lost task twice.
    return {"bronze": bronze.count(), "silver": written["rows"]}


def read_dim_ticker(spark: SparkSession, layers: Layers) -> DataFrame | None:
    """The live ticker dimension, None before the first load. Any other failure is raised."""
    path = lake.latest_snapshot(spark, layers.dim_ticker)
    return None if path is None else spark.read.parquet(path)


@dataclass(frozen=True)
class Published:
    """One state of the three gold tables that belong together."""

    ticker: str
    calendar: str
    runs: dict[int, int]  # by date key

    def paths(self, layers: Layers) -> list[str]:
        return [f"{layers.fact}/run={run}/date_key={key}" for key, run in sorted(self.runs.items())]


def _read_published(spark: SparkSession, path: str) -> Published:
    rows = spark.read.parquet(path).collect()  # one row per day
    return Published(rows[0]["ticker"], rows[0]["calendar"], {r["date_key"]: r["run"] for r in rows if r["date_key"] is not None})


def published(spark: SparkSession, layers: Layers) -> Published | None:
    path = lake.latest_snapshot(spark, layers.star)
    return None if path is None else _read_published(spark, path)


def _publish(spark: SparkSession, layers: Layers, state: Published) -> None:
    """Make the state the one that readers see, by one mark, and drop facts that no kept state names."""
    days = [*state.runs.items()] or [(None, None)]
    rows = [(state.ticker, state.calendar, key, run) for key, run in days]
    kinds = "ticker string, calendar string, date_key int, run int"
    lake.write_snapshot(spark.createDataFrame(rows, kinds).coalesce(1), layers.star)
    named = {path for other in _kept(spark, layers) for path in other.paths(layers)}
    for run in lake.folders(spark, layers.fact):
        folder = f"{layers.fact}/{run}"
        days_of = [f"{folder}/{day}" for day in lake.folders(spark, folder)]
        for path in days_of if named & set(days_of) else [folder]:
            if path not in named:
                lake.drop(spark, path)


def _kept(spark: SparkSession, layers: Layers) -> list[Published]:
    return [_read_published(spark, path) for path in lake.complete_snapshots(spark, layers.star)]


def _facts(spark: SparkSession, layers: Layers, state: Published) -> DataFrame:
    if not state.runs:
        return spark.createDataFrame([], ddl(FACT))
    stored = spark.read.schema(f"{ddl(FACT)}, run int").option("basePath", layers.fact)
    return stored.parquet(*state.paths(layers)).select(*FACT)


def read_star(spark: SparkSession, layers: Layers) -> Star:
    """The three tables as one run has published them, whatever another run is writing."""
    state = published(spark, layers)
    if state is None:
        raise FileNotFoundError(f"no complete snapshot in {layers.star}")
    return Star(_facts(spark, layers, state), spark.read.parquet(state.ticker), spark.read.parquet(state.calendar))


def read_fact(spark: SparkSession, layers: Layers) -> DataFrame:
    return read_star(spark, layers).fact


def build_gold(
    spark: SparkSession, layers: Layers, run_date: dt.date | str | None = None,
    names: Names = COMPANY_NAMES, dates: Iterable[str] | None = None,
) -> dict[str, int]:
    """Write the star schema of all of silver, or bring it up to date after some dates changed.

    Silver is scanned twice: four columns for the ticker attributes, six for the fact. Results are
    stored before they are used again: attributes by date, the dimension as a snapshot that the fact
    reads back, the calendar from the days of the written fact. Rows whose date is unusable stay out
    of gold and are counted as ``undated``.

    Nothing that readers use is overwritten: dimension and calendar are new snapshots, the facts of rewritten
    days go to a folder of the run. One mark then publishes the three together (``read_star``).

    With ``dates`` only those dates of silver are read for the attributes; the latest pair is then taken
    over all dates of the small attribute table, so a symbol that left a date falls back to what was
    seen before. Facts are refreshed for the changed dates, for days from ``run_date`` on, and for days
    from the first version on that was opened since the fact was last completed, which covers runs that
    failed in between. ``names`` apply to all symbols.

    A ``run_date`` before that of another load is a late load: it sees silver up to that day, and its attributes
    hold until the next load has seen the symbol (``scd2.merge_late``). Facts from that day on are
    refreshed; should the run fail before that, the next one does it.
    """
    ensure_checkpoint_dir(spark)
    day = str(run_date or spark.sql("SELECT current_date() AS d").first()["d"])
    dates = checked_dates(spark, layers, dates)
    stored, on = lake.read(spark, layers.silver), calendar_date(F.col("date"))
    undated = stored.where(on.isNull()).count()
    dated = stored.where(on.isNotNull())
    existing = read_dim_ticker(spark, layers)
    loads = None if existing is None else _loads(spark, layers, existing)
    late = loads is not None and str(loads.agg(F.max("load_date").alias("d")).first()["d"] or "") > day
    partial = dates is not None and existing is not None and lake.exists(spark, layers.attributes)

    with tasks_sized_for(spark, lake.stored_bytes(spark, layers.silver, dates if partial else None)):
        seen = seen_attrs(dated.where(F.col("date").isin(*dates)) if partial else dated, "date")
        pair = ["symbol", "currency", "source"]
        lake.write_partitions(seen, layers.attributes, "date", pair, only=dates if partial else None)
    # With its schema, so a layer without rows can be read too.
    attributes = spark.read.schema(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in seen.schema)).parquet(layers.attributes)
    if late:
        attributes = attributes.where(calendar_date(F.col("date").cast("string")) <= F.lit(day).cast("date"))
        _mark_stale(spark, layers, min(filter(None, (_stale_since(spark, layers), day))))
    attrs = store(latest_attrs(attributes, names))
    if existing is None:
        dimension = scd2.initial(attrs, day)
    elif late:
        dimension = scd2.merge_late(existing, attrs, loads, day)
    else:
        dimension = scd2.merge(existing, attrs, day)
    before, kept = published(spark, layers), _kept(spark, layers)
    ticker = lake.write_snapshot(dimension, layers.dim_ticker, {state.ticker for state in kept})
    dimension = spark.read.parquet(ticker)
    seen_now = attrs.select("symbol", F.lit(day).alias("load_date"))
    lake.write_partitions(seen_now, layers.loads, "load_date", ["symbol"], only=[day])

    known = _known_key(spark, layers)
    keys, stale, sized = None, dated, None
    if partial and known is not None and before is not None:
        opened = dimension.where(F.col("ticker_key") > known).agg(F.min("effective_from").alias("d")).first()["d"]
        since = min(filter(None, (day, opened and str(opened), _stale_since(spark, layers))))
        days = _calendar_days(spark, dates)
        keys = [d.strftime("%Y%m%d") for d in days]
        stale = dated.where(on.isin(days) | (on >= F.lit(since).cast("date")))
        later = stored.select("date").where(on >= F.lit(since).cast("date")).distinct()
        sized = sorted({r["date"] for r in later.collect()} | set(dates))  # dates, not data
    with tasks_sized_for(spark, lake.stored_bytes(spark, layers.silver, sized)):
        rows = fact_daily(stale, dimension)
        # Days before the first load have no ticker key, so measures help to tell rows apart.
        apart = ["ticker_key", "avg_close", "total_volume"]
        run = 1 + max((int(name.partition("=")[2]) for name in lake.folders(spark, layers.fact) if name.startswith("run=")), default=0)
        fact = lake.write_partitions(rows, f"{layers.fact}/run={run}", "date_key", apart)
    written = lake.folders(spark, f"{layers.fact}/run={run}")
    runs = {} if keys is None else {k: r for k, r in before.runs.items() if str(k) not in keys}
    runs |= {int(name.partition("=")[2]): run for name in written if name.startswith("date_key=")}
    days = spark.createDataFrame([(str(key),) for key in runs], "key string")
    calendar_rows = dim_date(days.select(F.to_date("key", "yyyyMMdd").alias("date")))
    calendar = lake.write_snapshot(calendar_rows.coalesce(1), layers.dim_date, {state.calendar for state in kept})
    _publish(spark, layers, Published(ticker, calendar, runs))

    top = dimension.agg(F.coalesce(F.max("ticker_key"), F.lit(0)).alias("ticker_key"))
    lake.write_snapshot(top, layers.fact_state)
    if _stale_since(spark, layers) is not None:
        _mark_stale(spark, layers, None)
    return {"fact_daily_prices": fact["rows"], "dim_date": len(runs), "undated": undated}


def _loads(spark: SparkSession, layers: Layers, dimension: DataFrame) -> DataFrame:
    """``(symbol, load_date)`` of all loads: as written after each one, and at least the days on which versions
    begin, for loads from before that table was kept or that failed ahead of it."""
    begun = dimension.select("symbol", F.col("effective_from").alias("load_date"))
    if not lake.exists(spark, layers.loads):
        return begun
    stored = spark.read.schema("symbol string, load_date string").parquet(layers.loads)
    return begun.unionByName(stored.withColumn("load_date", F.col("load_date").cast("date"))).distinct()


def _stale_since(spark: SparkSession, layers: Layers) -> str | None:
    path = lake.latest_snapshot(spark, layers.stale)
    return None if path is None else spark.read.parquet(path).first()["since"]


def _mark_stale(spark: SparkSession, layers: Layers, since: str | None) -> None:
    lake.write_snapshot(spark.range(1).select(F.lit(since).cast("string").alias("since")), layers.stale)


def refresh_partials(
    spark: SparkSession, layers: Layers, dates: Iterable[str] | None = None, load: Column | str = "load",
) -> list[str]:
    """Bring the partial sums of the daily bars up to date with silver, or with some of its dates; returns the
    loads that were rewritten. A late event rewrites the partials of its own load, and of the load whose row
    it replaces, and no others. ``load`` names the load of a silver row."""
    dates = None if dates is None else list(dates)
    fresh = store(daily_partials(lake.read(spark, layers.silver, dates), load).withColumn("load", F.col("load").cast("string")))
    if not lake.exists(spark, layers.partials):
        lake.write_partitions(fresh, layers.partials, "load", ["symbol", "date"])
        return sorted(r["load"] for r in fresh.select("load").distinct().collect())
    stored = read_partials(spark, layers)
    days = F.col("date").isin(_calendar_days(spark, dates)) if dates is not None else F.lit(True)
    loads = [r["load"] for r in changed(stored.where(days), fresh).collect()]  # loads, not data
    if loads:
        of_them = F.col("load").isin(loads)
        rows = store(stored.where(of_them & ~days).unionByName(fresh.where(of_them)))
        lake.write_partitions(rows, layers.partials, "load", ["symbol", "date"], only=loads)
    return sorted(loads)


def read_partials(spark: SparkSession, layers: Layers) -> DataFrame:
    kinds = "symbol string, date date, day_high double, day_low double, close_sum decimal(38, 12), closes bigint, "
    return spark.read.schema(kinds + "odd_closes double, total_volume bigint, load string").parquet(layers.partials)


def _known_key(spark: SparkSession, layers: Layers) -> int | None:
    path = lake.latest_snapshot(spark, layers.fact_state)
    return None if path is None else spark.read.parquet(path).first()["ticker_key"]


def _calendar_days(spark: SparkSession, dates: Iterable[str]) -> list[dt.date]:
    """The days that date texts stand for in silver, read as Spark reads them."""
    texts = [F.lit(date).try_cast("date") for date in dates]
    found = spark.range(1).select(F.array(*texts).alias("d")).first()["d"] if texts else []
    return sorted({d for d in found if d is not None})


def _is_date(text: str) -> bool:
    try:
        return bool(re.fullmatch(r"\d{4}-\d{2}-\d{2}", text) and dt.date.fromisoformat(text))
    except ValueError:
        return False


def load_warehouse(spark: SparkSession, layers: Layers, warehouse: Warehouse) -> dict[str, int]:
    """Replace the three warehouse tables and report their row counts."""
    star = read_star(spark, layers)
    tables = dict(zip(GOLD_TABLES, (star.calendar, star.ticker, star.fact)))
    return {name: load_table(frame, name, warehouse) for name, frame in tables.items()}


def latest_events(bars: DataFrame, zone: str | None = None) -> DataFrame:
    """Keyed log messages of the latest bar of each symbol of ``bars(symbol, ts, open, ..., volume)``."""
    return to_event_json(shape_contract(latest_bar(bars), zone=zone))


def run_batch(
    spark: SparkSession, layers: Layers, warehouse: Warehouse | None = None,
    run_date: dt.date | str | None = None, names: Names = COMPANY_NAMES,
    dates: Iterable[str] | None = None,
) -> dict[str, dict[str, int]]:
    """Silver, gold and, if a warehouse is given, the load. Each step may be repeated safely.

    ``dates`` limits the run to bronze dates that changed since the last run that ended well.
    """
    dates = None if dates is None else list(dates)
    report = {"silver": refine_silver(spark, layers, dates)}
    report["gold"] = build_gold(spark, layers, run_date, names, dates)
    if warehouse is not None:
        report["warehouse"] = load_warehouse(spark, layers, warehouse)
    return report


# Quarantine replay

def _replays(spark: SparkSession, root: str) -> list[str]:
    """Folders of the versions of rules whose replay is complete."""
    return [f"{root}/{name}" for name in lake.folders(spark, root) if lake.exists(spark, f"{root}/{name}/{lake.DONE}")]


def _moved(spark: SparkSession, folders: list[str]) -> DataFrame:
    kinds = "kafka_topic string, kafka_partition int, kafka_offset bigint"
    if not folders:
        return spark.createDataFrame([], kinds)
    return spark.read.schema(kinds).parquet(*(f"{folder}/moved" for folder in folders))


def replay_quarantine(
    spark: SparkSession, quarantine: DataFrame, root: str, version: str,
    reason: Callable[[Column], Column] = error_reason, strict_json: bool = False,
) -> int:
    """Move the quarantined records that the rules of a new ``version`` accept; returns how many.

    The accepted rows and the names of their records go to a folder of the version below ``root``, and a mark
    completes it. Readers (``bronze_with_replays``, ``quarantine_left``) look at complete versions only, so a run
    that stops after either write has moved nothing, and one more run does it. Records that another
    version has moved are not moved again. A version that is complete is not replayed.
    """
    done, folder = _replays(spark, root), f"{root}/version={version}"
    if folder in done:
        return 0
    rows = accepted(quarantine, reason, strict_json, _moved(spark, done))
    lake.write_partitions(rows, f"{folder}/rows", "date", RECORD)
    written = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    moved = lake.write(written.select(*RECORD), f"{folder}/moved")
    lake.touch(spark, f"{folder}/{lake.DONE}")
    return moved["rows"]


def bronze_with_replays(spark: SparkSession, bronze: DataFrame, root: str) -> DataFrame:
    folders = _replays(spark, root)
    if not folders:
        return bronze
    rows = [spark.read.schema(bronze.schema).parquet(f"{folder}/rows") for folder in folders]
    return reduce(DataFrame.unionByName, [bronze, *rows])


def quarantine_left(spark: SparkSession, quarantine: DataFrame, root: str) -> DataFrame:
    return still_rejected(quarantine, _moved(spark, _replays(spark, root)))

"""Mixing sources to target weights along a curriculum that changes over the training run.

1. Targets: a budget of words is shared among the sources by weight; no source gets more than a given
   number of times its own words, and what it cannot take goes to the others, by weight.
2. Passes: a source's words are demanded one after the other, document by document in a hashed order,
   pass after pass, until its target is met.
3. Positions: a source's weight changes over the run. Its integral up to time t, scaled to the target,
   is the number of words demanded by then; the inverse of that function gives the time at which the
   word number c is due. A document's position is the time of its first word.
4. Order: documents are range-sorted by position.

Everything is built-in functions, aggregates, windows over small tables and joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barlake.llm.common import Scratch, free_name, n_words

#: Slices of a source's hashed order, for running sums in two levels. Rows of a slice meet in a task.
SLICES = 4096


def source_targets(
    sizes: DataFrame, weights: Sequence[float], budget: float, limit: float
) -> DataFrame:
    """``(source, source_size, weight, target)`` for the sources of ``sizes(source, size)``.

    Sources are ranked by code point, null last, and take the ``weights`` in turn. They share
    ``budget`` times all words; a target stops at ``limit`` times the source's words. With the sources
    in order of limit per weight, those that stop are the first ones: a source stops if, at the share
    per weight at which it would, the whole demand still fits the budget.

    The window over all sources sees one row per source.
    """
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    shares = totals.withColumn("weight", cycle[(rank - 1) % len(weights)])
    shares = shares.withColumn("cap", limit * F.col("source_size")).withColumn("level", F.try_divide("cap", "weight"))
    along = W.orderBy(F.col("level").asc_nulls_last(), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, 0)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    shares = shares.withColumns({
        "capped_sum": F.sum("cap").over(along),
        "open_weight": F.sum("weight").over(everything) - F.sum("weight").over(along),
        "goal": budget * F.sum("source_size").over(everything),
    })
    stops = F.col("capped_sum") + F.col("level") * F.col("open_weight") <= F.col("goal")
    shares = shares.withColumn("stops", F.coalesce(stops, F.lit(False)))  # no level without a weight
    left = F.col("goal") - F.coalesce(F.sum(F.when(F.col("stops"), F.col("cap"))).over(everything), F.lit(0.0))
    open_sum = F.sum(F.when(~F.col("stops"), F.col("weight"))).over(everything)
    fair = F.when(F.col("stops"), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.coalesce(F.try_divide(left * F.col("weight"), open_sum), F.lit(0.0)))
    )
    return shares.select("source", "source_size", "weight", F.coalesce(fair, F.lit(0.0)).alias("target"))


def due_at(words: Column, target: Column, phases: Column) -> Column:
    """Time in [0, 1] at which ``words`` words of a source have been demanded.

    ``phases`` is an array of weights, one for each of as many equal parts of the run. The integral is
    linear within a phase, so its inverse is found phase by phase. Phases whose weights add up to 0
    count as even.
    """
    n = F.size(phases)
    total = F.aggregate(phases, F.lit(0.0), lambda s, w: s + w)
    level = F.when(total > 0, phases).otherwise(F.transform(phases, lambda w: F.lit(1.0)))
    total = F.when(total > 0, total).otherwise(n.cast("double"))
    wanted = words / target * total  # in units of the weights' sum
    state = F.struct(wanted.alias("rest"), F.lit(0.0).alias("t"))
    walked = F.aggregate(
        level, state,
        lambda s, w: F.struct(
            F.greatest(s["rest"] - w, F.lit(0.0)).alias("rest"),
            (s["t"] + F.when(s["rest"] >= w, F.lit(1.0)).when(w > 0, s["rest"] / w).otherwise(0.0)).alias("t"),
        ),
        lambda s: F.least(s["t"] / n, F.lit(1.0)),
    )
    return F.when(target > 0, walked)


def ramp(weight: Column, phases: int = 8) -> Column:
    """A schedule in ``phases`` equal parts: weights above 2 fade out, those below 2 fade in."""
    slope = F.least(F.greatest((F.lit(2.0) - weight) / 2, F.lit(-0.5)), F.lit(0.5))
    steps = [(2 * i + 1) / phases - 1 for i in range(phases)]  # mid of each phase, from -1 to 1
    return F.array(*(F.lit(1.0) + slope * step for step in steps))


def passes(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), budget: float = 1.5, limit: float = 2.0,
    schedule=ramp, seed: int = 42,
) -> DataFrame:
    """One row per distinct ``doc_id``, ``source`` and text of ``docs``: what the mix takes of it, and when.

    Columns: ``doc_id``, ``source``, ``content`` (a hash of the text), ``copies`` (rows with these three),
    ``size``, ``source_size``, ``target``, ``at`` (words of the source ahead of the first copy), ``whole`` (full
    passes over the source), ``goal`` (words of the source that are taken) and ``phases`` (its schedule).

    A source's order comes from a hash of its rows, so reruns agree. Repeated rows are counted before
    anything else, and the hash covers the text, so neither a repeated row nor an id that many rows share
    fills a slice. Running sums have two levels: sums of slices of that order, then sums within a slice. So
    a source that holds most rows is spread over as many tasks as it has slices.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    sizes = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("content"))
    sizes = sizes.groupBy("doc_id", "source", "size", "content").agg(F.count("*").alias("copies"))
    spread = F.xxhash64("doc_id", "source", "content", F.lit(seed))
    sizes = sizes.withColumn("_h", spread).withColumn("_slice", F.pmod("_h", F.lit(SLICES)).cast("int"))
    sizes = scratch.save(sizes, "sizes")

    words = (F.col("size") * F.col("copies")).alias("size")
    targets = source_targets(sizes.select("source", words), weights, budget, limit)
    sums = sizes.select("source", "_slice", words).groupBy("source", "_slice").agg(F.sum("size").alias("_sum"))
    before = W.partitionBy("source").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0))).alias("s")
    starts = starts.join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
    starts = starts.select("s.source", "_slice", "_start", "source_size", "weight", "target")

    inside = W.partitionBy("source", "_slice").orderBy("_h", "doc_id", "size", "content")
    ahead = F.sum(F.col("size") * F.col("copies")).over(inside.rowsBetween(W.unboundedPreceding, -1))
    placed = sizes.withColumn("_within", F.coalesce(ahead, F.lit(0))).alias("d")
    same = F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d._slice") == F.col("s._slice"))
    goal = F.floor("target")
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(0)
    return placed.join(starts.alias("s"), same).select(
        "d.doc_id", "d.source", "d.content", "d.copies", "d.size", "s.source_size", "s.target",
        (F.col("_start") + F.col("_within")).alias("at"), whole.cast("bigint").alias("whole"),
        goal.cast("bigint").alias("goal"), schedule(F.col("weight")).alias("phases"),
    )


def _positions(at: Column) -> tuple[Column, Column]:
    """Words taken of, and positions of the passes over, the document of ``passes`` whose first word comes
    after ``at`` others of its source."""
    size, whole, total = F.col("size"), F.col("whole"), F.col("source_size")
    part = F.greatest(F.least(F.col("goal") - whole * total - at, size), F.lit(0))  # of the last, partial pass
    times = F.when(size > 0, whole + F.when(part > 0, 1).otherwise(0)).otherwise(0).cast("int")
    each = F.when(times > 0, F.sequence(F.lit(0), times - 1)).otherwise(F.array().cast("array<int>"))
    due = F.transform(each, lambda p: due_at((at + p * total).cast("double"), F.col("target"), F.col("phases")))
    return (whole * size + part).cast("bigint"), due


def mix(docs: DataFrame, **settings) -> DataFrame:
    """One row per row of ``docs(doc_id, text, source)``: what the mix takes of it, and when. Settings as in
    ``passes``.

    Columns: ``doc_id``, ``size`` (words of the text, 0 for null), ``source``, ``source_size``,
    ``target``, ``taken`` (words taken, repeats counted), ``positions`` (time of its first word in [0, 1],
    for each pass that reads it, the last one perhaps in part; empty if it is never read).
    ``taken`` adds up to each source's target, rounded down. Other columns are ignored; a null source is
    a source of its own; repeated rows are documents of their own, one behind the other; an empty table
    gives no rows. A source of weight 0 is not read.
    """
    block = 10_000  # copies are unfolded in two steps, so no array holds all of them
    found = passes(docs, **settings)
    found = found.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(block).cast("bigint"))))
    last = F.least(F.col("_block") + (block - 1), F.col("copies") - 1)
    found = found.withColumn("_copy", F.explode(F.sequence(F.col("_block"), last)))
    taken, due = _positions(F.col("at") + F.col("_copy") * F.col("size"))
    return found.select("doc_id", "size", "source", "source_size", "target", taken.alias("taken"), due.alias("positions"))


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per pass over a document, with its ``position``, range-sorted by it."""
    passes = mixed.withColumn("position", F.explode("positions")).drop("positions")
    return passes.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def in_training_order(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, each as often as the mix reads it and range-sorted by the position of each pass;
    all columns stay. Documents that the mix never reads go; a document that the last pass reads in part is
    kept whole. Repeated rows (same id, source and text) all stand at the places of the first of them.

    Ties of position go by id and text. The texts are scanned once for their sizes and once to be put in order.
    """
    _, due = _positions(F.col("at"))
    found = passes(docs, **settings).select("doc_id", "source", "content", due.alias("due")).where(F.size("due") > 0)
    content, place = free_name(docs.columns, "_content"), free_name(docs.columns, "_place")
    same = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & F.col("d.source").eqNullSafe(F.col("m.source"))
    read = docs.withColumn(content, F.xxhash64("text")).alias("d")
    read = read.join(found.alias("m"), same & (F.col(f"d.{content}") == F.col("m.content")))
    read = read.select("d.*", F.explode("m.due").alias(place))
    order = [place, "doc_id", content]
    return read.repartitionByRange(*order).sortWithinPartitions(*order).select(docs.columns)

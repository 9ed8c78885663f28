"""Counter metrics: increases with reset handling, rates, latency ratio, totals, throughput.

A sample is one scraped value of a monotonic counter: series columns, a time (TIMESTAMP, TIMESTAMP_NTZ
or integer seconds) and a value. A series may be long and hot, so no operator here walks a whole
series in one task: time is cut into chunks, and every chunk is handed what it needs from earlier
ones (the tail that its first windows reach back to, and the last sample before that tail).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Samples of a task, on average, copies for other chunks not counted. Adaptive execution would size tasks by their
#: shuffled bytes, of which the sorts and windows hold some hundred times as much.
TASK_SAMPLES = 50_000


def _ticks(samples: DataFrame, ts: str) -> tuple[Column, int]:
    """Time as an integer and the number of its units per second."""
    kind = samples.schema[ts].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(ts)), 1_000_000
    if isinstance(kind, T.TimestampNTZType):
        # From its own fields: a difference of timestamps would go through the session's time zone.
        wall = F.col(ts)
        seconds = F.unix_date(wall.cast("date")).cast("bigint") * 86_400 + F.hour(wall) * 3_600
        seconds = seconds + F.minute(wall) * 60
        micros = (F.date_part(F.lit("SECOND"), wall) * 1_000_000).cast("bigint")
        return seconds * 1_000_000 + micros, 1_000_000
    return F.col(ts).cast("bigint"), 1


def _chunked(
    samples: DataFrame, by: Sequence[str], ts: str, value: str, tie: str | None,
    window: int, chunk: int,
) -> tuple[DataFrame, list[str]]:
    """Samples spread over time chunks that can be processed independently.

    Adds ``_t`` (time), ``_chunk`` and ``_own``. Rows with ``_own = false`` are context for the
    chunk: copies of the last ``window`` of the chunk before, and the one sample before those.
    Samples are counted and laid out by chunk in as many tasks as their number asks for, so that a task's memory
    does not grow with them. Returns the frame and the columns that order a chunk.
    """
    tasks = max(1, -(-samples.count() // TASK_SAMPLES))
    order = ["_t", *([tie] if tie else []), value]
    time = F.col("_t")
    timed = samples.where(F.col(value).isNotNull() & ~F.isnan(value))  # NaN marks a series as gone
    timed = timed.withColumn("_chunk", F.expr(f"(_t - pmod(_t, {chunk}L)) div {chunk}L"))
    in_tail = time >= (F.col("_chunk") + 1) * chunk - window

    # Last sample of every chunk and of its part before the tail; two small rows per series and chunk.
    sample = F.struct(*order)
    ends = timed.groupBy(*by, "_chunk").agg(
        F.max(sample).alias("last"), F.max(F.when(~in_tail, sample)).alias("last_head")
    )
    along = W.partitionBy(*by).orderBy("_chunk")
    adjacent = F.lag("_chunk").over(along) == F.col("_chunk") - 1
    before_tail = F.coalesce(F.lag("last_head").over(along), F.lag("last", 2).over(along))
    carry = F.when(adjacent, before_tail).otherwise(F.lag("last").over(along))
    carried = ends.withColumn("_carry", carry).where("_carry IS NOT NULL")
    carried = carried.select(*by, "_chunk", "_carry.*", F.lit(False).alias("_own"))

    if window:
        home = F.col("_chunk")
        places = F.when(in_tail, F.array(home, home + 1)).otherwise(F.array(home))
        spread = timed.withColumn("_place", F.explode(places)).withColumn("_own", F.col("_place") == home)
        spread = spread.drop("_chunk").withColumnRenamed("_place", "_chunk")
    else:
        spread = timed.withColumn("_own", F.lit(True))
    together = spread.unionByName(carried, allowMissingColumns=True)
    return together.repartition(tasks, *by, "_chunk"), order


def _with_delta(spread: DataFrame, by: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Increase since the previous sample; a falling counter was reset, so its new value counts."""
    before = F.lag(value).over(W.partitionBy(*by, "_chunk").orderBy(*order))
    v, previous = F.col(value), F.col("_before")
    gained = F.when(previous.isNull(), F.lit(0).cast("double")).when(v < previous, v).otherwise(v - previous)
    # As a column of its own, or the window would evaluate it once per use.
    return spread.withColumn("_before", before).withColumn("delta", gained).drop("_before")


def increases(
    samples: DataFrame, by: Sequence[str], ts: str = "ts", value: str = "value",
    tie: str | None = None, chunk_seconds: int = 3_600,
) -> DataFrame:
    """Samples with ``delta``: the increase since the previous sample of the series (0 for the first)."""
    time, per_second = _ticks(samples, ts)
    spread, order = _chunked(
        samples.withColumn("_t", time), by, ts, value, tie, 0, chunk_seconds * per_second
    )
    deltas = _with_delta(spread, by, order, value).where("_own")
    return deltas.select(*samples.columns, "delta")


def counter_rate(
    samples: DataFrame, by: Sequence[str], window_seconds: int, ts: str = "ts",
    value: str = "value", tie: str | None = None, chunk_seconds: int | None = None,
) -> DataFrame:
    """Samples with ``rate``: increase within the closed window ``[t - window, t]`` per second.

    The increase is what the counter gains from the first to the last sample of the window, resets
    included. What the first sample gained over the one before it was gained before the window, at least in
    part, and is left out; nothing is extrapolated to the window's edges.

    Time is cut into blocks as long as the window, so a window is the end of one block and the beginning of
    the next. Its increase is the sum of two short sums: of what the samples of the first block gained after
    the first one that lies in the window, added up from the block's end, and of what those of the second
    block gained up to ``t``. No long running sums are subtracted, so a jump of the counter costs no digits
    of other windows, and the work is linear in the samples however many a window holds. A chunk holds some
    whole blocks; ``chunk_seconds`` is rounded up to that.
    """
    time, per_second = _ticks(samples, ts)
    window = window_seconds * per_second
    chunk = max(4 * window, 3_600 * per_second) if chunk_seconds is None else chunk_seconds * per_second
    if chunk < window:
        raise ValueError("a chunk must be at least as long as the window")
    chunk = -(-chunk // window) * window
    spread, order = _chunked(samples.withColumn("_t", time), by, ts, value, tie, window, chunk)
    deltas = _with_delta(spread, by, order, value)

    # Every sample asks for the first one in its window: a row at the window's left edge. Rows are unfolded in
    # place, so that all windows below keep to the layout by series and chunk.
    asking = F.when(F.col("_own"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = deltas.withColumn("_asks", F.explode(asking)).withColumn("_of", F.col("_t"))
    rows = rows.withColumn("_t", F.when(F.col("_asks"), F.col("_of") - window).otherwise(F.col("_of")))
    rows = rows.withColumn("delta", F.when(~F.col("_asks"), F.col("delta")))
    rows = rows.withColumn("_block", F.expr(f"(_t - pmod(_t, {window}L)) div {window}L"))

    block = W.partitionBy(*by, "_chunk", "_block")
    backward = block.orderBy(F.desc("_t"), "_asks", *[F.desc(c) for c in order[1:]])
    forward = block.orderBy("_asks", *order)
    upto = block.orderBy("_t").rangeBetween(W.unboundedPreceding, 0)
    zero = F.lit(0).cast("double")
    later = F.coalesce(F.sum("delta").over(backward.rowsBetween(W.unboundedPreceding, -1)), zero)
    rows = rows.withColumn("_later", F.when(~F.col("_asks"), later))  # gained by the samples behind, in the block
    rows = rows.withColumn("_head", F.last("_later", ignorenulls=True).over(backward.rowsBetween(W.unboundedPreceding, 0)))
    rows = rows.withColumn("_first", F.row_number().over(forward) == 1)
    rows = rows.withColumns({
        "_upto": F.sum("delta").over(upto),
        "_inside": F.sum(F.when(F.col("_first"), zero).otherwise(F.col("delta"))).over(upto),
    })
    answer = F.max(F.when(F.col("_asks"), F.col("_head"))).over(W.partitionBy(*by, "_chunk", "_of"))
    rows = rows.withColumn("_answer", answer).where("_own AND NOT _asks")
    increase = F.coalesce(F.col("_answer") + F.col("_upto"), F.col("_inside"))
    return rows.withColumn("rate", increase / window_seconds).select(*samples.columns, "rate")


def counted_per_minute(
    samples: DataFrame, by: Sequence[str] = ("symbol",), per: Sequence[str] = ("symbol",),
    ts: str = "ts", value: str = "value", tie: str | None = None,
) -> DataFrame:
    """Records per minute from stored counters: what all series of a ``per`` group gained in it.

    ``by`` tells series apart (a symbol may be sent by several producers), ``per`` names the result
    groups. Same figure as ``records_per_minute``, which counts the events themselves.
    """
    deltas = increases(samples, by, ts, value, tie)
    gained = deltas.groupBy(F.window(ts, "1 minute").alias("_span"), *per)
    gained = gained.agg(F.sum("delta").alias("records"))
    return gained.select(F.col("_span.start").alias("minute"), *per, "records")


def records_rate(
    samples: DataFrame, by: Sequence[str] = ("symbol",), per: Sequence[str] = ("symbol",),
    window_seconds: int = 60, step_seconds: int = 15, ts: str = "ts", value: str = "value", tie: str | None = None,
) -> DataFrame:
    """Records per minute over sliding windows: one row per window and ``per`` group that gained samples.

    ``by`` and ``per`` as in ``counted_per_minute``; a window reaches from ``window_start`` to just before
    its end, and every ``step_seconds`` one begins. What was gained is summed per step before it goes into
    several windows, so samples are not multiplied. The window has to be a multiple of the step.
    """
    if window_seconds % step_seconds:
        raise ValueError("the window has to be a multiple of the step")
    deltas = increases(samples, by, ts, value, tie)
    steps = deltas.groupBy(F.window(ts, f"{step_seconds} seconds").alias("_step"), *per)
    steps = steps.agg(F.sum("delta").alias("_gained")).withColumn("_start", F.col("_step.start"))
    spans = F.window("_start", f"{window_seconds} seconds", f"{step_seconds} seconds").alias("_span")
    sums = steps.groupBy(spans, *per).agg((F.sum("_gained") * 60 / window_seconds).alias("records_per_minute"))
    return sums.select(F.col("_span.start").alias("window_start"), *per, "records_per_minute")


def average_latency(
    samples: DataFrame, sum_metric: str, count_metric: str, by: Sequence[str] = ("symbol",),
    window: str = "5 minutes", step: str | None = None, ts: str = "ts", value: str = "value",
    tie: str | None = None,
) -> DataFrame:
    """Mean of a histogram over time windows: increase of its sum / increase of its count, all series.

    Both increases are taken over the same window, so its length cancels out. NULL where nothing was
    counted. ``samples`` is long: one row per metric, series and time. With ``step``, windows slide: what
    was gained is summed per step first, and only these sums go into several windows. The window has
    to be a multiple of the step.
    """
    both = samples.where(F.col("metric").isin(sum_metric, count_metric))
    deltas = increases(both, ["metric", *by], ts, value, tie)

    def gained(metric: str) -> Column:
        return F.when(F.col("metric") == metric, F.col("delta"))

    totals = F.sum(gained(sum_metric)).alias("_sum"), F.sum(gained(count_metric)).alias("_count")
    sums = deltas.groupBy(F.window(ts, step or window).alias("_span")).agg(*totals)
    sums = sums.select(F.col("_span.start").alias("window_start"), "_sum", "_count")
    if step:
        spans = F.window("window_start", window, step).alias("_span")
        sums = sums.groupBy(spans).agg(F.sum("_sum").alias("_sum"), F.sum("_count").alias("_count"))
        sums = sums.withColumn("window_start", F.col("_span.start"))
    return sums.select("window_start", F.try_divide("_sum", "_count").alias("avg_latency"))


def totals_or_zero(
    samples: DataFrame, metrics: Sequence[str], by: Sequence[str] = ("symbol",), ts: str = "ts",
    value: str = "value", tie: str | None = None,
) -> DataFrame:
    """Latest value of each series summed per metric; a metric without samples totals 0."""
    order = F.col(ts) if tie is None else F.struct(ts, tie)
    wanted = samples.where(F.col("metric").isin(*metrics))
    latest = wanted.groupBy("metric", *by).agg(F.max_by(value, order).alias("_latest"))
    sums = [
        F.coalesce(F.sum(F.when(F.col("metric") == m, F.col("_latest"))), F.lit(0).cast("double"))
        for m in metrics
    ]
    rows = [F.struct(F.lit(m).alias("metric"), s.alias("total")) for m, s in zip(metrics, sums)]
    return latest.agg(F.array(*rows).alias("_totals")).select(F.inline("_totals"))


def records_per_minute(events: DataFrame, ts: str = "ts", watermark: str | None = None) -> DataFrame:
    """Events per symbol and minute. On a stream, ``watermark`` bounds the state and lets minutes close."""
    if watermark:
        events = events.withWatermark(ts, watermark)
    counts = events.groupBy(F.window(ts, "1 minute").alias("_span"), "symbol").agg(
        F.count("*").alias("records")
    )
    return counts.select(F.col("_span.start").alias("minute"), "symbol", "records")

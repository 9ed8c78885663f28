"""Bars -> event records: latest bar per symbol, contract shaping, keyed JSON; missing bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barlake.functions import iso_utc, local_iso_utc, round_cents
from barlake.schemas import BAR_CURRENCY, BAR_INTERVAL, BAR_SOURCE, EVENT


def latest_bar(bars: DataFrame, ts: str = "ts", tie: str | None = None) -> DataFrame:
    """The newest bar of each symbol; a symbol without bars yields no row.

    Every column is picked by the same order, so a row stays whole. Without ``tie`` and with numeric
    columns all buffers have a fixed width and Spark plans a hash aggregate, no sort.
    """
    order = F.col(ts) if tie is None else F.struct(ts, tie)
    columns = [c for c in bars.columns if c != "symbol"]
    latest = bars.where(F.col(ts).isNotNull()).groupBy("symbol")
    return latest.agg(*[F.max_by(c, order).alias(c) for c in columns]).select(*bars.columns)


def shape_contract(
    bars: DataFrame,
    ts: str = "ts",
    zone: str | None = None,
    source: str = BAR_SOURCE,
    interval: str = BAR_INTERVAL,
    currency: str = BAR_CURRENCY,
    ingested_at: Column | None = None,
) -> DataFrame:
    """The eleven contract fields of each bar: prices in cents, whole volume, UTC time texts.

    ``ts`` is an instant, or a wall clock time (TIMESTAMP_NTZ) of ``zone``.
    """
    time = iso_utc(F.col(ts)) if zone is None else local_iso_utc(F.col(ts), zone)
    now = F.current_timestamp() if ingested_at is None else ingested_at
    values = {
        "timestamp": time,
        **{price: round_cents(F.col(price)) for price in ("open", "high", "low", "close")},
        "volume": F.col("volume").try_cast("bigint"),
        "source": F.lit(source),
        "interval": F.lit(interval),
        "currency": F.lit(currency),
        "ingested_at": iso_utc(now),
    }
    return bars.select(*[values.get(name, F.col(name)).alias(name) for name in EVENT])


def missing_bars(bars: DataFrame, step_seconds: int = 60, ts: str = "timestamp") -> DataFrame:
    """``(symbol, timestamp)`` of every step without a bar between the first and last bar of a symbol's UTC day.

    ``ts`` is an instant or its text; rows without a usable one are left out. Before and after the bars of a
    day nothing is missing, since trading hours are not known. Each bar is compared with the next one of
    its day, of which there are at most a day's steps, and only the gap between them is unfolded.
    """
    if 86_400 % step_seconds:
        raise ValueError("a day must hold a whole number of steps")
    per_day = 86_400 // step_seconds
    step = F.floor(F.unix_seconds(F.col(ts).try_cast("timestamp")) / step_seconds)
    steps = bars.select("symbol", step.alias("_step")).where("symbol IS NOT NULL AND _step IS NOT NULL").distinct()
    steps = steps.withColumn("_day", F.floor(F.col("_step") / per_day))
    following = F.lead("_step").over(W.partitionBy("symbol", "_day").orderBy("_step"))
    gaps = steps.withColumn("_next", following).where("_next > _step + 1")
    absent = F.explode(F.sequence(F.col("_step") + 1, F.col("_next") - 1)).alias("_step")
    return gaps.select("symbol", absent).select(
        "symbol", iso_utc(F.timestamp_seconds(F.col("_step") * step_seconds)).alias("timestamp")
    )


def to_event_json(records: DataFrame) -> DataFrame:
    """Log messages: the symbol as key, the whole record as JSON value."""
    fields = F.struct(*records.columns)
    return records.select(
        F.col("symbol").alias("key"),
        F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"),
    )

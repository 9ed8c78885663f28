"""Daily bars from partial sums that are kept per load and put together on read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions import calendar_date

#: Closes are added up as decimals, which makes sums exact and so independent of their order.
EXACT = "decimal(28, 12)"


def daily_partials(silver: DataFrame, load: Column | str = "load") -> DataFrame:
    """What each load adds to each symbol's day: ``(symbol, date, load, day_high, day_low, close_sum, closes, odd_closes,
    total_volume)``. ``odd_closes`` is the sum of closes that no decimal can hold (NaN, infinite or beyond 10^16),
    NULL if there is none. Rows with an unusable date are left out."""
    close = F.col("close")
    exact = close.try_cast(EXACT)
    named = (F.col(load) if isinstance(load, str) else load).alias("load")
    bars = silver.select("symbol", calendar_date(F.col("date")).alias("date"), named, "high", "low", "close", "volume")
    return bars.where("date IS NOT NULL").groupBy("symbol", "date", "load").agg(
        F.max("high").alias("day_high"), F.min("low").alias("day_low"), F.sum(exact).alias("close_sum"),
        F.count("close").alias("closes"), F.sum(F.when(exact.isNull(), close)).alias("odd_closes"),
        F.sum("volume").alias("total_volume"),
    )


def fold(partials: DataFrame) -> DataFrame:
    """The bars of ``daily_ohlcv``, from the partials of all loads."""
    total = F.coalesce(F.sum("close_sum").cast("double"), F.lit(0.0)) + F.coalesce(F.sum("odd_closes"), F.lit(0.0))
    return partials.groupBy("symbol", "date").agg(
        F.max("day_high").alias("day_high"), F.min("day_low").alias("day_low"),
        F.try_divide(total, F.sum("closes")).alias("avg_close"), F.sum("total_volume").alias("total_volume"),
    )


def changed(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """``load`` of the partials that differ: new, gone, or with other values. ``stored`` and ``fresh`` hold the same days."""
    rest = [c for c in fresh.columns if c not in ("symbol", "date", "load")]
    both = [
        frame.select("symbol", "date", "load", F.struct(*rest).alias(side)) for frame, side in ((stored, "_old"), (fresh, "_new"))
    ]
    joined = both[0].join(both[1], ["symbol", "date", "load"], "full_outer")
    return joined.where(~F.col("_old").eqNullSafe(F.col("_new"))).select("load").distinct()

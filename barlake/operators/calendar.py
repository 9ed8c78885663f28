"""Date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions import calendar_date, date_key


def dim_date(dated: DataFrame) -> DataFrame:
    """One row per usable calendar date of any frame with a ``date`` column (string or date)."""
    days = dated.select(calendar_date(F.col("date")).alias("full_date")).dropna().distinct()
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )

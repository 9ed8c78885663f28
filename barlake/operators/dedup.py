"""Bronze -> silver: one row per natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.schemas import NATURAL_KEY


def recency(columns: Sequence[str]) -> Column:
    """Order of the versions of one key: arrival as an instant, then offset, then partition if known."""
    parts = [F.col("bronze_ingested_at").try_cast("timestamp"), F.col("kafka_offset")]
    if "kafka_partition" in columns:
        parts.append(F.col("kafka_partition"))
    return F.struct(*parts)


def newest(rows: DataFrame) -> DataFrame:
    """Latest version per ``(symbol, timestamp)``.

    ``max_by`` keeps one candidate per key in every map task before the shuffle, so a key that holds
    a third of all rows reaches its reducer as one row per map task.
    """
    rest = [c for c in rows.columns if c not in NATURAL_KEY]
    kept = rows.groupBy(*NATURAL_KEY).agg(F.max_by(F.struct(*rest), recency(rest)).alias("_row"))
    return kept.select(*[F.col(c if c in NATURAL_KEY else f"_row.{c}").alias(c) for c in rows.columns])


def clean(bronze: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """Latest version per ``(symbol, timestamp)``, then positive closes only.

    The price test comes after: if the newest version is bad the key disappears. ``keep`` names the columns of the
    result. Rows are sorted on both sides of the shuffle with all they carry, so columns that nobody asks for, or
    that follow from others, should not be among them.
    """
    if keep is None:
        return newest(bronze).where("close > 0")
    needed = {*keep, *NATURAL_KEY, "close", "bronze_ingested_at", "kafka_offset", "kafka_partition"}
    return newest(bronze.select(*[c for c in bronze.columns if c in needed])).where("close > 0").select(*keep)

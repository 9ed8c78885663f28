"""Continuous throughput: closed minutes per symbol."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barlake.operators.counters import records_per_minute


def sent(log: DataFrame) -> DataFrame:
    """What ``start`` counts, from the columns of the log source: every record by its key, valid or not.
    No payload is parsed."""
    return log.select(F.col("key").cast("string").alias("symbol"), F.col("timestamp").alias("kafka_timestamp"))


def start(
    events: DataFrame, path: str, checkpoint: str, ts: str = "kafka_timestamp",
    watermark: str = "10 minutes", trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Append each minute once the watermark has passed it; state holds open minutes only."""
    minutes = records_per_minute(events, ts, watermark)
    writer = minutes.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()

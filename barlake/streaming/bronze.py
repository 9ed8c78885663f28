"""Continuous ingestion: one log, two append-only tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from barlake.operators.validation import split_quarantine, split_valid, to_envelope, validate


def append_by_date(
    rows: DataFrame, path: str, checkpoint: str, name: str | None = None,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").outputMode("append").partitionBy("date")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(**trigger) if trigger else writer).start()


def start(
    log: DataFrame, bronze: str, quarantine: str, checkpoints: str,
    trigger: dict[str, Any] | None = None, strict_json: bool = False,
) -> list[StreamingQuery]:
    """Start both branches over a streaming log with the columns of the log source.

    Two independent queries, each with its own checkpoint: the file sink's commit log keeps each
    table exactly-once across restarts, which one shared ``foreachBatch`` would give up.
    """
    checked = validate(to_envelope(log), strict_json)
    branches = (
        (split_valid(checked), bronze, "bronze"),
        (split_quarantine(checked), quarantine, "quarantine"),
    )
    return [
        append_by_date(rows, path, f"{checkpoints}/{name}", name, trigger)
        for rows, path, name in branches
    ]

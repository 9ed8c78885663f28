"""Quarantined rows under rules of a new version."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from barlake.operators.validation import error_reason, split_valid, validate
from barlake.schemas import EVENT

#: What names a record of the log.
RECORD = ("kafka_topic", "kafka_partition", "kafka_offset")


def accepted(
    quarantine: DataFrame, reason: Callable[[Column], Column] = error_reason, strict_json: bool = False,
    moved: DataFrame | None = None,
) -> DataFrame:
    """Bronze rows of the quarantined records that the rules ``reason`` accept. Payloads are parsed anew; transport
    metadata and arrival time stay. Records in ``moved`` have been accepted before and are left out."""
    envelope = quarantine.drop("error_reason", "date", *EVENT)
    if moved is not None:
        envelope = envelope.join(moved, list(RECORD), "left_anti").select(*envelope.columns)
    return split_valid(validate(envelope, strict_json, reason))


def still_rejected(quarantine: DataFrame, moved: DataFrame) -> DataFrame:
    return quarantine.join(moved, list(RECORD), "left_anti").select(*quarantine.columns)

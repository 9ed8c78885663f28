"""Event log -> checked events -> bronze / quarantine.

All functions map DataFrame to DataFrame and work on batch and streaming frames alike. There is no
shuffle on this path.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.schemas import EVENT, ddl

# Labels and their order are part of the quarantine format. ---------------------
REQUIRED = (
    ("missing_symbol", ("symbol",)),
    ("missing_timestamp", ("timestamp",)),
    ("invalid_numeric", ("open", "high", "low", "close", "volume")),
)
# Each label is also the SQL predicate of the rule.
PRICE_RULES = (
    "close<=0",
    "volume<0",
    "high<low",
    "high<open",
    "high<close",
    "low>open",
    "low>close",
)
ENVELOPE = (
    "CAST(value AS STRING) AS raw_payload",
    "CAST(key AS STRING) AS kafka_key",
    "topic AS kafka_topic",
    "partition AS kafka_partition",
    "offset AS kafka_offset",
    "timestamp AS kafka_timestamp",
)
# ---------------------------------------------------------------------------------------------


def to_envelope(log: DataFrame, arrived: Column | None = None) -> DataFrame:
    """Keep payload and transport metadata of a keyed log as they came, plus the arrival time."""
    arrived = F.current_timestamp() if arrived is None else arrived
    return log.select(*map(F.expr, ENVELOPE), arrived.alias("bronze_ingested_at"))


def _parsed(envelope: DataFrame) -> DataFrame:
    """Parse each payload exactly once.

    A plain projection would not do: filter pushdown copies ``from_json`` into the filter once per
    rule and parses the payload again each time. A generator over a one-element array is a boundary
    no predicate crosses, so both branches parse once per event.
    """
    event = F.from_json("raw_payload", ddl(EVENT))
    return envelope.select("*", F.explode(F.array(event)).alias("_event"))


def error_reason(broken: Column) -> Column:
    """Comma-joined labels of all failed rules, in fixed order; ``''`` for a valid event.

    Price rules compare to NULL as NULL, so a missing operand keeps them silent.
    """
    labels = [F.when(broken, "malformed_json")]
    for label, fields in REQUIRED:
        complete = F.lit(True)
        for field in fields:
            complete = complete & F.col(field).isNotNull()
        labels.append(F.when(~broken & ~complete, label))
    labels += [F.when(F.expr(rule), rule) for rule in PRICE_RULES]
    return F.concat_ws(",", *labels)


def validate(
    envelope: DataFrame, strict_json: bool = False, reason: Callable[[Column], Column] = error_reason,
) -> DataFrame:
    """Add the contract fields and ``error_reason`` to the envelope. ``reason`` gives the labels of all failed rules,
    ``''`` for none, where its argument tells that the payload is broken.

    ``strict_json`` labels broken JSON that starts with ``{`` as ``malformed_json``; by default it
    shows up as missing fields, because the parser is permissive.
    """
    events = _parsed(envelope)
    broken = F.col("_event").isNull() | ~F.trim("raw_payload").startswith("{")
    if strict_json:
        broken = broken | F.try_parse_json("raw_payload").isNull()
    events = events.select(*envelope.columns, "_event.*", broken.alias("_broken"))
    return events.withColumn("error_reason", reason(F.col("_broken"))).drop("_broken")


def with_date(events: DataFrame) -> DataFrame:
    """Events with their date: the first ten characters of the time."""
    return events.withColumn("date", F.substring("timestamp", 1, 10))


def with_fields(envelope: DataFrame) -> DataFrame:
    """The contract fields of payloads that have passed ``validate``, parsed once more instead of carried along."""
    return _parsed(envelope).select(*envelope.columns, "_event.*")


def split_valid(checked: DataFrame) -> DataFrame:
    """Bronze rows: valid events with their event date."""
    return with_date(checked.where("error_reason = ''").drop("error_reason"))


def split_quarantine(checked: DataFrame) -> DataFrame:
    """Rejected rows with their reason and ingest date (the event time may be unusable)."""
    rejected = checked.where("error_reason <> ''")
    return rejected.withColumn("date", F.date_format("bronze_ingested_at", "yyyy-MM-dd"))


def reason_counts(checked: DataFrame) -> DataFrame:
    return checked.groupBy("error_reason").agg(F.count("*").alias("n"))

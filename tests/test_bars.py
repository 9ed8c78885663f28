import json
import math
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from barlake.functions import round_cents
from barlake.operators.bars import latest_bar, missing_bars, shape_contract, to_event_json
from barlake.schemas import EVENT
from barlake.sources import kafka

BARS = "symbol string, ts timestamp, open double, high double, low double, close double, volume double"


def test_cents_round_as_the_exact_value_does(spark):
    rng = random.Random(11)
    values = [2.675, 0.125, 0.375, 1.005, -2.675, -0.125, 0.0, 1e9 + 0.005, 1e13 + 0.125, 2.0**46, 1e300]
    values += [math.inf, -math.inf]
    values += [rng.randrange(10**7) / 1000 for _ in range(4000)]
    values += [rng.randrange(10**9) / 8 for _ in range(2000)]
    values += [rng.uniform(-1e6, 1e6) for _ in range(4000)]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    rows = frame.select("x", round_cents(F.col("x")).alias("r")).collect()
    assert [(r.x, r.r) for r in rows] == [(v, round(v, 2)) for v in values]
    nan, null = (
        spark.createDataFrame([(float("nan"),), (None,)], "x double").select(round_cents(F.col("x")).alias("r")).collect()
    )
    assert math.isnan(nan.r) and null.r is None


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


@pytest.fixture
def bars(spark):
    rows = [
        ("A", at("2026-07-30 19:58:00"), 1.0, 2.0, 0.5, 1.5, 100.0),
        ("A", at("2026-07-30 19:59:30"), 1.125, 2.675, 0.5, 1.5, 100.9),
        ("B", at("2026-01-30 10:00:00"), 9.0, 9.0, 9.0, 9.0, float("nan")),
        ("B", None, 7.0, 7.0, 7.0, 7.0, 1.0),
        ("C", None, 7.0, 7.0, 7.0, 7.0, 1.0),
    ]
    return spark.createDataFrame(rows, BARS)


def test_latest_bar_per_symbol(bars, plan_of):
    latest = latest_bar(bars)
    assert {r.symbol: r.open for r in latest.collect()} == {"A": 1.125, "B": 9.0}
    assert latest.columns == bars.columns
    assert "SortAggregate" not in plan_of(latest)


def test_latest_bar_breaks_ties(spark):
    rows = [("A", at("2026-07-30 10:00:00"), float(i), 0.0, 0.0, 0.0, float(i)) for i in (3, 9, 5)]
    assert latest_bar(spark.createDataFrame(rows, BARS), tie="volume").first().open == 9.0


def test_contract_record(bars):
    fetched = F.lit("2026-07-30 20:00:00Z").cast("timestamp")
    shaped = shape_contract(latest_bar(bars), ingested_at=fetched)
    assert [c.split("_NTZ")[0] for c in shaped.columns] == list(EVENT)
    assert shaped.dtypes == list(EVENT.items())
    records = {r.symbol: tuple(r) for r in shaped.collect()}
    assert records["A"] == (
        "A", "2026-07-30T19:59:30Z", 1.12, 2.67, 0.5, 1.5, 100, "yfinance", "1m", "USD", "2026-07-30T20:00:00Z",
    )
    assert records["B"][6] is None  # not a whole number of shares: left for validation to reject


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("wall, utc", [
    ("2025-10-02 11:07:00", "2025-10-02T15:07:00Z"),
    ("2024-12-24 12:58:00", "2024-12-24T17:58:00Z"),
    ("2026-03-08 03:30:00", "2026-03-08T07:30:00Z"),
])
def test_eastern_time_becomes_utc(spark, session_zone, wall, utc):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        one = spark.range(1).select(
            F.lit("A").alias("symbol"), F.lit(wall).cast("timestamp_ntz").alias("ts"),
            *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "volume")],
        )
        assert shape_contract(one, zone="America/New_York").first().timestamp == utc
        instant = one.withColumn("ts", F.lit(utc).cast("timestamp"))
        assert shape_contract(instant).first().timestamp == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_event_json_keeps_every_field(bars):
    fetched = F.lit("2026-07-30 20:00:00Z").cast("timestamp")
    messages = {r.key: json.loads(r.value) for r in to_event_json(shape_contract(latest_bar(bars), ingested_at=fetched)).collect()}
    assert list(messages["A"]) == list(EVENT)
    assert messages["A"]["close"] == 1.5 and messages["A"]["volume"] == 100
    assert messages["B"]["volume"] is None


def test_log_options():
    assert kafka.source_options("h:9092", "t") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest",
    }
    assert kafka.source_options("h:9092", "t", min_partitions=64)["minPartitions"] == "64"
    assert kafka.sink_options("h:9092", "t") == {
        "kafka.bootstrap.servers": "h:9092", "topic": "t", "kafka.acks": "all", "kafka.retries": "5",
    }


def test_missing_bars_equal_a_walk_over_each_day(spark):
    rng = random.Random(5)
    held = {(s, 1_700_000_000 - 1_700_000_000 % 300 + 300 * rng.randrange(900)) for s in "PQR" for _ in range(150)}
    rows = [(s, datetime.fromtimestamp(t + rng.randrange(300), timezone.utc).isoformat()) for s, t in held]
    rows += rows[:20] + [("P", None), (None, rows[0][1]), ("Q", "no time"), ("Z", rows[0][1])]
    days = {}
    for symbol, t in held:
        days.setdefault((symbol, t // 86_400), set()).add(t)
    want = sorted(
        (symbol, datetime.fromtimestamp(t, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"))
        for (symbol, _), times in days.items() for t in range(min(times), max(times), 300) if t not in times
    )
    frame = spark.createDataFrame(rows, "symbol string, timestamp string")
    assert sorted(tuple(r) for r in missing_bars(frame, 300).collect()) == want
    assert missing_bars(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        missing_bars(frame, 7)

import json
from datetime import datetime, timedelta, timezone

import pytest

from barlake import __main__ as commands
from barlake.plans import jobs
from barlake.settings import Settings
from barlake.sources import lake
from barlake.streaming import bronze, throughput

LOG = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
NOW = {"availableNow": True}


def message(offset, symbol="A", close=2.0, minute=0):
    body = dict(symbol=symbol, timestamp=f"2026-07-{28 + offset % 3}T10:00:00Z", open=2.0, high=3.0, low=1.0, close=close, volume=5)
    when = datetime(2026, 7, 30, tzinfo=timezone.utc) + timedelta(minutes=minute)
    return (symbol.encode(), json.dumps(body).encode(), "stock-prices", 0, offset, when)


def append(spark, path, rows):
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path):
    log = spark.readStream.schema(LOG).parquet(f"{tmp_path}/log")
    queries = bronze.start(log, f"{tmp_path}/bronze", f"{tmp_path}/quarantine", f"{tmp_path}/ck", NOW)
    for query in queries:
        query.awaitTermination()
        assert query.exception() is None
    return spark.read.parquet(f"{tmp_path}/bronze"), spark.read.parquet(f"{tmp_path}/quarantine")


def test_split_restart_and_growth(spark, tmp_path):
    first = [message(i, close=-1.0 if i % 4 == 0 else 2.0) for i in range(40)]
    append(spark, f"{tmp_path}/log", first)
    valid, rejected = run(spark, tmp_path)
    assert sorted(r.kafka_offset for r in rejected.collect()) == list(range(0, 40, 4))
    assert sorted(r.kafka_offset for r in valid.collect() + rejected.collect()) == list(range(40))
    assert {str(r.date) for r in valid.select("date").distinct().collect()} == {
        "2026-07-28", "2026-07-29", "2026-07-30",
    }

    valid, rejected = run(spark, tmp_path)  # nothing new: a restart adds nothing
    assert (valid.count(), rejected.count()) == (30, 10)

    append(spark, f"{tmp_path}/log", [message(40), message(41, close=0.0)])
    valid, rejected = run(spark, tmp_path)
    assert (valid.count(), rejected.count()) == (31, 11)
    assert "/date=" in valid.inputFiles()[0]
    assert lake.exists(spark, f"{tmp_path}/ck/bronze") and lake.exists(spark, f"{tmp_path}/ck/quarantine")


def test_throughput_appends_closed_minutes(spark, tmp_path):
    schema = "symbol string, kafka_timestamp timestamp"

    def arrive(*events):
        rows = [(s, datetime(2026, 7, 30, tzinfo=timezone.utc) + timedelta(seconds=t)) for s, t in events]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        query = throughput.start(
            stream, f"{tmp_path}/out", f"{tmp_path}/ck", watermark="2 minutes", trigger=NOW
        )
        query.awaitTermination()
        return {(r.symbol, r.minute.minute): r.records for r in spark.read.parquet(f"{tmp_path}/out").collect()}

    arrive(("A", 0), ("A", 30), ("B", 59), ("A", 61))
    got = arrive(("A", 400), ("A", 45))  # one late event within the watermark of its batch
    assert got == {("A", 0): 3, ("B", 0): 1, ("A", 1): 1}
    got = arrive(("A", 5), ("A", 900))  # far too late: its minute is closed
    assert got == {("A", 0): 3, ("B", 0): 1, ("A", 1): 1, ("A", 6): 1}


def test_batch_refines_what_the_stream_wrote(spark, tmp_path):
    """The sink's commit log decides which files count; repeated events end up once in silver."""
    events = [message(i, symbol=f"S{i % 2}", close=-1.0 if i % 10 == 0 else 2.0) for i in range(40)]
    append(spark, f"{tmp_path}/log", events)
    run(spark, tmp_path)
    layers = jobs.Layers(f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/gold")
    report = jobs.run_batch(spark, layers, run_date="2026-07-28", names={"S0": "Zero"})
    assert report["silver"] == {"bronze": 36, "silver": 6}
    assert report["gold"] == {"fact_daily_prices": 6, "dim_date": 3, "undated": 0}

    append(spark, f"{tmp_path}/log", [message(60, symbol="S9"), message(61, symbol="S1", close=2.5)])
    run(spark, tmp_path)
    report = jobs.run_batch(spark, layers, run_date="2026-07-30", names={"S0": "Zero"}, dates=["2026-07-28", "2026-07-29"])
    assert report["silver"] == {"bronze": 26, "silver": 5}
    star = jobs.read_star(spark, layers)
    assert star.fact.count() == 7
    assert star.ticker.where("symbol = 'S9' AND is_current").count() == 1
    latest = spark.read.parquet(layers.silver).where("symbol = 'S1' AND date = '2026-07-29'").first()
    assert (latest.close, latest.kafka_offset) == (2.5, 61)


def test_commands_from_bars_to_minutes(spark, tmp_path, monkeypatch):
    """``publish`` and ``throughput`` with files in the log's place."""
    bars = "symbol string, ts timestamp_ntz, open double, high double, low double, close double, volume double"
    rows = [(s, datetime(2026, 3, 2, 14, m), 4.0, 5.0, 3.0, 4.5 + m, 70.0) for s in ("U", "V") for m in (3, 1, 2)]
    spark.createDataFrame(rows, bars).write.parquet(f"{tmp_path}/bars")
    messages = []
    monkeypatch.setattr(commands.kafka, "write_batch", lambda frame, options: messages.append((frame.collect(), options)))
    args = commands.arguments(["publish", "--bars", f"{tmp_path}/bars", "--zone", "America/Chicago"])
    commands.publish(spark, Settings({"KAFKA_TOPIC": "t"}), args)
    [(sent, options)] = messages
    assert options["topic"] == "t" and options["kafka.acks"] == "all"
    assert {r.key: (json.loads(r.value)["timestamp"], json.loads(r.value)["close"]) for r in sent} == {
        "U": ("2026-03-02T20:03:00Z", 7.5), "V": ("2026-03-02T20:03:00Z", 7.5),
    }
    with pytest.raises(SystemExit):
        commands.publish(spark, Settings({}), commands.arguments(["publish"]))

    noon = datetime(2026, 3, 2, 12, tzinfo=timezone.utc)
    log = [(r.key.encode(), r.value.encode(), "t", 0, i, noon) for i, r in enumerate(sent)]
    log += [(b"U", b"not json", "t", 0, 9, noon), (b"V", None, "t", 0, 10, noon + timedelta(hours=1))]
    append(spark, f"{tmp_path}/log", log)
    stream = spark.readStream.schema(LOG).parquet(f"{tmp_path}/log")
    paths = ["--minutes", f"{tmp_path}/minutes", "--checkpoints", f"{tmp_path}/ck"]
    for _ in range(2):  # the second run closes what the first one's watermark has passed
        [query] = commands.start(stream, commands.arguments(["throughput", "--every", "1 second", *paths]))
        query.processAllAvailable()
        query.stop()
    found = spark.read.parquet(f"{tmp_path}/minutes").collect()
    assert {(r.symbol, r.records) for r in found} == {("U", 2), ("V", 1)}

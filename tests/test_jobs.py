import random
import re
from contextlib import contextmanager
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barlake.operators import scd2
from barlake.operators.facts import daily_ohlcv
from barlake.operators.partials import fold
from barlake.operators.validation import error_reason, split_quarantine, split_valid, to_envelope, validate
from barlake.plans import jobs
from barlake.plans.analytics import QUERIES
from barlake.session import SHUFFLE_PARTITIONS, SPLIT_BYTES, tasks_sized_for
from barlake.sources import lake
from barlake.sources.jdbc import Warehouse, load_table

BRONZE = (
    "symbol string, timestamp string, high double, low double, close double, volume bigint, currency string, "
    "source string, bronze_ingested_at timestamp, kafka_offset bigint, date string"
)
NAMES = {"S0": "Zero", "S1": "One"}


def bronze_rows(count, seed=0, offset=0, currency="USD", days=(1, 2, 3)):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        day = f"2026-01-{rng.choice(days):02d}"
        close = float(rng.randrange(-1, 20))
        rows.append((
            f"S{rng.randrange(4)}", f"{day}T{rng.randrange(24):02d}:00:00Z", close + 1, close - 1, close,
            rng.randrange(100), currency, "feed", None, offset + i, day,
        ))
    return rows


def append_bronze(spark, layers, rows):
    spark.createDataFrame(rows, BRONZE).write.mode("append").partitionBy("date").parquet(layers.bronze)


@pytest.fixture
def layers(tmp_path):
    return jobs.Layers(f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/gold")


class Crash(Exception):
    pass


def contents(frame):
    return sorted(map(str, frame.collect()))


def test_batch_twice_then_a_change(spark, layers):
    append_bronze(spark, layers, bronze_rows(300))
    report = jobs.run_batch(spark, layers, run_date="2026-01-02", names=NAMES)
    silver = spark.read.parquet(layers.silver)
    assert report["silver"] == {"bronze": 300, "silver": silver.count()}
    star = jobs.read_star(spark, layers)
    assert report["gold"] == {"fact_daily_prices": star.fact.count(), "dim_date": 3, "undated": 0}
    assert star.fact.count() == silver.select("symbol", "date").distinct().count()
    assert star.ticker.count() == 4
    # Days before the first load have no version yet.
    assert {r.date_key for r in star.fact.where("ticker_key IS NULL").collect()} == {20260101}
    assert {r.date_key for r in star.fact.where("ticker_key IS NOT NULL").collect()} == {20260102, 20260103}

    before = contents(star.ticker), contents(star.fact), contents(star.calendar)
    jobs.run_batch(spark, layers, run_date="2026-01-03", names=NAMES)
    star = jobs.read_star(spark, layers)
    assert (contents(star.ticker), contents(star.fact), contents(star.calendar)) == before

    append_bronze(spark, layers, bronze_rows(50, seed=1, offset=300, currency="EUR", days=(4,)))
    jobs.run_batch(spark, layers, run_date="2026-01-04", names=NAMES)
    star = jobs.read_star(spark, layers)
    assert scd2.violations(star.ticker).count() == 0
    assert star.ticker.where("is_current AND currency = 'EUR'").count() == 4
    assert star.ticker.where("NOT is_current").count() == 4
    joined = star.run("daily_summary").collect()
    assert {r.full_date for r in joined} == {date(2026, 1, 2), date(2026, 1, 3), date(2026, 1, 4)}
    for name in QUERIES:
        assert star.run(name).columns


def test_refreshing_dates_equals_the_full_rebuild(spark, layers, tmp_path):
    append_bronze(spark, layers, bronze_rows(300))
    jobs.refine_silver(spark, layers)
    append_bronze(spark, layers, bronze_rows(200, seed=5, offset=300, days=(2,)))
    jobs.refine_silver(spark, layers, dates=["2026-01-02"])
    refreshed = contents(spark.read.parquet(layers.silver))
    full = jobs.Layers(layers.bronze, f"{tmp_path}/full", layers.gold)
    jobs.refine_silver(spark, full)
    assert refreshed == contents(spark.read.parquet(full.silver))


@pytest.mark.parametrize("changed", [(2,), (4,), (1, 4), ()])
def test_incremental_run_equals_full_run(spark, layers, tmp_path, changed):
    """Events arrive late, early or not at all; facts from the run date on get the new versions."""
    full = jobs.Layers(layers.bronze, f"{tmp_path}/silver2", f"{tmp_path}/gold2")
    append_bronze(spark, layers, bronze_rows(200, days=(1, 2, 3, 5)))
    for target in (layers, full):
        jobs.run_batch(spark, target, run_date="2026-01-02", names=NAMES)
    if changed:
        append_bronze(spark, layers, bronze_rows(80, seed=7, offset=200, currency="EUR", days=changed))
    dates = [f"2026-01-{day:02d}" for day in changed]
    jobs.run_batch(spark, layers, run_date="2026-01-04", names=NAMES, dates=dates)
    jobs.run_batch(spark, full, run_date="2026-01-04", names=NAMES)
    one, two = jobs.read_star(spark, layers), jobs.read_star(spark, full)
    for table in ("ticker", "fact", "calendar"):
        assert contents(getattr(one, table)) == contents(getattr(two, table)), table


def test_refreshing_a_date_to_nothing_removes_it(spark, layers):
    append_bronze(spark, layers, bronze_rows(60))
    jobs.refine_silver(spark, layers)
    spoiled = spark.read.parquet(layers.silver).where("date = '2026-01-02'").selectExpr(
        "symbol", "timestamp", "high", "low", "-1D AS close", "volume", "currency", "source",
        "bronze_ingested_at", "kafka_offset + 1000 AS kafka_offset", "CAST(date AS STRING) AS date",
    )
    append_bronze(spark, layers, spoiled.collect())
    report = jobs.refine_silver(spark, layers, dates=["2026-01-02"])
    assert report["silver"] == 0 and report["bronze"] > 0
    left = {str(r.date) for r in spark.read.parquet(layers.silver).select("date").distinct().collect()}
    assert left == {"2026-01-01", "2026-01-03"}


def test_only_asked_dates_are_scanned(spark, layers, plan_of):
    append_bronze(spark, layers, bronze_rows(60))
    executed = plan_of(lake.read(spark, layers.bronze, ["2026-01-02"]), "formatted")
    assert re.search(r"PartitionFilters: \[.*date#\d+ = 2026-01-02", executed)
    assert spark.read.parquet(layers.bronze).count() == 60


def test_a_hot_date_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(200_000).selectExpr(
        "id", "sha2(CAST(id AS STRING), 256) AS text", "IF(id % 3 > 0, 'hot', CAST(id % 50 AS STRING)) AS date"
    )
    with small_tasks(spark, 16):
        assert lake.write_partitions(rows, f"{tmp_path}/t", "date", ["id"]) == {"rows": 200_000}
    files = spark.read.parquet(f"{tmp_path}/t").inputFiles()
    assert len([f for f in files if "date=hot" in f]) >= 10
    assert len(files) <= 16 + 51


@contextmanager
def small_tasks(spark, partitions):
    changed = {"spark.sql.shuffle.partitions": partitions, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, str(value))
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_tasks_follow_the_size_of_the_input(spark, tmp_path):
    rows = spark.range(90_000).selectExpr("id", "CAST(id % 3 AS STRING) AS date")
    rows.write.partitionBy("date").parquet(f"{tmp_path}/t")
    size = lake.stored_bytes(spark, f"{tmp_path}/t")
    dates = [lake.stored_bytes(spark, f"{tmp_path}/t", [d]) for d in "012"]
    assert size > 100_000 and size * 0.9 < sum(dates) <= size * 1.1
    assert lake.stored_bytes(spark, f"{tmp_path}/t", ["9"]) == 0
    before = spark.conf.get(SPLIT_BYTES), spark.conf.get(SHUFFLE_PARTITIONS)
    with tasks_sized_for(spark, size, task_bytes=10_000) as (split, partitions):
        assert (split, partitions) == (128 << 20, -(-size // 10_000))
        assert spark.conf.get(SHUFFLE_PARTITIONS) == str(partitions)
    with tasks_sized_for(spark, 100 << 40) as (split, partitions):
        assert (split, partitions) == (1099511628, 40_000)
        assert spark.conf.get(SPLIT_BYTES) == "1099511628b"
        assert spark.read.parquet(f"{tmp_path}/t").count() == 90_000
    with tasks_sized_for(spark, size) as (split, partitions):
        assert (split, partitions) == (128 << 20, 4)
    assert (spark.conf.get(SPLIT_BYTES), spark.conf.get(SHUFFLE_PARTITIONS)) == before


def test_snapshots(spark, tmp_path):
    root = f"{tmp_path}/dim"
    assert lake.latest_snapshot(spark, root) is None
    first = lake.write_snapshot(spark.range(3), root)
    assert lake.latest_snapshot(spark, root) == first
    # A snapshot may read the one before it.
    second = lake.write_snapshot(spark.read.parquet(first).selectExpr("id + 1 AS id"), root)
    assert lake.latest_snapshot(spark, root) == second
    assert sorted(r.id for r in spark.read.parquet(second).collect()) == [1, 2, 3]
    # One that never finished is passed over, and its number is not used again.
    (tmp_path / "dim" / "snapshot=3").mkdir()
    assert lake.latest_snapshot(spark, root) == second
    assert lake.write_snapshot(spark.range(1), root).endswith("snapshot=4")


def test_old_snapshots_go_and_unfinished_ones_are_no_first_load(spark, tmp_path):
    root = f"{tmp_path}/dim"
    for n in range(6):
        lake.write_snapshot(spark.range(n + 1), root)
    assert sorted(p.name for p in (tmp_path / "dim").iterdir()) == [f"snapshot={n}" for n in (4, 5, 6)]
    assert spark.read.parquet(lake.latest_snapshot(spark, root)).count() == 6
    (tmp_path / "other" / "snapshot=3").mkdir(parents=True)
    with pytest.raises(RuntimeError, match="none is complete"):
        lake.latest_snapshot(spark, f"{tmp_path}/other")


def test_a_lost_observation_keeps_the_fresh_rows(spark, tmp_path, monkeypatch):
    def rows(start):
        return spark.range(start, start + 20).selectExpr("id", "concat('d', id % 2) AS date")

    lake.write_partitions(rows(0), f"{tmp_path}/t", "date", ["id"])
    monkeypatch.setattr(lake, "observed", lambda metrics, otherwise: otherwise())
    written = lake.write_partitions(rows(100), f"{tmp_path}/t", "date", ["id"], only=["d0", "d1", "d7"])
    assert written == {"rows": 20}
    assert {r.id for r in spark.read.parquet(f"{tmp_path}/t").collect()} == set(range(100, 120))
    gone = lake.write_partitions(rows(200).where("id < 0"), f"{tmp_path}/t", "date", ["id"], only=["d1"])
    assert gone == {"rows": 0}
    assert {r.date for r in spark.read.parquet(f"{tmp_path}/t").collect()} == {"d0"}
    assert lake.write_partitions(rows(300), f"{tmp_path}/t", "date", ["id"]) == {"rows": 20}


def test_names_that_paths_escape(spark, tmp_path):
    path, value = f"{tmp_path}/t", "2026/07/30 10:00"
    rows = spark.range(5).selectExpr("id", f"'{value}' AS date")
    lake.write_partitions(rows, path, "date", ["id"])
    assert lake.stored_bytes(spark, path, [value]) > 0
    assert lake.read(spark, path, [value]).count() == 5
    lake.write_partitions(rows.where("id < 0"), path, "date", ["id"], only=[value])
    assert lake.stored_bytes(spark, path, [value]) == 0


def test_dates_are_text(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.sql("SELECT 1 AS id, '20260730' AS date UNION ALL SELECT 2, '1769817600'").write.partitionBy("date").parquet(path)
    assert dict(lake.read(spark, path).dtypes)["date"] == "string"
    spark.sql("SELECT 1 AS id, '2026-7-3' AS date UNION ALL SELECT 2, '2026-07-03'").write.partitionBy("date").parquet(f"{path}2")
    assert [r.id for r in lake.read(spark, f"{path}2", ["2026-7-3"]).collect()] == [1]


def test_epoch_texts_as_dates_do_not_stop_gold(spark, layers):
    append_bronze(spark, layers, [("S0", "1769817600", 2.0, 1.0, 1.5, 1, "USD", "feed", None, 1, "1769817600")])
    report = jobs.run_batch(spark, layers, run_date="2026-01-01", names=NAMES)
    assert report["gold"] == {"fact_daily_prices": 0, "dim_date": 0, "undated": 1}


def test_mistaken_dates_are_refused(spark, layers):
    append_bronze(spark, layers, bronze_rows(40) + [("S0", "odd", 2.0, 1.0, 1.5, 1, "USD", "f", None, 99, "odd")])
    jobs.run_batch(spark, layers, run_date="2026-01-10", names=NAMES)
    for date in ("2026-1-02", "20260102", "2026-W01-4", "2026-13-01", ""):
        with pytest.raises(ValueError):
            jobs.run_batch(spark, layers, run_date="2026-01-11", names=NAMES, dates=[date])
    jobs.run_batch(spark, layers, run_date="2026-01-11", names=NAMES, dates=["odd", "2026-01-09"])
    old = jobs.read_dim_ticker(spark, layers)
    changed = spark.sql("SELECT 'S0' AS symbol, 'Other' AS company_name, 'USD' AS currency, 'feed' AS source")
    with pytest.raises(Exception, match="before the newest"):
        scd2.merge(old, changed, "2026-01-05").collect()


def named(star):
    """Facts with the attributes of their versions, and the versions, without keys."""
    versions = star.ticker.drop("ticker_key")
    facts = star.fact.join(star.ticker.drop("effective_to", "is_current"), "ticker_key", "left").drop("ticker_key")
    return contents(facts), contents(versions)


@pytest.mark.parametrize("partial, crash", [(False, 0), (True, 5)])
def test_a_late_load_equals_loads_in_order(spark, tmp_path, monkeypatch, partial, crash):
    """Runs of the days 1, 5 and then 3 leave what runs of the days 1, 3 and 5 leave, also if the late one stops
    after some write and the next run, in order, has to refresh its facts."""
    late = jobs.Layers(f"{tmp_path}/b1", f"{tmp_path}/s1", f"{tmp_path}/g1")
    ordered = jobs.Layers(f"{tmp_path}/b2", f"{tmp_path}/s2", f"{tmp_path}/g2")
    batches = [
        (1, bronze_rows(30, 1, 0, "USD", (1,))), (3, bronze_rows(30, 2, 100, "EUR", (2, 3))),
        (5, bronze_rows(12, 3, 200, "USD", (4, 5))),
    ]
    for day, rows in batches:
        append_bronze(spark, ordered, rows)
        jobs.run_batch(spark, ordered, run_date=f"2026-01-0{day}", names=NAMES)
        append_bronze(spark, late, rows)
        if day != 3:
            jobs.run_batch(spark, late, run_date=f"2026-01-0{day}", names=NAMES)
    dates = ["2026-01-02", "2026-01-03"] if partial else None
    if crash:
        with monkeypatch.context() as patch:
            done = [0]
            for name in ("write_partitions", "write_snapshot"):
                def writer(*args, _write=getattr(lake, name), **kwargs):
                    result = _write(*args, **kwargs)
                    done[0] += 1
                    if done[0] == crash:
                        raise Crash
                    return result
                patch.setattr(lake, name, writer)
            with pytest.raises(Crash):
                jobs.run_batch(spark, late, run_date="2026-01-03", names=NAMES, dates=dates)
        for layers in (late, ordered):
            jobs.run_batch(spark, layers, run_date="2026-01-06", names=NAMES, dates=["2026-01-05"] if layers is late else None)
    else:
        jobs.run_batch(spark, late, run_date="2026-01-03", names=NAMES, dates=dates)
    assert named(jobs.read_star(spark, late)) == named(jobs.read_star(spark, ordered))
    assert scd2.violations(jobs.read_dim_ticker(spark, late)).count() == 0


def test_partials_follow_late_events(spark, layers):
    """Random events in loads that come in any order: partials put together equal the bars, and only loads that
    won or lost a row are rewritten."""
    rng = random.Random(4)
    for turn in range(4):
        days = rng.sample((1, 2, 3, 4), 2)
        rows = bronze_rows(25, 40 + turn, 1000 * turn, "USD", days)
        rows = [(*r[:8], datetime(2026, 2, 1 + rng.choice([turn, turn // 2])), *r[9:]) for r in rows]
        before = set()
        if turn:
            before = {(r.load, str(r)) for r in jobs.read_partials(spark, layers).collect()}
        append_bronze(spark, layers, rows)
        dates = None if turn == 0 else [f"2026-01-0{d}" for d in days]
        jobs.refine_silver(spark, layers, dates)
        by_day = F.to_date("bronze_ingested_at")
        loads = jobs.refresh_partials(spark, layers, dates, by_day)
        after = {(r.load, str(r)) for r in jobs.read_partials(spark, layers).collect()}
        assert {load for load, _ in before ^ after} == set(loads) or turn == 0
        want = daily_ohlcv(lake.read(spark, layers.silver))
        assert contents(fold(jobs.read_partials(spark, layers))) == contents(want)
    assert jobs.refresh_partials(spark, layers, None, by_day) == []


def test_readers_see_the_three_tables_together(spark, layers, monkeypatch):
    """Between any two writes of a run, the star is the one before; after the mark it is the new one."""
    append_bronze(spark, layers, bronze_rows(40, days=(1, 2)))
    jobs.run_batch(spark, layers, run_date="2026-01-02", names=NAMES)

    def tables(star=None):
        star = star or jobs.read_star(spark, layers)
        return contents(star.fact), contents(star.ticker), contents(star.calendar)

    old_star, states = jobs.read_star(spark, layers), []
    before = tables()
    append_bronze(spark, layers, bronze_rows(40, 3, 100, "EUR", (2, 3)))
    with monkeypatch.context() as patch:
        for name in ("write_partitions", "write_snapshot"):
            def writer(*args, _write=getattr(lake, name), **kwargs):
                result = _write(*args, **kwargs)
                states.append(tables())
                return result
            patch.setattr(lake, name, writer)
        jobs.run_batch(spark, layers, run_date="2026-01-03", names=NAMES, dates=["2026-01-02", "2026-01-03"])
    after = tables()
    assert before != after and states[0] == before and states[-1] == after
    turn = states.index(after)
    assert all(state == before for state in states[:turn]) and all(state == after for state in states[turn:])
    assert tables(old_star) == before  # who has opened the star reads it to the end
    for day in range(4, 9):  # states that nobody needs any more go
        jobs.run_batch(spark, layers, run_date=f"2026-01-0{day}", names=NAMES, dates=["2026-01-03"])
    assert tables()[0] == after[0] and len(lake.folders(spark, layers.fact)) <= 5


def quarantined(spark):
    """Six records: two that a laxer rule accepts, two that the laxest does, one broken, one without a key."""
    payload = '{"symbol":"%s","timestamp":"2026-01-0%dT00:00:00Z","open":1,"high":%s,"low":1,"close":%s,"volume":%s}'
    texts = [payload % ("A", 1, 2, 3, 5), payload % ("B", 2, 2, 3, 5), payload % ("A", 3, 2, 1, -5),
             payload % ("C", 3, 2, 1, -5), "not json", payload % ("D", 4, 2, -1, 5)]
    log = spark.createDataFrame([(None, t.encode(), "t", i % 2, i, datetime(2026, 1, 9)) for i, t in enumerate(texts)],
                                "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp")
    return split_quarantine(validate(to_envelope(log)))


def lax(*allowed):
    def reason(broken):
        labels = F.split(error_reason(broken), ",")
        left = F.filter(labels, lambda label: ~label.isin(*allowed))
        return F.array_join(left, ",")

    return reason


@pytest.mark.parametrize("crash", ["write_partitions", "write", "touch"])
def test_replay_moves_every_record_once(spark, tmp_path, monkeypatch, crash):
    """Two versions of rules, a crash after each write, and runs that are repeated."""
    bronze_schema = split_valid(validate(to_envelope(spark.createDataFrame(
        [], "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp")))).schema
    quarantine, root = quarantined(spark).cache(), f"{tmp_path}/replays"
    bronze = spark.createDataFrame([], bronze_schema)
    assert quarantine.count() == 6 and jobs.bronze_with_replays(spark, bronze, root).count() == 0

    def both():
        moved = jobs.bronze_with_replays(spark, bronze, root).select("kafka_offset").collect()
        left = jobs.quarantine_left(spark, quarantine, root).select("kafka_offset").collect()
        return sorted(r[0] for r in moved), sorted(r[0] for r in left)

    for version, rules, want in (("1", lax("high<close"), [0, 1]), ("2", lax("high<close", "volume<0"), [0, 1, 2, 3])):
        state = both()
        with monkeypatch.context() as patch:
            def writer(*args, _write=getattr(lake, crash), **kwargs):
                if crash == "touch":
                    raise Crash  # just before the mark
                _write(*args, **kwargs)
                raise Crash
            patch.setattr(lake, crash, writer)
            with pytest.raises(Crash):
                jobs.replay_quarantine(spark, quarantine, root, version, rules)
        assert both() == state
        assert jobs.replay_quarantine(spark, quarantine, root, version, rules) == 2
        assert both() == (want, sorted(set(range(6)) - set(want)))
        assert jobs.replay_quarantine(spark, quarantine, root, version, rules) == 0
    rows = jobs.bronze_with_replays(spark, bronze, root).collect()
    assert {(r.symbol, r.timestamp[:10], str(r.date), r.kafka_topic) for r in rows} == {
        ("A", "2026-01-01", "2026-01-01", "t"), ("B", "2026-01-02", "2026-01-02", "t"),
        ("A", "2026-01-03", "2026-01-03", "t"), ("C", "2026-01-03", "2026-01-03", "t"),
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_any_sequence_of_runs_equals_the_full_build(spark, tmp_path, monkeypatch, seed):
    """Appended, corrected and removed events, and crashes after any write with a retry on the next day:
    what the runs of some dates leave equals full runs over the same bronze on the same days."""
    rng = random.Random(seed)
    part = jobs.Layers(f"{tmp_path}/bronze", f"{tmp_path}/s1", f"{tmp_path}/g1")
    full = jobs.Layers(part.bronze, f"{tmp_path}/s2", f"{tmp_path}/g2")
    append_bronze(spark, part, bronze_rows(40, seed, days=(1, 2, 3)))
    for target in (part, full):
        jobs.run_batch(spark, target, run_date="2026-01-03", names=NAMES)
    day, offset = 4, 1000
    for turn, change in enumerate(["append", "correct", "remove", "append"]):
        days = rng.sample(range(1, day + 1), 2)
        dates = [f"2026-01-{d:02d}" for d in days]
        if change == "remove":  # a symbol leaves a date
            stored = spark.read.schema(BRONZE).parquet(part.bronze)
            left = stored.where(stored.date.isin(dates) & (stored.symbol != f"S{rng.randrange(4)}")).collect()
            for date in dates:
                lake.drop(spark, f"{part.bronze}/date={date}")
            append_bronze(spark, part, left)
        else:
            currency = "USD" if change == "correct" else rng.choice(["EUR", "CHF"])
            append_bronze(spark, part, bronze_rows(15, seed * 10 + turn, offset, currency, days))
            offset += 1000
        writers = ["write_partitions", "write_snapshot", "write"]
        crash_after = rng.randrange(1, 5)
        with monkeypatch.context() as patch:
            done = [0]
            for name in writers:
                def writer(*args, _write=getattr(lake, name), **kwargs):
                    result = _write(*args, **kwargs)
                    done[0] += 1
                    if done[0] == crash_after:
                        raise Crash
                    return result
                patch.setattr(lake, name, writer)
            with pytest.raises(Crash):
                jobs.run_batch(spark, part, run_date=f"2026-01-{day:02d}", names=NAMES, dates=dates)
        # The full side: the same versions exist only if the crashed run got as far as the dimension.
        if crash_after >= 3:
            jobs.run_batch(spark, full, run_date=f"2026-01-{day:02d}", names=NAMES)
        day += 1
        jobs.run_batch(spark, part, run_date=f"2026-01-{day:02d}", names=NAMES, dates=dates)
        jobs.run_batch(spark, full, run_date=f"2026-01-{day:02d}", names=NAMES)
        one, two = jobs.read_star(spark, part), jobs.read_star(spark, full)
        for table in ("ticker", "fact", "calendar"):
            assert contents(getattr(one, table)) == contents(getattr(two, table)), (change, table)
        assert scd2.violations(one.ticker).count() == 0
        day += 1


def test_only_a_missing_dimension_is_a_first_load(spark, layers, tmp_path):
    assert jobs.read_dim_ticker(spark, layers) is None
    broken = tmp_path / "gold" / "dim_ticker" / "snapshot=1"
    broken.mkdir(parents=True)
    (broken / "_SUCCESS").touch()
    (broken / "part-0.parquet").write_bytes(b"garbage")
    with pytest.raises(Exception):
        jobs.read_dim_ticker(spark, layers).collect()


def test_dirty_date_directory_does_not_stop_gold(spark, layers):
    rows = bronze_rows(60) + [("S0", "whenever", 2.0, 1.0, 1.5, 1, "USD", "feed", None, 999, "whenever")]
    append_bronze(spark, layers, rows)
    report = jobs.run_batch(spark, layers, run_date="2026-01-01", names=NAMES)
    star = jobs.read_star(spark, layers)
    assert report["gold"]["undated"] == 1
    assert spark.read.parquet(layers.silver).where("timestamp = 'whenever'").count() == 1
    assert star.calendar.count() == 3


class Recorder(Warehouse):
    """Takes the place of a database."""

    def __init__(self, lose=0):
        super().__init__("jdbc:postgresql://h/db")
        object.__setattr__(self, "tables", {})
        object.__setattr__(self, "lose", lose)

    def save(self, frame, table):
        self.tables[table] = frame.collect()

    def rows(self, spark, table):
        return len(self.tables[table]) - self.lose


def test_load_replaces_the_three_tables(spark, layers):
    append_bronze(spark, layers, bronze_rows(60))
    target = Recorder()
    report = jobs.run_batch(spark, layers, target, run_date="2026-01-01", names=NAMES)
    assert set(target.tables) == {"dim_date", "dim_ticker", "fact_daily_prices"}
    assert report["warehouse"] == {name: len(rows) for name, rows in target.tables.items()}


def test_load_notices_lost_or_repeated_rows(spark):
    assert load_table(spark.range(5), "t", Recorder()) == 5
    for lose in (1, -1):
        with pytest.raises(RuntimeError):
            load_table(spark.range(5), "t", Recorder(lose))


def test_warehouse_options():
    target = Warehouse("jdbc:postgresql://h:5432/db", "u", "secret", connections=8)
    assert target.options("dim_date") == {
        "url": "jdbc:postgresql://h:5432/db", "dbtable": "dim_date", "user": "u", "password": "secret",
        "driver": "org.postgresql.Driver", "numPartitions": "8", "batchsize": "10000",
    }
    assert "secret" not in repr(target)


def test_log_to_star_end_to_end(spark, layers, tmp_path):
    """Validated log events, written as bronze, through to a weekday answer."""
    log = spark.range(500).selectExpr(
        "CAST(concat('S', id % 3) AS BINARY) AS key",
        """CAST(concat('{"symbol":"S', id % 3, '","timestamp":"2026-01-0', id % 5 + 1, 'T00:00:00Z","open":1.0,'
           '"high":2.0,"low":1.0,"close":', id % 7, '.5,"volume":10,"currency":"USD","source":"f"}') AS BINARY) AS value""",
        "'t' AS topic", "0 AS partition", "id AS offset", "current_timestamp() AS timestamp",
    )
    valid = split_valid(validate(to_envelope(log)))
    valid.write.partitionBy("date").parquet(layers.bronze)
    jobs.run_batch(spark, layers, run_date="2026-01-01", names={})
    volume = {r.day_of_week: r.total_volume for r in jobs.read_star(spark, layers).run("volume_by_dow").collect()}
    assert volume == dict.fromkeys(["Thursday", "Friday", "Saturday", "Sunday", "Monday"], 30)

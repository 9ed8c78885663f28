import random
from datetime import datetime, timedelta

import pytest

from barlake.operators.dedup import clean
from barlake.sources import lake
from barlake.streaming import silver
from tests.test_jobs import BRONZE, Crash, contents


def files(seed, count):
    """Bronze rows file by file: keys repeat between files, events are late by days, prices may be bad."""
    rng, out = random.Random(seed), []
    for n in range(count):
        arrived, rows = datetime(2026, 2, 1) + timedelta(minutes=20 * n), []
        for i in range(40):
            day = f"2026-01-{rng.randrange(1, 4):02d}"
            close = float(rng.randrange(-1, 20))
            rows.append((f"S{rng.randrange(3)}", f"{day}T{rng.randrange(8):02d}:00:00Z", close + 1, close - 1, close,
                         1, "USD", "f", arrived, 1000 * n + i, day))
        out.append(rows)
    return out


@pytest.fixture
def place(spark, tmp_path):
    (tmp_path / "in").mkdir()
    tables = silver.Tables(f"{tmp_path}/latest", f"{tmp_path}/silver", f"{tmp_path}/batches")

    def add(name, rows):
        frame = spark.createDataFrame(rows, BRONZE).coalesce(1)
        frame.write.parquet(f"{tmp_path}/made-{name}")
        (part,) = (tmp_path / f"made-{name}").glob("*.parquet")
        (tmp_path / "in" / f"{name}.parquet").write_bytes(part.read_bytes())

    def run(delay="1 day"):
        stream = spark.readStream.schema(BRONZE).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        query = silver.start(stream, tables, f"{tmp_path}/checkpoint", delay, trigger={"availableNow": True})
        query.awaitTermination()
        return silver.dropped(query)

    return tables, add, run


def test_late_and_repeated_files_equal_the_batch(spark, place):
    """Files in turn, one that is late by arrival, one that comes twice, over two runs of the stream."""
    tables, add, run = place
    rows = files(1, 5)
    for n in (0, 2, 1):
        add(n, rows[n])
    assert run() == 0
    add("again", rows[2])
    add(3, rows[3])
    assert run() == 0
    want = clean(spark.createDataFrame([r for n in (0, 1, 2, 3) for r in rows[n]], BRONZE))
    assert contents(silver.read(spark, tables).select(*want.columns)) == contents(want)
    assert want.count() < 72  # some keys end with a bad price, and an older good one does not bring them back


def test_a_replayed_batch_changes_nothing(spark, place, monkeypatch):
    """The merge stops after any of its writes; the same batch again, and once more, leaves the same silver."""
    tables, _, _ = place
    rows = files(2, 3)
    frames = [spark.createDataFrame(r, BRONZE) for r in rows]
    silver.merge_batch(frames[0], 0, tables)
    for crash in (1, 2, 3):
        with monkeypatch.context() as patch:
            done = [0]
            for name in ("write_partitions", "write_snapshot"):
                def writer(*args, _write=getattr(lake, name), **kwargs):
                    done[0] += 1
                    if done[0] == 3 and crash == 3:
                        raise Crash  # all is written but the batch
                    result = _write(*args, **kwargs)
                    if done[0] == crash:
                        raise Crash
                    return result
                patch.setattr(lake, name, writer)
            with pytest.raises(Crash):
                silver.merge_batch(frames[1], 1, tables)
        silver.merge_batch(frames[1], 1, tables)
        silver.merge_batch(frames[0], 0, tables)  # done before: nothing happens
        want = clean(frames[0].unionByName(frames[1]))
        assert contents(silver.read(spark, tables).select(*want.columns)) == contents(want)
        lake.write_snapshot(spark.createDataFrame([(0,)], "batch bigint"), tables.batches)


def test_rows_too_late_for_the_state_are_counted(spark, place):
    tables, add, run = place
    rows = files(3, 2)
    shift = timedelta(days=3)
    add("a", [(*r[:8], r[8] + shift, *r[9:]) for r in rows[0]])
    assert run("1 hour") == 0
    add("b", [(*r[:8], r[8] + shift, *r[9:]) for r in rows[1]])
    add("c", rows[1])  # arrived three days before
    run("1 hour")
    add("d", rows[0])
    assert run("1 hour") > 0

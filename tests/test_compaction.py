import pytest

from barlake.sources import compaction, lake
from barlake.streaming.bronze import append_by_date
from tests.test_jobs import BRONZE, Crash, bronze_rows, contents

KEYS = ["symbol", "timestamp", "kafka_offset"]


@pytest.fixture
def stream(spark, tmp_path):
    """A bronze table that a stream's file sink writes, batch by batch."""
    (tmp_path / "in").mkdir()
    sent = []

    def send(rows):
        for i in range(0, len(rows), 5):  # many small files
            spark.createDataFrame(rows[i:i + 5], BRONZE).coalesce(1).write.parquet(f"{tmp_path}/made-{len(sent)}-{i}")
            (part,) = (tmp_path / f"made-{len(sent)}-{i}").glob("*.parquet")
            (tmp_path / "in" / f"{len(sent)}-{i}.parquet").write_bytes(part.read_bytes())
        sent.extend(rows)
        source = spark.readStream.schema(BRONZE).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        append_by_date(source, f"{tmp_path}/bronze", f"{tmp_path}/checkpoint", trigger={"availableNow": True}).awaitTermination()
        return spark.createDataFrame(sent, BRONZE)

    return f"{tmp_path}/bronze", f"{tmp_path}/compacted", send


def same(spark, layer, target, want, dates=None):
    got = compaction.read(spark, layer, target, dates)
    want = want if dates is None else want.where(want.date.isin(dates))
    return contents(got.select(*want.columns)) == contents(want)


def test_dates_are_read_from_one_place(spark, stream, monkeypatch):
    layer, target, send = stream
    want = send(bronze_rows(30, days=(1, 2)))
    assert same(spark, layer, target, want)

    with monkeypatch.context() as patch:  # a crash between write and mark
        patch.setattr(lake, "write_snapshot", lambda *_: (_ for _ in ()).throw(Crash()))
        with pytest.raises(Crash):
            compaction.compact(spark, layer, target, ["2026-01-01"], KEYS)
    assert same(spark, layer, target, want)
    assert not any("compacted" in f for f in compaction.read(spark, layer, target).inputFiles())

    assert compaction.compact(spark, layer, target, ["2026-01-01", "2026-01-09"], KEYS) == ["2026-01-01"]
    files = compaction.read(spark, layer, target, ["2026-01-01"]).inputFiles()
    assert all("compacted" in f for f in files) and len(files) < len(lake.read(spark, layer, ["2026-01-01"]).inputFiles())
    assert same(spark, layer, target, want) and same(spark, layer, target, want, ["2026-01-01"])
    assert compaction.compact(spark, layer, target, ["2026-01-01"], KEYS) == []

    want = send(bronze_rows(10, seed=3, offset=100, days=(1, 3)))  # the stream goes on, also with the closed date
    assert same(spark, layer, target, want)
    assert not any("compacted" in f for f in compaction.read(spark, layer, target, ["2026-01-01"]).inputFiles())
    assert compaction.compact(spark, layer, target, ["2026-01-01", "2026-01-03"], KEYS) == ["2026-01-01", "2026-01-03"]
    assert same(spark, layer, target, want)
    assert all("compacted" in f for f in compaction.read(spark, layer, target, ["2026-01-01", "2026-01-03"]).inputFiles())
    assert lake.folders(spark, f"{target}/date=2026-01-01") == ["made-1", "made-2", "made-3", "marks"][-3:]


def test_names_that_paths_escape(spark, tmp_path):
    layer, target = f"{tmp_path}/bronze", f"{tmp_path}/compacted"
    rows = [(*r[:10], "2026/01 10:00") for r in bronze_rows(6)]
    frame = spark.createDataFrame(rows, BRONZE)
    frame.write.partitionBy("date").parquet(layer)
    assert compaction.compact(spark, layer, target, ["2026/01 10:00"], KEYS) == ["2026/01 10:00"]
    assert same(spark, layer, target, frame) and all("compacted" in f for f in compaction.read(spark, layer, target).inputFiles())

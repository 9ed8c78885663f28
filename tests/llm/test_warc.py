import base64
import hashlib
import random

from barlake.llm.common import Scratch
from barlake.llm.warc import LoserTree, archive_and_index, parse_archive, write_archives
from pyspark.sql import functions as F

CAPTURES = "capture_id bigint, captured timestamp, url string, payload string, run string"


def captures(spark, rows):
    frame = spark.createDataFrame([(i, None, u, p, "clash") for i, u, p in rows], CAPTURES)
    return frame.withColumn("captured", F.timestamp_seconds(F.lit(1_000) + F.coalesce("capture_id", F.lit(0))))


ROWS = [
    (1, "http://b.org/2", "same"), (2, "http://a.org/1\r\nX: y", "same"), (3, None, None), (4, "none", ""),
    (5, "http://a.org/1", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"), (6, "http://c.org/", "é" * 500_000),
    (None, "http://d.org/", "alone"), (None, "http://d.org/", "same"), (7, "http://c.org/", "x"), (7, "http://c.org/", "x"),
]


def expected(rows, least):
    groups = {}
    for i, _, p in rows:
        groups.setdefault(p or "", []).append(i)
    out = []
    for i, _, p in rows:
        raw = (p or "").encode()
        ids = [j for j in groups[p or ""] if j is not None]
        top = max(ids, default=None)
        again = i != top and len(raw) >= least
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((i, len(raw), digest, "revisit" if again else "response", top if again else None))
    return sorted(map(str, out))


def test_records_and_order(spark):
    for least in (0, 2):
        index = archive_and_index(captures(spark, ROWS), least).collect()
        got = [(r.capture_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in index]
        assert sorted(map(str, got)) == expected(ROWS, least)
        order = [(r.url_key, r.captured, r.capture_id is not None, r.capture_id or 0) for r in index]
        assert order == sorted(order)
    assert [r.url_key for r in index if r.capture_id == 5] == ["org,a)/1"]


def test_empty_table(spark):
    assert archive_and_index(captures(spark, [])).count() == 0


def test_archives_hold_the_payloads(spark, tmp_path):
    write_archives(captures(spark, ROWS[:6]).repartition(3), f"{tmp_path}/a", compression="none")
    records = [r for f in (tmp_path / "a").glob("part-*") for r in parse_archive(f.read_bytes())]
    payloads = {r["capture_id"]: r["payload"] for r in records}
    assert payloads[2] == b"same" and payloads[1] is None and payloads[6] == ("é" * 500_000).encode()
    assert payloads[5] == ROWS[4][2].encode()


def test_loser_tree():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(rng.randrange(20) for _ in range(rng.randrange(6))) for _ in range(k)]
        got = [runs[run][place] for run, place in LoserTree(runs)]
        assert got == sorted(x for run in runs for x in run)
        pairs = [(runs[run][place], run) for run, place in LoserTree(runs)]
        assert pairs == sorted(pairs)

import random
from collections import Counter

import pytest

from barlake.operators.offsets import offset_gaps

ROWS = "kafka_partition int, kafka_offset bigint"


def brute(rows, starts=None):
    counts, out = {}, set()
    for p, o in rows:
        if p is not None and o is not None:
            counts.setdefault(p, Counter())[o] += 1
    for p, seen in counts.items():
        low = (starts or {}).get(p, min(seen))
        for kind, wanted in (("missing", [o for o in range(low, max(seen)) if o not in seen]),
                             ("repeated", [o for o in sorted(seen) if seen[o] > 1])):
            run = []
            for o in [*wanted, None]:
                if run and (o is None or o != run[-1] + 1):
                    n = len(run) if kind == "missing" else sum(seen[x] - 1 for x in run)
                    out.add((p, kind, run[0], run[-1], n))
                    run = []
                if o is not None:
                    run.append(o)
    return out


@pytest.mark.parametrize("chunk", [1, 4, 16, 1_000_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, chunk):
    """Holes and copies within chunks, at their ends, over several of them, and whole chunks that are missing."""
    rng, rows = random.Random(seed), []
    for p, base in ((0, 0), (1, 1000), (2, 7)):
        kept = [o for o in range(base, base + 200) if not base + 40 <= o < base + 75 and rng.random() > 0.05]
        rows += [(p, o) for o in kept] + [(p, o) for o in kept if base + 90 <= o < base + 140 or rng.random() < 0.1]
    rows += [(3, 5), (None, 1), (0, None)]
    frame = spark.createDataFrame(rows, ROWS).repartition(3)
    got = {tuple(r) for r in offset_gaps(frame, chunk).collect()}
    assert got == brute(rows)
    starts = {0: 0, 1: 990, 2: 0, 9: 1}
    begin = spark.createDataFrame(list(starts.items()), "kafka_partition int, first_offset bigint")
    assert {tuple(r) for r in offset_gaps(frame, chunk, starts=begin).collect()} == brute(rows, starts)


def test_nothing_to_tell(spark):
    assert offset_gaps(spark.createDataFrame([], ROWS)).count() == 0
    assert offset_gaps(spark.range(100).selectExpr("0 AS kafka_partition", "id AS kafka_offset"), 10).count() == 0


def test_a_hot_partition_is_spread(spark, plan_of):
    rows = spark.range(100).selectExpr("0 AS kafka_partition", "id AS kafka_offset")
    windows = [line for line in plan_of(offset_gaps(rows, 10)).splitlines() if "Window [" in line and "_o#" in line.split("windowspecdefinition")[0]]
    assert windows and all("_chunk" in line.split("windowspecdefinition(")[1].split("ASC")[0] for line in windows)

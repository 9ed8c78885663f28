import random
import re

import pytest

from barlake.llm.mixing import SLICES, due_at, in_training_order, mix, passes, training_order
from pyspark.sql import functions as F


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, weights=(3, 1, 2), budget=1.5, limit=2.0):
    """Share out again until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_sources = {}, set(order)
    while open_sources:
        left = budget * sum(sizes.values()) - sum(target.values())
        total = sum(weight[s] for s in open_sources)
        over = {s for s in open_sources if left * weight[s] / total > limit * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_sources}
            break
        target |= {s: limit * sizes[s] for s in over}
        open_sources -= over
    return target


def test_targets_and_takes(documents):
    rng = random.Random(4)
    rows = [(i, "w \n" * rng.randrange(60), None, rng.choice(["a", "b", "c", "B", "é", None, "hot", "hot", "hot"])) for i in range(500)]
    rows += [(600, None, None, "empty"), (601, "  ", None, "empty"), (5, rows[5][1], None, rows[5][3])]
    docs = documents(*rows)
    got = mix(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    target = brute_targets(sizes)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        assert len(r.positions) == -(-r.taken // r.size) if r.size else r.positions == []
        assert all(0 <= p <= 1 for p in r.positions)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(0 <= target[s] - taken[s] < 1 + 1e-6 for s in taken)
    again = mix(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert sorted(r.size for r in got) == sorted(words(r[1]) for r in rows)


def test_positions_follow_the_demand(documents):
    """Words read up to a time come near the integral of the weights up to it."""
    docs = documents(*[(i, "w " * 10, None, "ab"[i % 2]) for i in range(800)])
    mixed = mix(docs, weights=(3, 1))
    passes = training_order(mixed).collect()
    assert [r.position for r in passes] == sorted(r.position for r in passes)
    for source, slope in (("a", -0.5), ("b", 0.5)):  # weights above 2 fade out, those below fade in
        places = [r.position for r in passes if r.source == source]
        half = sum(p < 0.5 for p in places) / len(places)
        assert half == pytest.approx(0.5 - slope / 4, abs=0.03)


@pytest.mark.parametrize("phases, cases", [
    ([1.0, 1.0], {0: 0.0, 25: 0.25, 50: 0.5, 100: 1.0}), ([3.0, 1.0], {75: 0.5, 30: 0.2, 100: 1.0}),
    ([0.0, 1.0], {0: 0.5, 50: 0.75}), ([0.0, 0.0], {50: 0.5}),
])
def test_inverse_of_the_demand(spark, phases, cases):
    for count, at in cases.items():
        schedule = F.array(*map(F.lit, phases))
        got = spark.range(1).select(due_at(F.lit(float(count)), F.lit(100.0), schedule).alias("t")).first().t
        assert got == pytest.approx(at)


def test_rows_in_training_order(documents):
    """Each row as often as it is read, in the order of its positions; extra columns keep their values."""
    rng = random.Random(9)
    rows = [(i, f"t{i} " + "w " * rng.randrange(1, 40), None, rng.choice(["a", "b", "c", None])) for i in range(300)]
    docs = documents(*rows, (900, None, None, "a"), (901, " ", None, "b"))
    docs = docs.selectExpr("*", "doc_id * 2 AS _size", "doc_id * 3 AS _content", "doc_id * 5 AS _place", "'q' AS positions")
    want = sorted((p, r.doc_id) for r in mix(docs).collect() for p in r.positions)
    found = in_training_order(docs)
    got = found.collect()
    assert found.columns == docs.columns and [r.doc_id for r in got] == [i for _, i in want]
    assert all((r["_size"], r["_content"], r["_place"], r.positions) == (2 * r.doc_id, 3 * r.doc_id, 5 * r.doc_id, "q") for r in got)
    texts = {r[0]: r[1] for r in rows}
    assert all(r.text == texts[r.doc_id] for r in got)


def test_repeated_rows_and_missing_ids_are_spread(documents):
    """Rows without an id, or with one id, differ in their texts and so in their slices; rows that repeat
    as a whole are one row with a number of copies, whose words are taken one behind the other."""
    rows = [(None, f"text number {i}", None, "a") for i in range(400)] + [(7, f"text number {i}", None, "a") for i in range(400)]
    rows += [(9, "again and again", None, "a")] * 500 + [(10, "other words", None, "b")]
    found = passes(documents(*rows))
    assert found.count() == 802
    counted = found.withColumn("slice", F.pmod(F.xxhash64("doc_id", "source", "content", F.lit(42)), F.lit(SLICES)))
    assert counted.groupBy("source", "slice").count().agg(F.max("count")).first()[0] <= 6
    mixed = mix(documents(*rows))
    assert mixed.count() == len(rows)
    a = mixed.where("source = 'a'").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).first()
    assert 0 <= a.target - a.taken < 1
    again = mixed.where("doc_id = 9").select("positions").collect()
    assert len({tuple(r.positions) for r in again}) == 500
    copies = in_training_order(documents(*rows)).where("doc_id = 9").count()
    assert copies % 500 == 0 and copies > 0


@pytest.mark.parametrize("weights", [(0, 1, 2), (0, 0, 1), (0, 0)])
def test_sources_without_weight(documents, weights):
    docs = documents(*[(i, "w " * 9, None, "abc"[i % 3]) for i in range(90)])
    found = {r.source: (r.target, r.taken) for r in mix(docs, weights=weights).groupBy("source").agg(
        F.max("target").alias("target"), F.sum("taken").alias("taken")).collect()}
    for place, s in enumerate("abc"):
        weight = weights[place % len(weights)]
        others = {t: w for t, w in zip("abc", (weights * 3)[:3]) if w}
        want = min(540, 1.5 * 810 * weight / sum(others.values())) if weight else 0
        if weights == (0, 1, 2):
            want = {"a": 0, "b": 540, "c": 540}[s]
        assert found[s] == (pytest.approx(want), pytest.approx(want, abs=1))


def test_empty_tables_and_texts(odd, documents):
    assert mix(odd.limit(0)).count() == 0
    assert mix(odd).count() == odd.count()
    assert all(r.taken == 0 and r.target == 0 for r in mix(documents((1, None), (2, ""))).collect())


def test_main_path_is_native(odd, plan_of):
    plan = plan_of(mix(odd))
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan

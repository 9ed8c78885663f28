import hashlib
import random
import tracemalloc

import numpy as np
import pytest
import xxhash

from barlake.llm import simhash
from barlake.llm.trie_dedup import Owner, OwnerTrie, _owners, exact_groups, kept_documents
from pyspark.sql import functions as F


def normal(text):
    return (text or "").encode().lower()


def brute_groups(rows, keep):
    groups = {}
    for i, text in rows:
        groups.setdefault(normal(text), []).append(i)
    out = []
    for i, text in rows:
        ids = [x for x in groups[normal(text)] if x is not None]
        out.append((i, keep(ids) if ids else None, len(groups[normal(text)]), hashlib.sha256(normal(text)).hexdigest()))
    return sorted(map(str, out))


@pytest.mark.parametrize("memory", [1000, 1 << 20])
@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_groups(odd, keep, memory):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = exact_groups(odd.repartition(3), keep, memory=memory).collect()
    assert sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == brute_groups(rows, {"min": min, "max": max}[keep])
    kept = [r for r in got if r.kept]
    assert len(kept) == len({normal(t) for _, t in rows}) and all(r.doc_id == r.keep_id for r in kept)
    assert exact_groups(odd.limit(0)).count() == 0


def test_kept_documents(odd):
    left = kept_documents(odd, "max")
    assert left.columns == odd.columns
    assert {r.doc_id for r in left.collect()} == {2, 3, 4, 6, 7, 8, 9, None}


def test_trie_spills_and_equals_a_dictionary():
    rng = random.Random(1)
    for memory in (10, 200, 1 << 20):
        trie, want = OwnerTrie("max", memory), {}
        for i in range(600):
            text = bytes(rng.choices(b"ab\0", k=rng.randrange(14))) + b"common tail" * rng.randrange(3)
            trie.insert(text, Owner(i % 50, 1, 1))
            want.setdefault(text, []).append(i % 50)
        got = {text: (o.id, o.ties, o.rows) for text, o in trie.owners()}
        assert got == {t: (max(v), v.count(max(v)), len(v)) for t, v in want.items()}
        assert bool(trie.spilled) == (memory < 1 << 20)


def test_many_short_texts_stay_within_their_memory():
    """Labels are the smaller part of such a trie: its nodes count as well."""
    trie, limit = OwnerTrie("min", 8 << 20), 8 << 20
    tracemalloc.start()
    for i in range(120_000):
        trie.insert(hashlib.sha256(b"%d" % (i % 100_000)).digest()[:16], Owner(i, 1, 1))
        if i % 5000 == 0:
            assert tracemalloc.get_traced_memory()[0] < 1.5 * limit
    tracemalloc.stop()
    owners = list(trie.owners())
    assert trie.spilled and len(owners) == 100_000
    assert sum(o.rows for _, o in owners) == 120_000 and {o.id for _, o in owners} == set(range(100_000))


def test_a_full_local_trie_hands_on_and_starts_anew():
    trie, found = OwnerTrie("max", 2000), {}
    for i in range(200):
        if trie.add(b"text %d" % (i % 40), Owner(i, 1, 1)):
            for text, owner in trie.flush():
                found.setdefault(text, []).append(owner)
            assert trie.held == 0
    for text, owner in trie.flush():
        found.setdefault(text, []).append(owner)
    assert not trie.spilled and len(found) == 40
    assert all(sum(o.rows for o in own) == 5 for own in found.values())


def test_every_text_goes_through_the_tries(documents):
    """Also texts that occur once."""
    docs = documents(*((i, f"text {i % 30}") for i in range(40)))
    owners = _owners(docs.selectExpr("doc_id", "CAST(text AS BINARY) AS text"), "min", 1 << 20).collect()
    assert len(owners) == 30 and sum(o["rows"] for o in owners) == 40


def brute_print(text, words):
    tokens = normal(text).split()
    if not tokens:
        return 0
    k = min(words, len(tokens))
    hashes = [xxhash.xxh64_intdigest(b" ".join(tokens[i:i + k]), 42) for i in range(len(tokens) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_in_chunks():
    text = " ".join(f"W{i % 97} é{i % 11}\t\n" for i in range(600))
    for t in (text, "", " \x0b", "one", "one two three", "A A A A A A"):
        assert simhash.fingerprint(t.encode(), 4, chunk=7) == simhash.signed(brute_print(t, 4))


def test_spark_hashes_alike(spark):
    hashed = spark.sql("SELECT xxhash64('a b c é') AS h").first().h
    assert hashed == simhash.signed(xxhash.xxh64_intdigest("a b c é".encode(), 42))


@pytest.mark.parametrize("tile", [4, 2048])
def test_classes_equal_brute_force(spark, documents, monkeypatch, tile):
    """Random texts, chains of near copies, copies; small tiles cut the large buckets."""
    monkeypatch.setattr(simhash, "TILE", tile)
    rng, rows = random.Random(6), []
    for base in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([3, 60, 200]))]
        for _ in range(rng.choice([1, 2, 12])):
            rows.append((len(rows) * 3 % 1000, " ".join(words)))
            words[rng.randrange(len(words))] = f"x{rng.randrange(5000)}"
    rows += [(2000, None), (2001, ""), (1, rows[0][1]), (1, rows[0][1]), (None, rows[5][1]), (None, "nobody knows this text")]
    found = simhash.near_duplicates(documents(*rows), words=4, differing=4).collect()
    prints = [brute_print(t, 4) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for i, (id, _) in enumerate(rows):
        if id is not None:
            least[find(i)] = min(id, least.get(find(i), id))
    want = sorted(str((rows[i][0], simhash.signed(prints[i]), least.get(find(i)))) for i in range(len(rows)))
    assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in found) == want
    assert simhash.near_duplicates(documents(*rows).limit(0), words=4, differing=4).count() == 0


def test_masks_lose_no_pair():
    rng = np.random.default_rng(1)
    for rows, differing in ((10, 4), (10**6, 4), (10**9, 4), (10**6, 10)):
        masks = simhash.bucket_masks(rows, differing)
        for _ in range(200):
            bits = rng.choice(64, differing, replace=False)
            flipped = sum(1 << int(b) for b in bits)
            assert any(mask & flipped == 0 for mask in masks)


def test_representatives(documents):
    """One row of each class of the fingerprints stays: the smallest id. Chains, a large group of near
    copies, a passage common to all, ids in any order."""
    rng, rows = random.Random(5), []
    passage = [f"p{i}" for i in range(40)]
    for base in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([4, 60, 200]))] + passage * (base % 2)
        for _ in range(60 if base == 7 else rng.choice([1, 2, 3])):
            rows.append((len(rows), " ".join(words)))
            words[rng.randrange(len(words))] = f"y{rng.randrange(10**6)}"
    rng.shuffle(rows)
    prints = {i: brute_print(t, 4) for i, t in rows}
    root = {i: i for i in prints}
    for a, b in ((a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4):
        low, high = sorted((root[a], root[b]))
        root = {i: low if r == high else r for i, r in root.items()}
    docs = documents(*rows).repartition(4)
    left = simhash.representatives(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, r in root.items() if i == r} != set(prints)


def test_columns_that_clash_with_inner_names(documents):
    docs = documents((1, "a b c"), (2, "A b c"), (3, "other words stand here")).selectExpr(
        "*", "'keep' AS _keys", "'keep' AS key", "'keep' AS fingerprint", "'keep' AS component_id", "'keep' AS keep_id",
    )
    for left, ids in ((kept_documents(docs, "max"), {2, 3}), (simhash.representatives(docs), {1, 3})):
        assert left.columns == docs.columns
        assert {(r.doc_id, r["_keys"], r.key, r.fingerprint) for r in left.collect()} == {(i, "keep", "keep", "keep") for i in ids}


def test_a_repeated_id_loses_only_the_text_that_has_an_equal(documents):
    docs = documents((5, "a"), (5, "b"), (9, "A"), (None, "a"), (7, None), (8, ""))
    left = {(r.doc_id, r.text) for r in kept_documents(docs, "max").collect()}
    assert left == {(5, "b"), (9, "A"), (None, "a"), (8, "")}
    docs = documents((5, "a a"), (5, "b"), (3, "A  a"), (None, "b"))
    assert {(r.doc_id, r.text) for r in simhash.representatives(docs).collect()} == {(5, "b"), (3, "A  a"), (None, "b")}

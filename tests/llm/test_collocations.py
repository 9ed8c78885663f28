import random
import re
from collections import Counter

import numpy as np
import pytest

from barlake.llm import collocations as co
from barlake.llm import quotient_filter as qf


def brute(rows, least=10, share=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        raw = (text or "").encode().lower()
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", raw):
            words = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    often = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    found = {}
    for (lang, words), a in often.items():
        longer = [b for (m, other), b in often.items() if m == lang and len(other) > len(words)
                  and words in (other[:2], other[1:])]
        if any(100 * b >= share * a for b in longer):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, b" ".join(words), left, right))
    out = set()
    for lang, some in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(some)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def as_set(frame):
    rows = [tuple(r) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def sample(seed, count):
    rng = random.Random(seed)
    vocabulary = [rng.choice(["New", "york", "é", "日本", "a b", "x'y", " "]) + str(rng.randrange(9)) for _ in range(40)]
    rows = []
    for _ in range(count):
        words = rng.choices(vocabulary, weights=[1 / (i + 1) for i in range(40)], k=rng.randrange(60))
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "!?", "\x0b"]) for w in words)
        rows.append((rng.choice(["en", "en", "en", None, "und", "fr"]), text))
    return rows


@pytest.mark.parametrize("limits", [{}, dict(words=30, filters=2, filter=50, buffer=100, counted=20, range=64, slice=64), dict(map_bits=16),
                                    dict(filter=100, buffer=50, range=500)])
def test_equals_brute_force(documents, limits):
    """Also with shards, ranges and slices so small that every text is cut, and with a map that tells less."""
    rows = sample(3, 300) + [("en", "wide spread words " * 200), (None, None), ("fr", ""), ("en", " \t. !")]
    docs, limits = documents(*[(i, text, lang) for i, (lang, text) in enumerate(rows)]).repartition(3), co.Limits(**limits)
    want = brute(rows)
    assert as_set(co.collocations(docs, limits=limits)) == want and len(want) > 50
    assert as_set(co.collocations(docs, 3, 90, 7, limits)) == brute(rows, 3, 90, 7)


def test_odd_rows_and_empty_table(odd):
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert as_set(co.collocations(odd)) == brute(rows)
    assert co.collocations(odd.limit(0)).count() == 0


def test_a_hot_phrase_arrives_once_a_shard(documents):
    """A pair that all rows share is one entry of each shard's filter, whatever its count."""
    docs = documents(*[(i, "of the " * 50, "en") for i in range(500)])
    found = co.collocations(docs).collect()
    assert ("of the of", 500 * 49) in {(r.phrase, r.a) for r in found}


def test_maps_know_all_frequent_words_and_pairs(spark):
    words = [(lang, f"w{i}é".encode()) for lang in ("en", "日本", "") for i in range(3000)]
    bits = co.word_map(spark.createDataFrame(words, "lang string, word binary"), 18)
    assert len(bits) == 1 << 15

    def known(bits, h):
        return all(bits[p >> 3] >> (p & 7) & 1 for p in co.places(int(h), 18))

    assert all(known(bits, co.word_hash(*w)) for w in words)
    assert sum(known(bits, co.word_hash("de", w)) for _, w in words) < 0.02 * len(words)

    numbered = spark.createDataFrame([(i, *w) for i, w in enumerate(words)], "number bigint, lang string, word binary")
    pairs = [(i, (i * 7 + 3) % 9000) for i in range(0, 9000, 2)]
    bits = co.pair_map(spark.createDataFrame(pairs, "first bigint, second bigint"), numbered, 18)
    h = np.array([co.word_hash(*w) for w in words], np.uint64)
    first, second = np.array(pairs).T
    assert all(known(bits, x) for x in co.pair_hash(h[first], h[second]))
    assert sum(known(bits, x) for x in co.pair_hash(h[second], h[first])) < 0.02 * len(pairs)


def test_slices_end_at_words():
    text = b"one two\xffthree \xff\xff " + b"x" * 50 + b" end"
    for size in (1, 4, 9, 1000):
        parts = list(co.slices(text, size))
        assert b"".join(parts) == text
        assert all(p[-1:] in b" \t\xff" for p in parts[:-1])
    assert list(co.slices(b"", 5)) == [b""]


def test_permutations_are_invertible():
    rng = np.random.default_rng(1)
    x = np.r_[rng.integers(0, 1 << 64, 5000, np.uint64), np.arange(100, dtype=np.uint64), np.uint64((1 << 64) - 1)]
    assert (qf.gather(qf.scatter(x)) == x).all() and (qf.scatter(qf.gather(x)) == x).all()
    low = rng.integers(0, 1 << 32, len(x), np.uint32)
    high, rest = qf.scatter_wide(x, low)
    back = qf.gather_wide(high, rest)
    assert (back[0] == x).all() and (back[1] == low).all()
    high, rest = qf.scatter_wide(np.arange(4096, dtype=np.uint64), np.zeros(4096, np.uint32))
    assert np.bincount((high >> np.uint64(60)).astype(int)).max() < 2 * 256  # like numbers are spread


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("size", [0, 1, 2, 3, 1000])
def test_filters_lose_nothing(wide, size):
    rng = np.random.default_rng(size)
    for spread in (64, 40, 10):
        high = np.unique(rng.integers(0, 1 << spread, size, np.uint64) << np.uint64(0 if spread == 64 else 3))
        if size > 1 and spread == 64:
            high[-1] = np.uint64((1 << 64) - 1)
            high[0] = 0
        counts = rng.choice([1, 2, 255, 256, 257, 10**12], len(high))
        low = np.sort(rng.integers(0, 1 << 32, len(high), np.uint32)) if wide else None
        back = qf.decode(qf.encode(qf.Entries(high, low, counts)))
        assert (back.high == high).all() and (back.counts == counts).all() and back.counts.dtype == np.int64
        assert (back.low == low).all() if wide else back.low is None


@pytest.mark.parametrize("wide", [False, True])
def test_merge_adds_up(wide):
    rng = np.random.default_rng(5)
    want, parts = Counter(), []
    for _ in range(6):
        keys = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 50, 40), rng.integers(0, 3 if wide else 1, 40))})
        counts = rng.integers(1, 1000, len(keys))
        want.update(dict(zip(keys, counts.tolist())))
        low = np.array([b for _, b in keys], np.uint32) if wide else None
        parts.append(qf.decode(qf.encode(qf.Entries(np.array([a for a, _ in keys], np.uint64), low, counts))))
    got = qf.merge(parts)
    lows = got.low.tolist() if wide else [0] * len(got)
    keys = list(zip(got.high.tolist(), lows))
    assert keys == sorted(want) and dict(zip(keys, got.counts.tolist())) == dict(want)


def test_compact():
    """Some seven bytes an entry, where the packed n-gram and its counter take sixteen."""
    keys = qf.scatter(np.arange(200_000, dtype=np.uint64))
    assert len(qf.encode(qf.count(keys))) < 8 * 200_000


def test_scores_are_exact(spark):
    """Products beyond 64 bits."""
    expression = "CAST(1000000 AS DECIMAL(7, 0)) * (CAST(a AS DECIMAL(15, 0)) * CAST(a AS DECIMAL(15, 0)))"
    expression += " div (CAST(l AS DECIMAL(15, 0)) * CAST(r AS DECIMAL(15, 0)))"
    rng = random.Random(2)
    rows = []
    for _ in range(200):
        left, right = rng.randrange(1, 10**15), rng.randrange(1, 10**15)
        rows.append((rng.randrange(1, min(left, right) + 1), left, right))
    got = spark.createDataFrame(rows, "a bigint, l bigint, r bigint").selectExpr("a", "l", "r", f"{expression} AS s").collect()
    assert all(r.s == 1_000_000 * r.a * r.a // (r.l * r.r) for r in got)

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from barlake.llm import spelling
from pyspark.sql import functions as F


def edited(a, b):
    """One code point inserted, deleted or replaced, by trying all deletions."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_words(rows, every=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def brute(rows, every=31):
    words = brute_words(rows, every)
    near = {w: [v for v in words if edited(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def as_set(frame):
    rows = [tuple(r) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def sample(seed, count):
    """Words with variants, chains of them, and letters at the edge of the alphabet."""
    rng = random.Random(seed)
    letters = "abcdéÿÀ×÷ß"
    words = ["".join(rng.choices(letters, k=rng.randrange(5, 12))) for _ in range(12)]
    pool = []
    for w in words:
        pool += [w] * 300
        for _ in range(6):
            at = rng.randrange(len(w))
            v = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1:]])
            pool += [v] * rng.choice([1, 2, 20])
            u = v[:1] + rng.choice(letters) + v[1:]
            pool += [u] * rng.choice([1, 2])
    rng.shuffle(pool)
    parts = [" ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in pool[i::count]) for i in range(count)]
    return [(rng.choice([i, i, None]), t + rng.choice([" 日本", "ŁŁŁŁŁŁŁŁ", "İstanbuler", ""])) for i, t in enumerate(parts)]


@pytest.mark.parametrize("tile", [1 << 16, 150])
def test_equals_brute_force(documents, monkeypatch, tile):
    """Small tiles cut nearly every block."""
    monkeypatch.setattr(spelling, "TILE", tile)
    rows = sample(4, 60) + [(900, None), (901, ""), (902, "12 34"), (903, "ordinary ORDINARY ordinery"), (903, "ordinary ORDINARY ordinery")]
    want = brute(rows)
    assert as_set(spelling.variants(documents(*rows).repartition(3))) == want
    assert sum(r[1] is not None for r in want) > 10 and any(r[2] != r[1] for r in want if r[1])


@pytest.mark.parametrize("tile", [1 << 16, 64])
def test_dense_blocks(documents, monkeypatch, tile):
    """All words of some lengths over two letters: every word has many near ones."""
    monkeypatch.setattr(spelling, "TILE", tile)
    rng = random.Random(1)
    words = [f"{i:0{k}b}".replace("0", "a").replace("1", "b") for k in (7, 8) for i in range(1 << k)]
    rows = [(i, " ".join(w for w in words for _ in range(rng.choice([1, 2, 2, 30])))) for i in range(2)]
    assert as_set(spelling.variants(documents(*rows), every=10**9)) == brute(rows, 10**9)


def test_odd_rows_and_empty_table(odd):
    assert as_set(spelling.variants(odd)) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert spelling.variants(odd.limit(0)).count() == 0


def test_very_long_words(documents):
    """A run of a hundred thousand letters does not widen the matrices of the other words."""
    huge = "q" * 100_000
    rows = [(1, f"{huge} {huge} {huge}x {huge}x " + "letters lettres " * 30 + "leters letterss " * 2), (2, f"{huge} " * 30)]
    assert as_set(spelling.variants(documents(*rows), every=10**9)) == brute(rows, 10**9)


def test_chains_end(spark):
    """A way of 40 steps, in a logarithmic number of rounds."""
    from barlake.llm.common import Scratch

    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(40)] + [("a", "b")], "word string, form string")
    found = dict(map(tuple, spelling.roots(forms, Scratch(spark, "roots")).collect()))
    assert found == {**{f"w{i}": "w40" for i in range(40)}, "a": "b"}


def test_prefix_and_suffix_tell_single_edits():
    rng = random.Random(7)
    words = sorted({"".join(rng.choices("ab", k=rng.choice([7, 8, 9]))) for _ in range(150)})
    codes = [w.encode("latin-1") for w in words]
    for longest in (8, 9):
        rows = [i for i, w in enumerate(words) if len(w) in (longest, longest - 1)]
        same = np.zeros(len(rows), np.int64)
        found = set()
        for place in range(4):  # no stems: one block of all words, so ranges alone keep pairs from counting twice
            a, b = spelling.near_pairs(
                same, same + longest, same + place, same, np.zeros(len(rows), bool), [codes[i] for i in rows],
            )
            pairs = {frozenset((rows[x], rows[y])) for x, y in zip(a.tolist(), b.tolist())}
            assert len(pairs) == len(a) and not pairs & found
            found |= pairs
        assert found == {
            frozenset((i, j)) for i in rows for j in rows
            if i < j and longest in (len(words[i]), len(words[j])) and edited(words[i], words[j])
        }


def test_texts_are_read_whole(documents):
    """What stands at the end of a long text counts as well."""
    rows = [(i, "fillers " * 50_000 + "remarkable") for i in range(2)]
    assert ("remarkable", 2) in {(r.word, r.n) for r in spelling.variants(documents(*rows), every=10**9).collect()}
    assert spelling.variants(documents(*rows)).agg(F.max("n")).first()[0] == 100_000

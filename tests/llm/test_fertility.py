import math
import random
import re
from collections import Counter

import pytest

from barlake.llm import fertility as fe
from barlake.llm.queries import model_path
from tests.conftest import SF


def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path())


def paths():
    import public_tokenizers

    return [model_path(), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")], public_tokenizers.PATTERN


def brute_basics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            covered |= set(range(i, i + 5))
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    repeated = sum(line in lines[:i] for i, line in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered))


def test_basics():
    rng = random.Random(1)
    texts = ["", "a", "a a a a a a", "a b c d e", "é 日本 # <b>|", "x y z", "a\n\na\n a\na\r\na\r"]
    for _ in range(200):
        texts.append("".join(rng.choice(["a", "b", "c", "#"]) + rng.choice([" ", "\n", "\t", "  ", "\x0b"]) for _ in range(rng.randrange(80))))
    for text in texts:
        assert fe.basics(text) == brute_basics(text), text


def test_windows_whose_hashes_meet(monkeypatch):
    """With all hashes equal, the windows themselves decide."""
    rng = random.Random(8)
    monkeypatch.setattr(fe, "hash", lambda word: 7, raising=False)
    for _ in range(50):
        text = " ".join(rng.choices("abc", k=rng.randrange(60)))
        assert fe.basics(text) == brute_basics(text)


def test_scripts():
    assert [fe.script(t) for t in ("Hello é", "привет мир a", "漢字 x", "123 !", "")] == ["Latin", "Cyrillic", "Cjk", "None", "None"]


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_slices(size):
    for text in ("some words\nand lines " * 9, "x" * 50, "", "a b"):
        parts = list(fe.slices(text, size))
        assert "".join(parts) == text and all(len(p) <= size for p in parts)
        assert all(p[-1] in " \n" or len(p) == size for p in parts[:-1])


def test_measures_are_the_librarys(documents):
    import base64

    import tiktoken

    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["the", "Wort", "größe", "日本", "\U0001f600", "###", "zzzqqq", "é"], k=rng.randrange(40)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " ")]
    names, pattern = paths()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(names[1], "rb"))}
    tokens = {rank: token for token, rank in ranks.items()}
    other = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    piece = library()

    def broken(token):
        try:
            token.decode()
        except UnicodeDecodeError:
            return True
        return False

    for r in fe.measure(documents(*rows), names, pattern).collect():
        text = dict(rows)[r.doc_id] or ""
        assert tuple(r[c] for c in fe.BASE) == brute_basics(text)
        for i, (ids, fallen) in enumerate((
            (piece.encode(text), piece.is_byte), (other.encode_ordinary(text), lambda x: broken(tokens[x])),
        )):
            got = r[f"tokens_{i}"], r[f"chars_{i}"], r[f"bytes_{i}"], r[f"entropy_{i}"]
            if not ids:
                assert got == (0, None, None, None)
                continue
            shares = [n / len(ids) for n in Counter(ids).values()]
            want = len(ids), len(text) / len(ids), sum(map(fallen, ids)) / len(ids), -sum(p * math.log2(p) for p in shares)
            assert got == pytest.approx(want, abs=1e-9)


def test_other_vocabulary_files(documents):
    import public_tokenizers

    found = fe.measure(documents((1, "hello hello world")), [public_tokenizers.path("word_bpe_49k.json")]).first()
    assert found.tokens_0 == 3 and found.entropy_0 == pytest.approx(0.918, abs=1e-3)


def brute_bands(rows, width, needed):
    """Bands by sorting: quartiles as the middle of the bin that holds the value of that rank."""
    groups = {}
    for r in rows:
        if not r.tokens_0:
            continue
        key = r.lang if r.lang is not None else f"script:{r.script}", int(math.log2(r.tokens_0) / 2)
        for i in (0, 1):
            for m in fe.LEAST:
                groups.setdefault((*key, i, m), []).append(r[f"{m}_{i}"])
    out = {}
    for key, values in groups.items():
        if len(values) < needed:
            continue
        values.sort()
        q1, q3 = ((math.floor(values[math.ceil(len(values) * p) - 1] / fe.BIN) + 0.5) * fe.BIN for p in (0.25, 0.75))
        reach = max(q3 - q1, fe.LEAST[key[3]]) * width
        out[key] = (q1 - reach, q3 + reach)
    return out


def test_verdicts_equal_plain_ones(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, pattern = paths()
    for width, needed in ((5.0, 50), (1.0, 10)):
        rows = {r.doc_id: r for r in fe.measure(docs, names, pattern).collect()}
        bands = brute_bands(rows.values(), width, needed)
        judged = fe.judge(docs.repartition(3), names, pattern, width, needed).collect()
        assert len(judged) == len(rows)
        for r in judged:
            m = rows[r.doc_id]
            key = m.lang if m.lang is not None else f"script:{m.script}", int(math.log2(max(m.tokens_0, 1)) / 2)
            out = []
            for i in (0, 1):
                for name in fe.LEAST:
                    limits, value = bands.get((*key, i, name)), m[f"{name}_{i}"]
                    if limits and value is not None and (value > limits[1] or (value < limits[0] and name != "bytes")):
                        out.append(f"{name}_{i}")
            failed = m.n_words < 10 or 100 * m.n_repeat_words > 20 * m.n_words
            assert (r.base_failed, r.kept, r.rejected_by) == (failed, not failed and not out, ",".join(out))


def test_junk_goes_and_prose_stays(documents):
    """Texts of bytes, capitals and one token over and over, among two hundred of prose."""
    rng = random.Random(3)
    words = "the of and time people water city house under light green river stone every answer letter".split()
    prose = [" ".join(rng.choices(words, k=rng.randrange(100, 300))) for _ in range(200)]
    prose = [re.sub(r"((\S+ ){20})", r"\1x%d " % i, t) for i, t in enumerate(prose)]
    junk = [
        " ".join("".join(rng.choices("กẞ\U0001f9ff☃", k=4)) for _ in range(80)),
        " ".join(f"{'q' * rng.randrange(1, 9)}{i}" for i in range(150)),
        " ".join("".join(rng.choices("XQZJK", k=6)) for _ in range(150)),
    ]
    docs = documents(*[(i, t, "en") for i, t in enumerate(prose + junk)])
    names, pattern = paths()
    judged = {r.doc_id: r for r in fe.judge(docs, names, pattern).collect()}
    assert [judged[200 + i].kept for i in range(3)] == [False] * 3
    assert all(judged[i].rejected_by == "" for i in range(200))


def test_odd_rows_and_extra_columns(odd):
    names, pattern = paths()
    judged = fe.judge(odd, names, pattern)
    assert judged.count() == odd.count() and not any(r.kept for r in judged.where("n_words < 10").collect())
    assert fe.judge(odd.limit(0), names, pattern).count() == 0
    extra = odd.selectExpr("*", "'keep' AS _number", "'keep' AS script", "'keep' AS kept", "'keep' AS bands")
    left = fe.kept_documents(extra, names, pattern)
    assert left.columns == extra.columns and left.count() == judged.where("kept").count()

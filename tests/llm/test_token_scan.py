import random
from pathlib import Path

import numpy as np
import pytest
import sentencepiece

from barlake.llm import token_scan
from barlake.llm.queries import model_path

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=model_path())


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_any_block_size_gives_the_same(spark, tmp_path, block):
    rng, want = random.Random(block), []
    for n, tail in ((0, 0), (1, 0), (9, 3), (30, 0), (0, 5), (4, 1)):
        ids, name = [], f"f{n}-{tail}"
        for doc in range(n):
            size = rng.choice([0, 0, 1, 2, 15])
            want.append((name, doc, len(ids), size))
            ids += [rng.choice([0, 1, 3, 512, 2 << 8]) for _ in range(size)] + [2]
        if tail:
            want.append((name, n, len(ids), tail))
            ids += [9] * tail
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    found = token_scan.count_tokens(spark, str(tmp_path), 2, block_tokens=block).collect()
    assert sorted((r.file.rpartition("/")[2], r.doc_no, r.first_token, r.n_tokens) for r in found) == sorted(want)


def test_broken_file_raises(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"123")
    with pytest.raises(Exception, match="whole number"):
        token_scan.count_tokens(spark, str(tmp_path), 2).collect()


def test_documents(spark, odd, tmp_path, monkeypatch):
    monkeypatch.setattr(token_scan, "DOCS_PER_FILE", 2)
    odd.repartition(3).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    got = token_scan.document_token_counts(docs, model_path()).collect()
    want = [(r.doc_id, len(LIBRARY.encode(r.text or ""))) for r in docs.collect()]
    assert sorted(map(str, ((r.doc_id, r.n_tokens) for r in got))) == sorted(map(str, want))
    docs.limit(0).write.parquet(f"{tmp_path}/none")
    assert token_scan.document_token_counts(spark.read.parquet(f"{tmp_path}/none"), model_path()).count() == 0


def test_place_of_a_file_whose_job_looks_like_a_number(spark):
    names = ["part-00007-c12a4e10-c345-4c67-89ab-c99999999999-c003.txt", "part-00000-0a-c000.txt"]
    files = spark.createDataFrame([(f"file:/a/part-00001-c5.d/{n}",) for n in names], "file string")
    found = files.select(*token_scan.file_place(files.file)).collect()
    assert [tuple(r) for r in found] == [(7, 3), (0, 0)]


def test_counts_do_not_depend_on_later_splits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_scan, "DOCS_PER_FILE", 5)
    rows = spark.range(400).selectExpr("id AS doc_id", "repeat('word ', cast(id % 17 AS int)) AS text")
    rows.repartition(12).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    want = {r.doc_id: len(LIBRARY.encode(r.text)) for r in docs.collect()}
    conf = {"spark.sql.files.minPartitionNum": "2", "spark.sql.files.openCostInBytes": "1"}
    for first in (True, False):
        got = token_scan.document_token_counts(docs, model_path())
        if first:
            for name, value in conf.items():
                spark.conf.set(name, value)
        assert {r.doc_id: r.n_tokens for r in got.collect()} == want
    for name in conf:
        spark.conf.unset(name)


def test_files_are_closed_by_bytes(spark, tmp_path, monkeypatch):
    """Long documents, and the empty ones between them, stand in files of bounded size; the files go."""
    monkeypatch.setattr(token_scan, "BYTES_PER_FILE", 3000)
    texts = ["word " * (2000 if i % 7 == 3 else i % 5 * 10) for i in range(120)] + [None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows.coalesce(2).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    token_scan.document_token_counts(docs.limit(0), model_path())  # names the shared folder
    end = token_scan.write_token_files(docs, f"{tmp_path}/tokens", model_path())
    sizes = [f.stat().st_size for f in (tmp_path / "tokens").glob("part-*")]
    longest = 2 * max(len(LIBRARY.encode(t or "")) + 1 for t in texts)
    assert end == LIBRARY.eos_id() and len(sizes) > 10 and max(sizes) < 3000 + longest
    shared = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(shared.glob("token-files-*/tokens"))
    got = token_scan.document_token_counts(docs, model_path()).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(LIBRARY.encode(t or "")) for i, t in enumerate(texts)}
    assert len({r.file for r in got}) == len(sizes) and set(shared.glob("token-files-*/tokens")) == before


def test_pieces_are_never_broadcast(spark, plan_of, tmp_path):
    """A row per document, stored in so few bytes that Spark would choose to."""
    for name in "abc":
        (tmp_path / name).write_bytes(np.array([5, 2] * 4000, "<u2").tobytes())
    found = token_scan.count_tokens(spark, str(tmp_path), 2, block_tokens=1000)
    planned = plan_of(found)
    assert [(r.n_tokens, r.first_token - 2 * r.doc_no) for r in found.collect()] == [(1, 0)] * 12000
    for plan in (planned, plan_of(found)):
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_counts_are_never_broadcast(spark, plan_of, tmp_path):
    spark.range(200).selectExpr("id AS doc_id", "repeat('word ', cast(id % 17 AS int)) AS text").write.parquet(f"{tmp_path}/docs")
    found = token_scan.document_token_counts(spark.read.parquet(f"{tmp_path}/docs"), model_path())
    planned = plan_of(found)
    assert {r.doc_id: r.n_tokens for r in found.collect()} == {i: len(LIBRARY.encode("word " * (i % 17))) for i in range(200)}
    assert "Broadcast" not in planned and "Broadcast" not in plan_of(found)

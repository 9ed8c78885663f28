"""Registered queries against SQL, and the pipeline against a version in plain Python."""

import math

import pytest

import __spark_entry__ as registry
import corpus_pipeline
from barlake.llm import mixing, queries
from tests.conftest import SF
from tests.llm.test_duplicates import brute_print
from tests.llm.test_mixing import brute_targets, words
from tests.oracle_check import database, differences


@pytest.mark.parametrize("name", queries.SQL)
def test_query_equals_its_sql(spark, name):
    assert differences(spark, database(SF), name, SF) == []


def test_url_sql_follows_links(spark, tmp_path):
    """The test tables hold no links, so here are some."""
    rows = [
        (1, "http://a.org/x", '<link rel="canonical" href="https://b.net/fr/1">'),
        (2, "http://c.org/y?q=1", '<meta http-equiv="refresh" content="0; url=http://a.org/x">'),
        (3, "http://d.com/z", '<link rel="canonical" href="//a.org/x">'), (4, None, None), (5, "odd", ""),
        (6, "http://e.org/p/q", '<link rel="canonical" href="r">'), (7, "http://e.org/p/r", None),
    ]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    frame.toPandas().to_parquet(f"{tmp_path}/pages.parquet")
    assert differences(spark, database(str(tmp_path)), "op1_url_redirect_filter", str(tmp_path)) == []


def test_names_and_every_query_runs(spark):
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]
    assert set(names) <= set(registry.queries())
    documents = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in names:
        frame = registry.queries()[name](spark, SF)
        if name.split("_")[0] in ("op3", "op6", "op7", "op8", "op9", "op10", "op13"):
            assert frame.count() == documents


def test_pipeline_equals_plain_steps(spark):
    """Stage by stage on its own input: what goes, and that nothing else does."""
    import sentencepiece

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: r for r in docs.collect()}
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == set(rows)

    exact = corpus_pipeline.STAGES[1][1](spark, kept, SF)
    last = {}
    for i, r in sorted(rows.items()):
        last[r.text.encode().lower()] = i
    assert exact.columns == columns and {r.doc_id for r in exact.collect()} == set(last.values())

    near = corpus_pipeline.STAGES[2][1](spark, exact, SF)
    left = {r.doc_id for r in near.collect()}
    prints = {i: brute_print(rows[i].text, 4) for i in last.values()}
    root = {i: i for i in prints}
    for a, b in ((a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4):
        low, high = sorted((root[a], root[b]))
        root = {i: low if r == high else r for i, r in root.items()}
    assert left == {i for i, r in root.items() if i == r}

    mixed = corpus_pipeline.STAGES[3][1](spark, near, SF)
    assert mixed.columns == columns
    sizes = {}
    for i in left:
        sizes[rows[i].source] = sizes.get(rows[i].source, 0) + words(rows[i].text)
    target, order = brute_targets(sizes), [r.doc_id for r in mixed.collect()]
    assert set(order) <= left
    copies = {i: order.count(i) for i in left}
    for source in sizes:  # all its documents as often as whole passes need, or once more, and the sum comes near
        of = [i for i in left if rows[i].source == source and words(rows[i].text)]
        whole = math.floor(math.floor(target[source]) / sizes[source])
        assert {copies[i] for i in of} <= {whole, whole + 1}
        read = sum(copies[i] * words(rows[i].text) for i in of)
        assert 0 <= read - math.floor(target[source]) < max(words(rows[i].text) for i in of)
    places = sorted((p, r.doc_id) for r in mixing.mix(near).collect() for p in r.positions)
    assert order == [i for _, i in places]

    final = corpus_pipeline.STAGES[4][1](spark, mixed, SF)
    library = sentencepiece.SentencePieceProcessor(model_file=queries.model_path())
    found = final.collect()
    assert len(found) == mixed.count()
    assert all(list(r.ids) == library.encode(rows[r.doc_id].text) for r in found)


def test_pipeline_of_odd_rows(spark, odd):
    """Nulls, repeated rows and empty texts pass every stage without a crash; columns stay."""
    frame = odd.select("doc_id", "text", "lang", "source", "n_chars").fillna("en", "lang")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame, SF).columns == frame.columns, name
        assert stage(spark, frame.limit(0), SF).count() == 0, name
    dropped = corpus_pipeline.STAGES[0][1](spark, frame, SF).where("text IS NULL OR NOT text RLIKE '[a-zA-Zé]'").count()
    assert dropped == 0

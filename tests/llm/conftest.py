import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "never ending " * 40_000


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text, lang, source) tuples, with columns whose names clash with inner ones."""

    def make(*rows):
        frame = spark.createDataFrame([(*r, *[None] * (4 - len(r)), 0) for r in rows], DOCS)
        return frame.selectExpr("*", "'x' AS size", "'x' AS node", "'x' AS id", "'x' AS rows", "'x' AS target")

    return make


@pytest.fixture
def odd(documents):
    """Nulls, empty and very long texts, ties and repeated rows."""
    return documents(
        (1, None), (2, ""), (3, "   \n"), (4, LONG), (5, "Same TEXT here"), (6, "same text HERE"),
        (6, "same text HERE"), (7, "É is not é"), (8, "é is not é"), (None, "no id"), (None, None), (9, "1234 !?"),
    )

"""From raw documents to token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read
back as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import langid, mixing, pieces, queries, simhash, trie_dedup
from barlake.llm.common import Scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told. Null texts and texts without letters go, and texts of which
    next to nothing is known from any language."""
    return langid.understood(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the one with the largest doc_id."""
    return trie_dedup.kept_documents(docs, keep="max")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose fingerprints (four-word shingles) are linked by steps of at most four bits, the one with
    the smallest doc_id."""
    return simhash.representatives(docs, words=4, differing=4)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once for each pass in which the mix reads it, in the order of training; documents
    that it never reads go."""
    return mixing.in_training_order(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the ids of its pieces, their number, and digests of the ids and the decoded text."""
    coded = pieces.round_trip(docs, queries.model_path())
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", source_mix),
    ("SentencePiece encoding and decoding", to_pieces),
]

#: SQL has no language filters, fingerprints or pieces; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is stored in the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)

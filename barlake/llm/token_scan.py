"""Token counts from flat token files without an index, by a scan for end-of-document ids.

A file is nothing but ids of a fixed width, one document behind the other, each closed by the
end-of-document id. It is read in blocks of a fixed size that know nothing of documents. A block is
searched for the id in one vectorised comparison; a prefix scan over the blocks' summaries then gives
every block the number of documents closed before it and the tokens carried into it, which stitches
the documents that cross a boundary.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barlake.llm.common import Scratch, ship
from barlake.llm.pieces import codec

#: Bytes per id: the vocabulary decides between 2 and 4.
WIDTHS = {2: "<u2", 4: "<u4"}


#: A token file is closed at so many documents, or behind the one that fills so many bytes: a task reads it as
#: one value.
DOCS_PER_FILE, BYTES_PER_FILE = 4096, 32 << 20


def write_token_files(docs: DataFrame, path: str, model_path: str, width: int = 2, batch: int = 256) -> int:
    """Write the texts of ``docs(text)`` as flat token files of ``DOCS_PER_FILE`` documents or somewhat
    over ``BYTES_PER_FILE`` bytes, whichever comes first; returns the end-of-document id, which the model
    must have and no text can hold.

    The text writer puts its line separator behind each row and a row into a file of its own; here a row
    is the ids of a file's documents as bytes, with the end-of-document id between them, and the separator is
    that id too. A null text is a document without tokens. A long document closes its file, so a file's
    size is bounded by that of the longest document and ``BYTES_PER_FILE`` together.
    """
    import sentencepiece

    spark = docs.sparkSession
    ship(spark)
    with open(model_path, "rb") as file:
        raw = file.read()
    end = sentencepiece.SentencePieceProcessor(model_proto=raw).eos_id()
    if not 0 <= end < 128:
        raise ValueError("the end-of-document id must exist and be below 128")
    model = spark.sparkContext.broadcast(raw)
    most_docs, most_bytes, mark = DOCS_PER_FILE, BYTES_PER_FILE, end.to_bytes(width, "little")
    rows = docs.select(F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model.value)
        if len(own.pieces) > 1 << (8 * width):
            raise ValueError("ids need more bytes")

        def closed(held: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([mark.join(held)], pa.binary())], ["tokens"])

        held, size = [], 0
        for whole in batches:
            for start in range(0, whole.num_rows, batch):
                texts = [t.decode("utf-8", "replace") for t in whole.slice(start, batch).column(0).to_pylist()]
                for ids in own.encode(texts):
                    held.append(np.frombuffer(ids, "<i4").astype(WIDTHS[width]).tobytes())
                    size += len(held[-1]) + width
                    if len(held) >= most_docs or size >= most_bytes:
                        yield closed(held)
                        held, size = [], 0
        if held:
            yield closed(held)

    tokens = rows.mapInArrow(work, "tokens binary")
    writer = tokens.select(F.col("tokens").cast("string").alias("value")).write
    writer.option("lineSep", mark.decode("ascii")).option("maxRecordsPerFile", 1).text(path)
    return end


def _scan(end: int, width: int, block_tokens: int):
    """Closed documents of each block of each file, the last row being what follows the last of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, content = batch.column(0)[i].as_py(), batch.column(1)[i].as_buffer()
                if content.size % width:
                    raise ValueError(f"not a whole number of ids: {file}")
                whole = np.frombuffer(content, WIDTHS[width])
                for block, start in enumerate(range(0, len(whole), block_tokens)):
                    ids = whole[start:start + block_tokens]
                    found = np.flatnonzero(ids == end)
                    sizes = np.r_[found, len(ids)] - np.r_[0, found + 1]
                    n = len(sizes)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([file] * n, pa.string()), pa.array(np.full(n, block, np.int64)),
                        pa.array(np.arange(n)), pa.array(sizes), pa.array(np.full(n, n - 1)),
                    ], ["file", "block", "nth", "tokens", "closed"])

    return work


def count_tokens(
    spark: SparkSession, path: str, end: int, width: int = 2, block_tokens: int = 1 << 19,
) -> DataFrame:
    """``(file, doc_no, first_token, n_tokens)`` of every document in the files below ``path``.

    ``n_tokens`` leaves out the end mark; ``first_token`` counts ids from the start of the file, marks
    included. What follows a file's last mark is a document of its own if it holds a token. A file whose
    size is no multiple of ``width`` raises. A file without bytes has no document.

    A task takes one file at a time and looks at it block by block; only counts leave the task. The
    scan over blocks sees one row per block; those of a file are in one task.
    """
    ship(spark)
    files = spark.read.format("binaryFile").load(path)
    scratch = Scratch(spark, "token-scan")
    pieces = files.where("length > 0").select("path", "content").mapInArrow(
        _scan(end, width, block_tokens), "file string, block bigint, nth bigint, tokens bigint, closed bigint"
    )
    pieces = scratch.save(pieces, "pieces")

    # Prefix scan. A block without a mark hands on what it was handed, plus itself: the tokens carried
    # are a running sum that starts anew behind every block with a mark.
    tail = F.max(F.when(F.col("nth") == F.col("closed"), F.col("tokens")))
    summary = pieces.groupBy("file", "block").agg(
        F.max("closed").alias("closed"), tail.alias("tail"), (F.sum("tokens") + F.max("closed")).alias("size")
    )
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    closed_before = F.coalesce(F.sum("closed").over(before), F.lit(0))
    summary = summary.withColumn("docs_before", closed_before)
    summary = summary.withColumn("ids_before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    # Blocks with the same number of closed documents before them, the first of which has a mark.
    reset = W.partitionBy("file", "docs_before").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    opened = F.lag("tail").over(W.partitionBy("file").orderBy("block"))
    summary = summary.withColumn("_opened", opened)
    first = F.first("_opened").over(W.partitionBy("file", "docs_before").orderBy("block").rowsBetween(W.unboundedPreceding, 0))
    carried = F.coalesce(first, F.lit(0)) + F.coalesce(F.sum("tail").over(reset), F.lit(0))
    final = F.row_number().over(W.partitionBy("file").orderBy(F.col("block").desc())) == 1
    summary = summary.withColumn("carried", carried).withColumn("final", final)

    # The pieces are a row per document, but a few bytes each as stored: by these Spark would broadcast them.
    joined = pieces.drop("closed").hint("merge").join(summary, ["file", "block"])
    whole = F.col("tokens") + F.when(F.col("nth") == 0, F.col("carried")).otherwise(0)
    inner = F.sum(F.col("tokens") + 1).over(
        W.partitionBy("file", "block").orderBy("nth").rowsBetween(W.unboundedPreceding, -1)
    )
    start = F.col("ids_before") + F.coalesce(inner, F.lit(0)) - F.when(F.col("nth") == 0, F.col("carried")).otherwise(0)
    found = joined.select(
        "file", (F.col("docs_before") + F.col("nth")).alias("doc_no"), start.alias("first_token"),
        whole.alias("n_tokens"), "nth", "closed", "final",
    )
    # A block's last piece belongs to the next block, unless the file ends with it.
    ended = (F.col("nth") < F.col("closed")) | (F.col("final") & (F.col("n_tokens") > 0))
    return found.where(ended).select("file", "doc_no", "first_token", "n_tokens")


@contextmanager
def same_splits(spark: SparkSession) -> Iterator[None]:
    """Within the block, scans of the same files are cut into the same partitions. Otherwise small inputs
    are cut by the number of cores, which changes as executors come and go."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)


def file_place(file: Column) -> tuple[Column, Column]:
    """Partition and number of the file within it, from the name ``part-<partition>-<job>-c<number>.txt``.

    The job is a UUID, which can hold ``-c`` and digits as well, so the number ends at the extension.
    """
    part, number = r"part-(\d+)-[^/]*$", r"-c(\d+)\.[^/]*$"
    return tuple(F.regexp_extract(file, pattern, 1).cast("bigint") for pattern in (part, number))


def document_token_counts(docs: DataFrame, model_path: str, width: int = 2) -> DataFrame:
    """``docs(doc_id, text)`` written as token files, scanned, and counted: one row per row of ``docs``.

    Columns: ``doc_id``, ``file``, ``doc_no`` (place in the file), ``first_token``, ``n_tokens``. The
    files hold no ids of documents; a row's file and place follow from the partition it was read in, so
    ``docs`` must be a plain scan of stored files. It is scanned twice, with the same splits, before this
    returns; a row that has no count raises. A null or empty text has no tokens. Repeated rows are
    documents of their own; other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "token-files")
    place = F.monotonically_increasing_id()  # partition in the upper 31 bits, row below them
    with same_splits(spark):
        end = write_token_files(docs, scratch.path("tokens"), model_path, width)
        ids = scratch.save(docs.select("doc_id", place.alias("_place")), "ids")
    counts = count_tokens(spark, scratch.path("tokens"), end, width)
    scratch.drop("tokens")  # the counts are stored
    part, nth_file = file_place(F.col("file"))
    # The files of a partition follow each other; a partition is what one task read.
    along = W.partitionBy("part").orderBy("nth_file", "doc_no")
    counts = counts.withColumn("part", part).withColumn("nth_file", nth_file)
    counts = counts.withColumn("row", F.row_number().over(along) - 1)
    ids = ids.select(
        "doc_id", F.shiftright("_place", 33).alias("part"), F.col("_place").bitwiseAND((1 << 33) - 1).alias("row")
    )
    file_name = F.regexp_extract("file", r"([^/]*)$", 1).alias("file")
    counted = F.coalesce("n_tokens", F.raise_error(F.lit("a document has no count")).cast("bigint"))
    # A row per document on both sides: neither is sent to all tasks, however small Spark takes it to be.
    return ids.join(counts.hint("merge"), ["part", "row"], "left").select(
        "doc_id", file_name, "doc_no", "first_token", counted.alias("n_tokens")
    )

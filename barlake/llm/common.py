"""Shared pieces: tables in the shared folder, words, ASCII lower case."""

from __future__ import annotations

import atexit
import shutil
import string
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barlake.session import ensure_checkpoint_dir

#: A word is a longest run of characters outside this set (Java and RE2 character class).
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so executors need no copy of it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    import barlake

    package = Path(barlake.__file__).parent
    folder = tempfile.mkdtemp(prefix="barlake-package-")  # read by the driver only, which hands it on
    atexit.register(shutil.rmtree, folder, True)
    context.addPyFile(shutil.make_archive(f"{folder}/barlake_package", "zip", package.parent, package.name))
    _shipped.add(context.applicationId)


class Scratch:
    """Intermediate tables in a folder of its own below the shared checkpoint folder.

    A written table cuts the lineage: what reads it needs no executor that helped to make it. Tables
    that only the operator itself reads are dropped by it; those under its result stay, because the
    result is lazy. The folder may be emptied when the session is over.
    """

    def __init__(self, spark: SparkSession, name: str):
        ensure_checkpoint_dir(spark)
        self.spark = spark
        self.root = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def save(self, frame: DataFrame, table: str) -> DataFrame:
        frame.write.parquet(self.path(table))
        return self.spark.read.schema(frame.schema).parquet(self.path(table))

    def drop(self, table: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def numbered(rows: DataFrame, name: str, scratch: Scratch, table: str) -> DataFrame:
    """``rows``, stored, with a column ``name`` that counts them from 1 without gaps, in no particular order.

    Each task numbers its own rows as it writes them; what the tasks before it have written is added, which
    is one row per task.
    """
    spot, part = free_name(rows.columns, "_spot"), free_name(rows.columns, "_part")
    stored = scratch.save(rows.withColumn(spot, F.monotonically_increasing_id()), f"{table}-unnumbered")
    stored = stored.withColumn(part, F.shiftright(spot, 33))  # the task; its rows stand in the lower bits
    sizes = stored.groupBy(part).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(part, before.alias("_before"))
    number = F.col("_before") + F.col(spot).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    found = scratch.save(stored.join(F.broadcast(starts), part).select(*rows.columns, number.alias(name)), table)
    scratch.drop(f"{table}-unnumbered")
    return found


#: Ids that are sent to every task (some 40 bytes each); more of them are joined through a shuffle.
SENT_IDS = 300_000


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, or that with underscores behind it until no column has the name."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def without_rows(
    docs: DataFrame, gone: DataFrame, key: Callable[[bytes], object], kind: str, sent: int = SENT_IDS,
) -> DataFrame:
    """Rows of ``docs`` whose doc_id stands in ``gone(doc_id, key)`` with the key of their own text are left
    out, so other texts of a repeated id stay; rows with a null doc_id stay too. ``kind`` is the key's type."""
    listed = free_name(docs.columns, "_keys")
    gone = gone.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.collect_set("key").alias(listed))
    gone = Scratch(docs.sparkSession, "gone").save(gone, "ids")
    few = gone.count() <= sent

    def keys(texts: pd.Series) -> pd.Series:
        return pd.Series([None if text is None else key(bytes(text)) for text in texts], dtype=object)

    joined = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left")
    asked = F.when(F.col(listed).isNotNull(), F.coalesce(F.col("text").cast("binary"), F.lit(b"")))  # others are not read
    own = F.pandas_udf(keys, kind)(asked)
    stays = F.col(listed).isNull() | ~F.array_contains(listed, own)
    return joined.where(stays).select(docs.columns)


def ascii_lower(text: Column) -> Column:
    """Lower case of A-Z alone."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null. Each word with the space behind it becomes one mark."""
    marks = F.regexp_replace(text, rf"{WORD}[{SPACE}]*", "-")
    return F.coalesce(F.length(F.regexp_replace(marks, rf"^[{SPACE}]+", "")), F.lit(0)).cast("bigint")

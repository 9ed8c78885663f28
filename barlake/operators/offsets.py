"""Offset audit: which records of the log are missing from the stored tables, and which are there twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def offset_gaps(
    rows: DataFrame, chunk: int = 1_000_000, partition: str = "kafka_partition", offset: str = "kafka_offset",
    starts: DataFrame | None = None,
) -> DataFrame:
    """Ranges of consecutive offsets that ``rows`` lack (``missing``) or have more than once (``repeated``).

    Columns: ``partition``, ``kind``, ``first_offset``, ``last_offset`` and ``n``: offsets that are missing, or copies
    beyond the first. Pass bronze and quarantine together, as every record goes to one of them. A partition is
    judged from its lowest to its highest offset; with ``starts(partition, first_offset)`` from there on. Rows
    without partition or offset are left out.

    Offsets are cut into chunks, so a log partition with most records is spread over as many tasks as it has
    chunks. What lies within a chunk is decided there; only the chunks' ends, a few rows each, are put
    together per log partition.
    """
    known = rows.where(F.col(partition).isNotNull() & F.col(offset).isNotNull())
    known = known.select(F.col(partition).alias("_p"), F.col(offset).cast("bigint").alias("_o"))
    known = known.withColumn("_chunk", F.floor(F.col("_o") / chunk)).repartition("_p", "_chunk")
    counted = known.groupBy("_p", "_chunk", "_o").agg(F.count("*").alias("_n"))
    along = W.partitionBy("_p", "_chunk").orderBy("_o")
    parts = W.partitionBy("_p").orderBy("_chunk")

    before = F.lag("_o").over(along)
    inner = counted.withColumn("_before", before).where("_o > _before + 1")
    inner = inner.select("_p", (F.col("_before") + 1).alias("first"), (F.col("_o") - 1).alias("last"))
    ends = counted.groupBy("_p", "_chunk").agg(F.min("_o").alias("_low"), F.max("_o").alias("_high"))
    ends = ends.withColumn("_before", F.lag("_high").over(parts))
    if starts is not None:
        begin = starts.select(F.col(partition).alias("_p"), (F.col("first_offset") - 1).alias("_begin"))
        ends = ends.join(begin, "_p", "left").withColumn("_before", F.coalesce("_before", "_begin"))
    outer = ends.where("_low > _before + 1").select("_p", F.expr("_before + 1").alias("first"), F.expr("_low - 1").alias("last"))
    missing = inner.union(outer).withColumn("n", F.col("last") - F.col("first") + 1).withColumn("kind", F.lit("missing"))

    copies = counted.where("_n > 1").withColumn("_island", F.col("_o") - F.row_number().over(along))
    copies = copies.groupBy("_p", "_chunk", "_island").agg(
        F.min("_o").alias("first"), F.max("_o").alias("last"), F.sum(F.col("_n") - 1).alias("n")
    )
    at_edge = (F.col("first") == F.col("_chunk") * chunk) | (F.col("last") == (F.col("_chunk") + 1) * chunk - 1)
    in_order = W.partitionBy("_p").orderBy("first")
    edges = copies.where(at_edge).withColumn("_new", (F.lag("last").over(in_order) == F.col("first") - 1).cast("int"))
    edges = edges.withColumn("_run", F.sum(1 - F.coalesce("_new", F.lit(0))).over(in_order))
    edges = edges.groupBy("_p", "_run").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"))
    repeated = copies.where(~at_edge).select("_p", "first", "last", "n").union(edges.drop("_run"))
    found = missing.unionByName(repeated.withColumn("kind", F.lit("repeated")))
    return found.select(
        F.col("_p").alias(partition), "kind", F.col("first").alias("first_offset"), F.col("last").alias("last_offset"), "n"
    )

"""Silver kept up to date by a stream: the newest row per natural key, merged into the dates it touches."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barlake.operators.dedup import newest, recency
from barlake.schemas import NATURAL_KEY
from barlake.session import store
from barlake.sources import lake

ARRIVED = "bronze_ingested_at"


@dataclass(frozen=True)
class Tables:
    """``latest`` holds the newest row of every key, also those whose price keeps them out of ``silver``: an
    older row that comes later must not bring such a key back. ``batches`` names the last batch that is done."""

    latest: str
    silver: str
    batches: str


def newest_by_arrival(bronze: DataFrame, delay: str = "1 day", span: str = "1 hour") -> DataFrame:
    """Newest row per natural key among the rows that arrived in one ``span``, as keyed state of a stream.

    The watermark runs over arrival times, not event times: an event may be as late as it likes, and state is
    dropped once its span of arrivals is ``delay`` old. Rows that arrive out of order by more than that are not
    taken; ``dropped`` counts them.
    """
    rest = [c for c in bronze.columns if c not in NATURAL_KEY]
    marked = bronze.withWatermark(ARRIVED, delay)
    grouped = marked.groupBy(F.window(ARRIVED, span).alias("_span"), *NATURAL_KEY)
    kept = grouped.agg(F.max_by(F.struct(*rest), recency(rest)).alias("_row"))
    return kept.select(*[F.col(c if c in NATURAL_KEY else f"_row.{c}").alias(c) for c in bronze.columns])


def merge_batch(rows: DataFrame, batch: int, tables: Tables) -> None:
    """Fold newest rows into the dates they touch. A batch that is done already changes nothing, and one that
    stopped half way gives the same rows when it runs again: what is kept is the newest of all."""
    spark = rows.sparkSession
    done = lake.latest_snapshot(spark, tables.batches)
    if done is not None and spark.read.parquet(done).first()["batch"] >= batch:
        return
    fresh = store(rows)
    dates = sorted(r["date"] for r in fresh.select("date").distinct().collect())  # dates, not data
    if dates:
        if lake.exists(spark, tables.latest):
            # Read and replaced at once: stored first.
            held = lake.read(spark, tables.latest, dates).select(*fresh.columns)
            fresh = store(newest(held.unionByName(fresh)))
        lake.write_partitions(fresh, tables.latest, "date", NATURAL_KEY, only=dates)
        lake.write_partitions(fresh.where("close > 0"), tables.silver, "date", NATURAL_KEY, only=dates)
    lake.write_snapshot(spark.range(1).select(F.lit(batch).cast("bigint").alias("batch")), tables.batches)


def start(
    bronze: DataFrame, tables: Tables, checkpoint: str, delay: str = "1 day", span: str = "1 hour",
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Keep silver up to date from a stream of bronze rows (with ``date``)."""
    updates = newest_by_arrival(bronze, delay, span)
    writer = updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(lambda rows, batch: merge_batch(rows, batch, tables))
    return (writer.trigger(**trigger) if trigger else writer).start()


def dropped(query: StreamingQuery) -> int:
    """Rows that came too late for the state, in the batches that the query still remembers. If there are any,
    ``jobs.refine_silver`` of their dates takes them in."""
    states = [state for progress in query.recentProgress for state in progress["stateOperators"]]
    return sum(state["numRowsDroppedByWatermark"] for state in states)


def read(spark: SparkSession, tables: Tables) -> DataFrame:
    return lake.read(spark, tables.silver)

"""Keyed event log: stream source, batch sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def source_options(
    servers: str, topic: str, starting: str = "earliest",
    min_partitions: int | None = None, max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options. ``min_partitions`` splits few or uneven topic partitions over more tasks."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "minPartitions": min_partitions,
        "maxOffsetsPerTrigger": max_offsets_per_trigger,
    }
    return {name: str(value) for name, value in options.items() if value is not None}


def sink_options(servers: str, topic: str, acks: str = "all", retries: int = 5) -> dict[str, str]:
    """Writer options: acknowledged by all in-sync replicas, transient failures retried."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": acks,
        "kafka.retries": str(retries),
    }


def read_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def write_batch(messages: DataFrame, options: Mapping[str, str]) -> None:
    messages.write.format("kafka").options(**options).save()

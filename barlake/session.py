"""Session helpers: object store settings and the checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


def object_store_conf(
    endpoint: str | None = None, access_key: str | None = None, secret_key: str | None = None,
    tls: bool = False, path_style: bool = True,
) -> dict[str, str]:
    """Spark settings that address an S3-compatible store through ``s3a://`` paths."""
    settings = {
        "endpoint": endpoint,
        "access.key": access_key,
        "secret.key": secret_key,
        "path.style.access": str(path_style).lower(),
        "connection.ssl.enabled": str(tls).lower(),
    }
    return {f"spark.hadoop.fs.s3a.{name}": v for name, v in settings.items() if v is not None}


def build_session(app: str, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for name, value in {"spark.sql.session.timeZone": "UTC", **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster it must be set,
    because a folder of one machine is gone with the machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.match(r"local(\[|$)", context.master):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="barlake-checkpoints-")
    context.setCheckpointDir(shared)


def store(frame: DataFrame) -> DataFrame:
    """``frame`` computed once and written as a table below the shared checkpoint folder.

    A written table cuts the lineage, and it can be read as often as needed: what reads it needs no executor
    that helped to make it. Tables stay until the folder is emptied.
    """
    spark = frame.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def tasks_sized_for(
    spark: SparkSession, input_bytes: int, task_bytes: int = 512 << 20,
    most_readers: int = 100_000, most_shuffled: int = 40_000,
) -> Iterator[tuple[int, int]]:
    """Fit scan splits and shuffle partitions to the input; yields ``(split bytes, partitions)``.

    Adaptive execution merges partitions that turn out small but cannot cut those of an aggregation,
    so their count follows the input. The limits keep the number of shuffle blocks, one per reader and
    partition, in reach for inputs of many terabytes: splits grow instead, and partitions spill. The
    session's own settings are lower bounds.
    """
    conf = spark.conf
    before = {name: conf.get(name) for name in (SPLIT_BYTES, SHUFFLE_PARTITIONS)}
    own_split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before[SPLIT_BYTES])
    split = max(own_split, -(-input_bytes // most_readers))
    partitions = min(most_shuffled, -(-input_bytes // task_bytes))
    partitions = max(int(before[SHUFFLE_PARTITIONS]), partitions)
    try:
        conf.set(SPLIT_BYTES, f"{split}b")
        conf.set(SHUFFLE_PARTITIONS, str(partitions))
        yield split, partitions
    finally:
        for name, value in before.items():
            conf.set(name, value)

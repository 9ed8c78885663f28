"""Parquet layers: scans, partitioned writes that stand skew, and versioned snapshots."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def read(spark: SparkSession, path: str, dates: Iterable[str] | None = None) -> DataFrame:
    """A layer, or only the given ``date`` partitions of it (pruned before any file is opened).

    ``date`` is text as it stands in the folder names, whatever type Spark would infer from them: so
    2026-7-3 and 2026-07-03 stay apart, and folders that are all digits do not become numbers.
    """
    frame = spark.read.parquet(path)
    if frame.schema["date"].dataType != T.StringType():
        fields = [T.StructField("date", T.StringType()) if f.name == "date" else f for f in frame.schema]
        frame = spark.read.schema(T.StructType(fields)).parquet(path)
    return frame if dates is None else frame.where(F.col("date").isin(*dates))


def partition_path(spark: SparkSession, path: str, column: str, value: str) -> str:
    """Folder of a partition; Spark escapes characters that paths cannot hold."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{path}/{column}={escape(value)}"


def _data_files(spark: SparkSession, path: str) -> set[str]:
    """Names of the data files right below ``path``; none if it does not exist."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return set()
    names = {status.getPath().getName() for status in fs.listStatus(target) if status.isFile()}
    return {name for name in names if not name.startswith(("_", "."))}


def stored_bytes(spark: SparkSession, path: str, dates: Iterable[str] | None = None) -> int:
    """Size of a layer, or of some of its dates, from file listings alone."""
    if dates is None:
        scan = spark.read.parquet(path)
        return int(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    parts = [_fs(spark, partition_path(spark, path, "date", date)) for date in dates]
    return sum(fs.getContentSummary(part).getLength() for fs, part in parts if fs.exists(part))


def in_ranges(frame: DataFrame, *keys: str) -> DataFrame:
    """Lay rows out in ranges of ``keys``, sorted within each task.

    Tasks are contiguous ranges, so ``n`` tasks over ``d`` values of the first key write at most
    ``n + d`` files when that key partitions the table. If the keys together are unique, a range can
    always be cut: a date that holds a third of all rows goes to a third of the tasks. (Hashing by
    date would put it in one task, and splitting that task by its inputs would scatter every other
    date it holds.) Sorted files also let readers skip row groups.
    """
    return frame.repartitionByRange(*keys).sortWithinPartitions(*keys)


def observed(metrics: Observation, otherwise: Callable[[], dict[str, Any]]) -> dict[str, Any]:
    """Metrics of a finished action.

    When adaptive execution finds at run time that the result is empty, it cuts the plan down to an
    empty relation and the observation goes with it; ``otherwise`` then finds the metrics in what was
    written, without taking the lost observation as a sign of anything.
    """
    try:
        return metrics.get
    except Py4JJavaError:
        return otherwise()


def write_partitions(
    frame: DataFrame, path: str, column: str, keys: Sequence[str],
    only: Iterable[str | int] | None = None,
) -> dict[str, int]:
    """Replace a table partitioned by ``column``, or only some of its values; returns ``{"rows": n}``.

    ``keys`` tell the rows of one value apart. The count is observed in the writing stage itself, so
    there is no second pass and a task that is run again still counts once.

    A value in ``only`` that got no rows loses its partition. Files carry the name of the job that wrote
    them, so a folder that holds the same files as before the write got none; nothing else is dropped.
    """
    spark, rows = frame.sparkSession, Observation()
    asked = {} if only is None else {str(v): partition_path(spark, path, column, str(v)) for v in only}
    before = {folder: _data_files(spark, folder) for folder in asked.values()}
    counted = in_ranges(frame, column, *keys).observe(rows, F.count("*").alias("rows"))
    writer = counted.write.mode("overwrite").partitionBy(column)
    writer.option("partitionOverwriteMode", "static" if only is None else "dynamic").parquet(path)

    for folder, files in before.items():
        if files and _data_files(spark, folder) == files:
            drop(spark, folder)
    return observed(rows, lambda: {"rows": _written_rows(frame, path, column, before)})


def _written_rows(frame: DataFrame, path: str, column: str, before: dict[str, set[str]]) -> int:
    """Rows of a table that was just written, or of the folders that were written anew."""
    spark = frame.sparkSession
    if before:
        fresh = [f for f, files in before.items() if _data_files(spark, f) - files]
    else:
        fs, target = _fs(spark, path)
        fresh = [s.getPath().toString() for s in fs.listStatus(target) if s.isDirectory()]
    kinds = T.StructType([f for f in frame.schema if f.name != column])
    return spark.read.schema(kinds).parquet(*fresh).count() if fresh else 0


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none if it does not exist."""
    fs, target = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()) if fs.exists(target) else []


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, as a mark."""
    fs, mark = _fs(spark, path)
    fs.create(mark, True).close()


def drop(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def write(frame: DataFrame, path: str) -> dict[str, int]:
    """Replace a flat layer; returns ``{"rows": n}``."""
    rows = Observation()
    counted = frame.observe(rows, F.count("*").alias("rows"))
    counted.write.mode("overwrite").parquet(path)
    return observed(rows, lambda: {"rows": frame.sparkSession.read.schema(frame.schema).parquet(path).count()})


#: Completed snapshots that stay: the live one and those that running readers may still hold.
SNAPSHOTS_KEPT = 3
DONE = "_COMPLETE"


def _snapshots(spark: SparkSession, root: str) -> list[tuple[int, bool]]:
    """Number and completeness of every snapshot below ``root``."""
    fs, target = _fs(spark, root)
    if not fs.exists(target):
        return []
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    found = []
    for status in fs.listStatus(target):
        name = status.getPath().getName()
        if name.startswith("snapshot="):
            done = any(fs.exists(path_of(status.getPath(), mark)) for mark in (DONE, "_SUCCESS"))
            found.append((int(name.partition("=")[2]), done))
    return sorted(found)


def latest_snapshot(spark: SparkSession, root: str) -> str | None:
    """Path of the newest complete snapshot; None only if there is no snapshot at all. Snapshots none of
    which is complete raise: to take them for a first load would give keys anew."""
    found = _snapshots(spark, root)
    complete = [number for number, done in found if done]
    if found and not complete:
        raise RuntimeError(f"{root} holds snapshots, but none is complete; remove them to load it anew")
    return f"{root}/snapshot={complete[-1]}" if complete else None


def complete_snapshots(spark: SparkSession, root: str) -> list[str]:
    """Paths of all complete snapshots, the newest last."""
    return [f"{root}/snapshot={number}" for number, done in _snapshots(spark, root) if done]


def write_snapshot(frame: DataFrame, root: str, held: Iterable[str] = ()) -> str:
    """Write a new snapshot next to the one ``frame`` may read from, mark it complete, and drop complete
    ones before the last ``SNAPSHOTS_KEPT``, but for those ``held``. Readers take the newest complete one."""
    spark = frame.sparkSession
    taken = [number for number, _ in _snapshots(spark, root)]
    path = f"{root}/snapshot={max(taken, default=0) + 1}"
    write(frame.hint("rebalance"), path)  # the parts of a merge are many and small
    touch(spark, f"{path}/{DONE}")
    for old in complete_snapshots(spark, root)[:-SNAPSHOTS_KEPT]:
        if old not in held:
            drop(spark, old)
    return path

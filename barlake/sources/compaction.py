"""Closed dates of a stream's table, rewritten in few files beside it.

The stream's file sink owns its folder and its commit log, so its files are never exchanged. A date is
rewritten into a folder of its own, and a mark names that folder and the files it was made from. Readers take a
date from one place or from the other, never from both: from the rewritten folder if the stream's table
still holds just the files that the mark names, else from the stream's table, which always has all rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.sources import lake


def _stored(spark: SparkSession, layer: str, dates: Iterable[str] | None) -> dict[str, list[str]]:
    """Names of the committed files of each date; file names, not data."""
    found: dict[str, list[str]] = defaultdict(list)
    for path in lake.read(spark, layer).inputFiles():
        folder, name = path.rsplit("/", 2)[-2:]
        found[unquote(unquote(folder).partition("=")[2])].append(name)
    asked = found if dates is None else set(dates) & set(found)
    return {date: sorted(found[date]) for date in asked}


def _folder(spark: SparkSession, target: str, date: str) -> str:
    return lake.partition_path(spark, target, "date", date)


def _made(spark: SparkSession, target: str, date: str) -> tuple[str, list[str]] | None:
    """Folder of the rewritten date and the files it was made from; None if no rewriting is complete."""
    marks = f"{_folder(spark, target, date)}/marks"
    mark = lake.latest_snapshot(spark, marks) if lake.exists(spark, marks) else None
    if mark is None:
        return None
    row = spark.read.parquet(mark).first()
    return f"{_folder(spark, target, date)}/{row['made']}", list(row["files"])


def compact(spark: SparkSession, layer: str, target: str, dates: Iterable[str], keys: Sequence[str]) -> list[str]:
    """Rewrite ``dates`` of ``layer`` below ``target``, in ranges of ``keys``; returns the dates that were rewritten.

    A date whose files have not changed since is left out. Rows go to a new folder, then a mark makes it valid;
    a run that stops in between has changed nothing for readers. The folder before the last stays for those
    who still read it.
    """
    rewritten = []
    for date, files in _stored(spark, layer, list(dates)).items():
        made, root = _made(spark, target, date), _folder(spark, target, date)
        if made is not None and made[1] == files:
            continue
        taken = [name for name in lake.folders(spark, root) if name.startswith("made-")]
        name = f"made-{max((int(n.removeprefix('made-')) for n in taken), default=0) + 1}"
        # Of these files and no others: the stream may go on writing.
        rows = lake.read(spark, layer, [date])
        listed = rows.where(F.element_at(F.split(F.input_file_name(), "/"), -1).isin(files))
        lake.write(lake.in_ranges(listed.drop("date"), *keys), f"{root}/{name}")
        mark = spark.createDataFrame([(name, files)], "made string, files array<string>")
        lake.write_snapshot(mark, f"{root}/marks")
        for old in sorted(taken, key=lambda n: int(n.removeprefix("made-")))[:-1]:
            lake.drop(spark, f"{root}/{old}")
        rewritten.append(date)
    return sorted(rewritten)


def read(spark: SparkSession, layer: str, target: str, dates: Iterable[str] | None = None) -> DataFrame:
    """``layer``, or some dates of it, each date from the place that is to be read."""
    stored = _stored(spark, layer, None if dates is None else list(dates))
    made = {date: _made(spark, target, date) for date in stored}
    compacted = {date: made[date][0] for date, files in stored.items() if made[date] is not None and made[date][1] == files}
    rest, kinds = sorted(set(stored) - set(compacted)), lake.read(spark, layer).schema
    parts = [lake.read(spark, layer, rest)] if rest or not compacted else []
    for date, path in sorted(compacted.items()):
        rows = spark.read.schema(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds if f.name != "date"))
        parts.append(rows.parquet(path).withColumn("date", F.lit(date)))
    return reduce(DataFrame.unionByName, parts).select(*kinds.names)

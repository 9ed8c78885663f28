"""Dense surrogate keys without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barlake.session import store

#: Keys of a range, on average: what one task sorts and numbers.
RANGE_ROWS = 1_000_000
#: Ranges whose sizes one task adds up; the sums of such groups are added up once more.
GROUP = 1024
_SPOT_BITS = 33  # Spark's increasing ids hold the task above, the row below


def range_count(rows: int, range_rows: int = RANGE_ROWS) -> int:
    """Ranges grow with the rows, so that a range's size does not."""
    return max(1, -(-rows // range_rows))


def laid_out(keys: DataFrame, by: Sequence[str], ranges: int) -> DataFrame:
    """``keys`` in ranges of ``by``, sorted, stored with ``_range`` and ``_row``, the place of a row in its range."""
    spot = F.monotonically_increasing_id()
    sorted_keys = keys.repartitionByRange(ranges, *by).sortWithinPartitions(*by).withColumn("_spot", spot)
    rows = store(sorted_keys)
    place = F.col("_spot").bitwiseAND(F.lit((1 << _SPOT_BITS) - 1))
    return rows.withColumns({"_range": F.shiftright("_spot", _SPOT_BITS), "_row": place}).drop("_spot")


def sums_below(sizes: DataFrame, place: str, n: str, out: str, group: int = GROUP) -> DataFrame:
    """``sizes`` with the sum of ``n`` over all smaller ``place`` (integers from 0), in two levels."""
    inside = W.partitionBy("_group").orderBy(place).rowsBetween(W.unboundedPreceding, -1)
    among = W.orderBy("_group").rowsBetween(W.unboundedPreceding, -1)
    grouped = sizes.withColumn("_group", F.floor(F.col(place) / group))
    groups = grouped.groupBy("_group").agg(F.sum(n).alias("_n"))  # one row per `group` ranges
    groups = groups.select("_group", F.coalesce(F.sum("_n").over(among), F.lit(0)).alias("_below"))
    within = grouped.withColumn("_within", F.coalesce(F.sum(n).over(inside), F.lit(0)))
    return within.join(groups, "_group").withColumn(out, F.col("_below") + F.col("_within")).drop("_group", "_below", "_within")


def dense_ids(
    keys: DataFrame, by: str | Sequence[str], out: str, start: Column | int = 0, range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``start + row_number() over (order by <by>)`` for key columns that are unique together.

    The keys are counted, laid out in as many ranges as their number asks for, sorted and stored with their
    place within the range; a key's number is its place plus the sizes of the ranges below. The sizes take
    one row per range, that is 16 bytes for ``range_rows`` keys, so they are sent to all tasks. Stored
    places stay as they are if a task is run again. ``keys`` are read three times (count, bounds, layout): pass
    them stored if they are dear.
    """
    by = [by] if isinstance(by, str) else list(by)
    rows = laid_out(keys, by, range_count(keys.count(), range_rows))
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_size"))
    starts = sums_below(sizes, "_range", "_size", "_start").select("_range", "_start")
    start = start if isinstance(start, Column) else F.lit(start)
    number = (start + F.col("_start") + F.col("_row") + 1).cast("int")
    return rows.join(F.broadcast(starts), "_range").select(*keys.columns, number.alias(out))

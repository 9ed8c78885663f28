"""Row counts per layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.operators.dedup import recency
from barlake.schemas import NATURAL_KEY


def layer_counts(checked: DataFrame) -> DataFrame:
    """Rows of the log, of its two branches and of silver, all from one pass over checked events.

    Valid events are counted per natural key along with the close of their latest version, which
    decides whether the key makes a silver row; rejected events share one group, summed up in every
    map task.
    """
    valid = F.col("error_reason") == ""
    groups = checked.groupBy(
        valid.alias("valid"), *[F.when(valid, F.col(c)).alias(c) for c in NATURAL_KEY]
    ).agg(F.count("*").alias("n"), F.max_by("close", recency(checked.columns)).alias("close"))
    tally = {
        "events": F.sum("n"),
        "bronze": F.sum(F.when(F.col("valid"), F.col("n"))),
        "quarantine": F.sum(F.when(~F.col("valid"), F.col("n"))),
        "silver": F.count_if(F.col("valid") & (F.col("close") > 0)),
    }
    rows = [
        F.struct(F.lit(layer).alias("layer"), F.coalesce(n, F.lit(0).cast("bigint")).alias("n"))
        for layer, n in tally.items()
    ]
    return groups.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))

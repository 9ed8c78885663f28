"""Time the shuffling operators on a blown-up, skewed copy of the events table.

Every event is repeated ``COPIES`` times with shifted times; a third of all rows belongs to one symbol,
and a third of that symbol's rows are copies of one natural key. For some operators the plain form is
timed next to the one used, to show what the difference buys.

    BENCH_SF_DIR=/root/testdata/sf0.1 COPIES=50 python tools/skew_bench.py
"""

from __future__ import annotations

import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import Window as W
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from barlake.operators.counters import counter_rate  # noqa: E402
from barlake.operators.dedup import clean  # noqa: E402
from barlake.operators.facts import daily_ohlcv  # noqa: E402
from barlake.operators.surrogate import dense_ids  # noqa: E402
from barlake.operators.tickers import current_attrs  # noqa: E402
from barlake.operators.validation import split_valid, to_envelope, validate  # noqa: E402
from barlake.session import build_session  # noqa: E402
from barlake.sources import lake  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("COPIES", "50"))

LOG = """
SELECT CAST(symbol AS BINARY) AS key,
 CAST(to_json(named_struct('symbol', symbol, 'timestamp', time, 'open', price, 'high', price + 1, 'low', price - 1,
  'close', price, 'volume', event_id, 'source', 'feed', 'interval', '1m', 'currency', 'USD')) AS BINARY) AS value,
 'stock-prices' AS topic, CAST(event_id % 8 AS INT) AS partition, event_id * {copies} + copy AS offset,
 current_timestamp() AS timestamp
FROM (SELECT *, value + 2 AS price, IF(event_id % 3 = 0, 'HOT', concat('S', user_id, '_', copy)) AS symbol,
 IF(event_id % 9 = 0, '2024-01-01T00:00:00Z',
  date_format(ts + make_interval(0, 0, 0, copy), "yyyy-MM-dd'T'HH:mm:ss'Z'")) AS time
 FROM {events} LATERAL VIEW explode(sequence(1, {copies})) c AS copy)
"""


def timed(label: str, action) -> None:
    begun = time.perf_counter()
    action()
    print(f"{label:40s} {time.perf_counter() - begun:8.2f} s", flush=True)


def sink(frame):
    return lambda: frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session("skew", {
        "spark.master": f"local[{CPUS}]", "spark.sql.shuffle.partitions": "32",
        "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR",
    })
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").repartition(32)
    spark.sql(LOG, events=events, copies=COPIES).write.parquet(f"{root}/log")
    log = spark.read.parquet(f"{root}/log")
    print(f"{log.count()} events, {sum(f.stat().st_size for f in Path(root, 'log').iterdir()) >> 20} MB")

    checked = validate(to_envelope(log))
    timed("validate, bronze branch", sink(split_valid(checked)))
    plain = to_envelope(log).withColumn("event", F.from_json("raw_payload", "close DOUBLE, high DOUBLE, low DOUBLE"))
    plain = plain.select("*", F.concat_ws(",", *[
        F.when(F.expr(rule), rule) for rule in ("event.close<=0", "event.high<event.low", "event.high<event.close")
    ]).alias("reason")).where("reason = ''")
    timed("  plain projection, 3 of 11 rules", sink(plain))

    split_valid(checked).write.parquet(f"{root}/bronze")
    bronze = spark.read.parquet(f"{root}/bronze")
    timed("dedup on natural key", sink(clean(bronze)))
    newest = W.partitionBy("symbol", "timestamp").orderBy(F.desc("bronze_ingested_at"), F.desc("kafka_offset"))
    ranked = bronze.withColumn("rn", F.row_number().over(newest)).where("rn = 1 AND close > 0")
    timed("  ranking window", sink(ranked))
    timed("dedup and write by date", lambda: lake.write_partitions(
        clean(bronze), f"{root}/silver", "date", ["timestamp", "symbol"]))
    silver = spark.read.parquet(f"{root}/silver")
    print(f"  {silver.count()} rows in {len(silver.inputFiles())} files")

    timed("daily aggregate", sink(daily_ohlcv(silver)))
    timed("current attributes", sink(current_attrs(silver)))
    symbols = silver.select("symbol").distinct()
    symbols.write.parquet(f"{root}/symbols")
    symbols = spark.read.parquet(f"{root}/symbols")
    timed(f"dense ids of {symbols.count()} symbols", sink(dense_ids(symbols, "symbol", "id")))
    timed("  one global window", sink(symbols.withColumn("id", F.row_number().over(W.orderBy("symbol")))))

    samples = bronze.select(
        F.when(F.col("symbol") == "HOT", "HOT").otherwise("REST").alias("symbol"),
        F.unix_seconds(F.col("timestamp").cast("timestamp")).alias("ts"), "kafka_offset",
        (F.col("kafka_offset") % 1000).cast("double").alias("value"),
    )
    samples.write.parquet(f"{root}/samples")
    samples = spark.read.parquet(f"{root}/samples")
    timed("rates over one hour, two series", sink(counter_rate(samples, ["symbol"], 3600, tie="kafka_offset")))
    along = W.partitionBy("symbol").orderBy("ts", "kafka_offset")
    delta = samples.withColumn("before", F.lag("value").over(along)).selectExpr(
        "*", "CASE WHEN before IS NULL THEN 0D WHEN value < before THEN value ELSE value - before END AS delta"
    )
    if os.environ.get("SLOW"):
        hour = W.partitionBy("symbol").orderBy("ts").rangeBetween(-3600, 0)
        timed("  one window per series", sink(delta.withColumn("rate", F.sum("delta").over(hour) / 3600)))
    print(f"data left in {root}")
    spark.stop()


if __name__ == "__main__":
    main()

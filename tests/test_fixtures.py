"""Silver and star of the fixtures: what goes through the shuffle, and that it leaves the same rows."""

from pyspark.sql import functions as F

from barlake import fixtures as fx
from barlake.operators.dedup import clean
from barlake.operators.tickers import current_attrs, latest_attrs, seen_attrs
from barlake.operators.validation import split_valid, to_envelope, validate, with_date, with_fields

LOG = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, arrived timestamp"


def _event(symbol, time, price):
    return (f'{{"symbol":"{symbol}","timestamp":"{time}","open":{price},"high":{price},"low":{price},"close":{price},'
            f'"volume":3,"source":"a","interval":"1h","currency":"USD","ingested_at":"x"}}').encode()


def _log(spark):
    rows = []
    for i in range(60):
        payload = b"not json" if i % 11 == 0 else _event(f"S{i % 4}", f"2026-07-{1 + i % 3:02d}T10:00:00Z", i % 7 + 0.5)
        rows.append((b"k", payload, "t", i % 2, i, None, None))
    frame = spark.createDataFrame(rows, LOG)
    return frame.withColumns({"timestamp": F.timestamp_seconds(F.lit(9)), "arrived": F.timestamp_seconds(F.col("offset") % 5)})


def test_fields_parsed_once_more_equal_those_carried_along(spark):
    log = to_envelope(_log(spark), F.col("arrived"))
    bronze = split_valid(validate(log))
    again = with_date(with_fields(clean(bronze, log.columns)))
    assert again.dtypes == bronze.dtypes
    assert sorted(map(str, again.collect())) == sorted(map(str, clean(bronze).collect())) and again.count() == 12


def test_the_dedup_of_the_wide_silver_carries_payloads_only(spark, tmp_path, plan_of):
    _lineitem(spark).write.parquet(str(tmp_path / "lineitem.parquet"))
    for frame, absent in (
        (fx.wide_silver(spark, str(tmp_path)), "ingested_at, _event"),
        (fx.silver_bars(spark, str(tmp_path), *fx.STAR_COLUMNS, text=fx.WIDE_QUOTES), "raw_payload"),
    ):
        carried = [line for line in plan_of(frame).splitlines() if "partial_max_by" in line]
        assert carried and not any(absent in line or "interval" in line for line in carried)


def _lineitem(spark):
    return spark.range(400).selectExpr(
        "id AS l_orderkey", "id % 9 AS l_partkey", "id % 3 AS l_suppkey", "CAST(id % 7 AS INT) AS l_linenumber",
        "CAST(2 AS DOUBLE) AS l_quantity", "CAST(100 + id % 8 AS DOUBLE) AS l_extendedprice",
        "timestamp_seconds(788918400 + 86400 * 5 * id) AS l_shipdate",  # 1995 to 2000
    )


def test_attributes_by_load_equal_those_of_every_load(spark, tmp_path):
    _lineitem(spark).write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = fx.silver_bars(spark, str(tmp_path), *fx.STAR_COLUMNS, text=fx.WIDE_QUOTES)
    names = spark.createDataFrame([("P1", "one")], "symbol string, company_name string")
    seen = seen_attrs(rows.withColumn("_load", fx.first_load()), "_load")
    for i, (before, _) in enumerate(fx.WIDE_LOADS):
        want = current_attrs(rows if before is None else rows.where(F.col("date") < before), names).collect()
        assert sorted(map(str, latest_attrs(seen.where(F.col("_load") <= i), names).collect())) == sorted(map(str, want))
        assert want

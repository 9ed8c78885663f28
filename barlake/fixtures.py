"""Inputs for the registered queries, derived from whole test tables.

Each text is a template over table names and reads the same in Spark and in the checking database, so
a query and its check start from the same rows. Prices lie on a quarter grid, which keeps sums exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators import scd2
from barlake.operators.calendar import dim_date
from barlake.operators.dedup import clean
from barlake.operators.facts import fact_daily
from barlake.operators.tickers import current_attrs, latest_attrs, seen_attrs
from barlake.operators.validation import split_valid, to_envelope, validate, with_date, with_fields
from barlake.plans.analytics import Star
from barlake.schemas import EVENT
from barlake.session import ensure_checkpoint_dir, store

ARRIVAL_EPOCH = 1706788800  # 2024-02-01 12:00 UTC
RUN_DATE = "2024-02-01"

# Bars of 20 symbols, with every kind of defect. The hour is kept, so natural keys repeat.
QUOTES = """
SELECT event_id AS kafka_offset, CAST(user_id % 4 AS INT) AS kafka_partition, event_id % 3 AS arrival,
 CASE WHEN event_id % 50 = 17 THEN NULL ELSE concat('S', lpad(CAST(user_id % 20 AS STRING), 2, '0')) END AS symbol,
 CASE WHEN event_id % 50 = 23 THEN NULL ELSE
  concat(CAST(CAST(ts AS DATE) AS STRING), 'T', lpad(CAST(hour(ts) AS STRING), 2, '0'), ':00:00Z') END AS timestamp,
 CAST(floor(value * 4) / 4 + 1 AS DOUBLE) AS open,
 CAST(CASE WHEN event_id % 50 = 11 THEN 0.25 ELSE floor(value * 4) / 4 + 1 + 0.25 * (event_id % 4) END AS DOUBLE) AS high,
 CAST(CASE WHEN event_id % 50 = 31 THEN floor(value * 4) / 4 + 6
  ELSE floor(value * 4) / 4 + 1 - 0.25 * (event_id % 3) END AS DOUBLE) AS low,
 CAST(CASE WHEN event_id % 50 = 7 THEN -1.0 ELSE floor(value * 4) / 4 + 1 END AS DOUBLE) AS close,
 CAST(CASE WHEN event_id % 50 = 13 THEN -5 WHEN event_id % 50 = 29 THEN NULL
  ELSE (event_id % 1000) * 100 END AS BIGINT) AS volume,
 CASE WHEN user_id % 20 = 7 THEN 'EUR' ELSE 'USD' END AS currency,
 CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-16' AND user_id % 2 = 0 THEN 'feed_b' ELSE 'feed_a' END AS source,
 CASE WHEN event_id % 50 = 19 THEN 'not json' WHEN event_id % 50 = 37 THEN 'tombstone' ELSE 'json' END AS form
FROM {events}
"""

# Two versions per symbol; S19 starts late, so some days have none.
VERSIONS = """
SELECT CAST(n + 1 AS INT) AS ticker_key, concat('S', lpad(CAST(n AS STRING), 2, '0')) AS symbol,
 concat('Company ', CAST(n AS STRING)) AS company_name, 'USD' AS currency, 'feed_a' AS source,
 CASE WHEN n = 19 THEN DATE '2024-01-10' ELSE DATE '2024-01-01' END AS effective_from,
 DATE '2024-01-16' AS effective_to, false AS is_current
FROM (SELECT DISTINCT user_id % 20 AS n FROM {events}) u
UNION ALL
SELECT CAST(n + 21 AS INT), concat('S', lpad(CAST(n AS STRING), 2, '0')), concat('Company ', CAST(n AS STRING)),
 'EUR', 'feed_b', DATE '2024-01-16', DATE '9999-12-31', true
FROM (SELECT DISTINCT user_id % 20 AS n FROM {events}) u
"""

# One symbol has no name.
SYMBOL_NAMES = """
SELECT concat('S', lpad(CAST(n AS STRING), 2, '0')) AS symbol, concat('Company ', CAST(n AS STRING)) AS company_name
FROM (SELECT DISTINCT user_id % 20 AS n FROM {events}) u WHERE n <> 3
"""

SUPPLIER_BARS = """
SELECT concat('P', CAST(l_suppkey AS STRING)) AS symbol, CAST(CAST(l_shipdate AS DATE) AS STRING) AS date,
 CAST(floor(l_extendedprice / l_quantity) + 1 AS DOUBLE) AS high,
 CAST(floor(l_extendedprice / l_quantity) - 1 AS DOUBLE) AS low,
 CAST(floor(l_extendedprice / l_quantity) AS DOUBLE) AS close, CAST(l_quantity AS BIGINT) AS volume
FROM {lineitem}
"""

# Bars at full time resolution. Half values put many prices close to, or on, a rounding tie.
USER_BARS = """
SELECT concat('U', CAST(user_id AS STRING)) AS symbol, ts, value / 2 AS open, value / 2 + 0.125 AS high,
 value / 4 AS low, value / 3 AS close, CAST(value * 100 AS DOUBLE) AS volume
FROM {events}
"""

# Silver-like attributes: customers through all their orders, and parts, which the dimension lacks.
LISTINGS = """
SELECT concat('C', CAST(o_custkey AS STRING)) AS symbol,
 concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T00:00:00Z') AS timestamp,
 'USD' AS currency, o_orderstatus AS source
FROM {orders}
UNION ALL
SELECT concat('P', CAST(p_partkey AS STRING)), '2001-01-01T00:00:00Z', 'USD', p_brand FROM {part}
"""

LISTING_NAMES = """
SELECT concat('C', CAST(c_custkey AS STRING)) AS symbol,
 CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_name END AS company_name
FROM {customer}
"""

# The dimension before the merge: customers (one closed and one open version) and suppliers, which
# have left. Some names are missing on both sides, some only before or only after.
EXISTING = """
SELECT CAST(c_custkey + 1 AS INT) AS ticker_key, concat('C', CAST(c_custkey AS STRING)) AS symbol,
 CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS company_name, 'USD' AS currency, 'F' AS source,
 DATE '2024-01-01' AS effective_from, DATE '9999-12-31' AS effective_to, true AS is_current
FROM {customer}
UNION ALL
SELECT CAST(c_custkey + 1000001 AS INT), concat('C', CAST(c_custkey AS STRING)), 'before', 'USD', 'P',
 DATE '2023-01-01', DATE '2024-01-01', false
FROM {customer}
UNION ALL
SELECT CAST(s_suppkey + 2000001 AS INT), s_name, s_name, 'USD', 'O', DATE '2024-01-01', DATE '9999-12-31', true
FROM {supplier}
"""

# Two counters per event type, which fall back to zero again and again.
SAMPLES = """
SELECT 'fetch_count' AS metric, event_type AS symbol, ts, event_id, CAST(event_id % 1000 AS DOUBLE) AS value
FROM {events}
UNION ALL
SELECT 'fetch_sum', event_type, ts, event_id, CAST(event_id % 700 AS DOUBLE) / 4 FROM {events}
"""

# One log message per line of an order: parts as symbols, a fifth of all rows one hot symbol, every field of
# the contract, and every kind of defect. The feed of a part changes from year to year, for some also the currency.
WIDE_QUOTES = """
SELECT (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey AS kafka_offset, CAST(l_suppkey % 4 AS INT) AS kafka_partition,
 (l_orderkey + l_linenumber) % 3 AS arrival,
 CASE WHEN d = 17 THEN NULL WHEN l_orderkey % 5 = 0 THEN 'HOT' ELSE concat('P', CAST(l_partkey AS STRING)) END AS symbol,
 CASE WHEN d = 23 THEN NULL ELSE concat(day, 'T', CAST(10 + l_linenumber % 3 AS STRING), ':00:00Z') END AS timestamp,
 price AS open, CASE WHEN d = 11 THEN price - 2 ELSE price + 0.25 * (l_linenumber % 4) END AS high,
 CASE WHEN d = 31 THEN price + 6 ELSE price - 0.25 * (l_orderkey % 3) END AS low,
 CASE WHEN d = 7 THEN -1.0 ELSE price END AS close,
 CASE WHEN d = 13 THEN -5 WHEN d = 29 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS volume,
 CASE WHEN (year + l_partkey) % 4 = 0 THEN 'feed_b' ELSE 'feed_a' END AS source, '1h' AS interval,
 CASE WHEN l_partkey % 7 = 0 AND year >= 1998 THEN 'EUR' ELSE 'USD' END AS currency,
 concat(day, 'T23:00:0', CAST(l_linenumber AS STRING), 'Z') AS ingested_at,
 CASE WHEN d = 19 THEN 'not json' WHEN d = 37 THEN 'tombstone' ELSE 'json' END AS form
FROM (SELECT *, CAST(CAST(l_shipdate AS DATE) AS STRING) AS day, year(l_shipdate) AS year,
       CAST(floor(l_extendedprice / l_quantity) AS DOUBLE) AS price, (l_orderkey * 8 + l_linenumber + l_partkey) % 97 AS d
      FROM {lineitem}) l
"""

WIDE_NAMES = """
SELECT concat('P', CAST(p_partkey AS STRING)) AS symbol, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_name END AS company_name
FROM {part}
"""

# Bars by supplier, a third of them of one hot symbol.
HOT_BARS = """
SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'HOT' ELSE concat('S', CAST(l_suppkey AS STRING)) END AS symbol,
 CAST(CAST(l_shipdate AS DATE) AS STRING) AS date,
 CAST(floor(l_extendedprice / l_quantity) + 1 AS DOUBLE) AS high,
 CAST(floor(l_extendedprice / l_quantity) - 1 AS DOUBLE) AS low,
 CAST(floor(l_extendedprice / l_quantity) AS DOUBLE) AS close, CAST(l_quantity AS BIGINT) AS volume
FROM {lineitem}
"""

# Attributes seen day by day, for the symbols of the bars above: the hot one changes on most days.
OBSERVED = """
SELECT symbol, date, CASE WHEN symbol LIKE '%7' THEN NULL ELSE concat('Company ', symbol) END AS company_name, currency, source
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY o_orderkey DESC) AS rn
      FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'HOT' ELSE concat('S', CAST(o_custkey % 150 AS STRING)) END AS symbol,
             CAST(o_orderdate AS DATE) AS date, o_orderpriority AS currency, o_orderstatus AS source, o_orderkey
            FROM {orders}) o) d
WHERE rn = 1
"""

# What yearly loads see of customers: their last order of the year, so not all of them every time.
LOADED = """
SELECT symbol, date, company_name, currency, source
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM (SELECT concat('C', CAST(o_custkey AS STRING)) AS symbol, make_date(CAST(year(o_orderdate) + 1 AS INT), 1, 1) AS date,
             CAST(NULL AS STRING) AS company_name, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 'USD' END AS currency,
             o_orderstatus AS source, o_orderdate, o_orderkey
            FROM {orders}) o) d
WHERE rn = 1
"""

# Records of four log partitions, some lost and some stored twice, across the ends of any chunk.
STORED_OFFSETS = """
SELECT CAST(event_id % 4 AS INT) AS kafka_partition, CAST(floor(event_id / 4) AS BIGINT) AS kafka_offset, event_type
FROM {events} WHERE floor(event_id / 4) % 1000 NOT BETWEEN 505 AND 519 AND floor(event_id / 4) % 333 <> 5
UNION ALL
SELECT CAST(event_id % 4 AS INT), CAST(floor(event_id / 4) AS BIGINT), event_type
FROM {events} WHERE floor(event_id / 4) % 500 BETWEEN 20 AND 30 OR floor(event_id / 4) BETWEEN 1010 AND 1040
"""

# Bars of suppliers that came in seven loads.
LOADED_BARS = """
SELECT concat('P', CAST(l_suppkey AS STRING)) AS symbol, CAST(CAST(l_shipdate AS DATE) AS STRING) AS date,
 CAST(floor(l_extendedprice / l_quantity) + 1 AS DOUBLE) AS high,
 CAST(floor(l_extendedprice / l_quantity) - 1 AS DOUBLE) AS low,
 CAST(floor(l_extendedprice / l_quantity) AS DOUBLE) AS close, CAST(l_quantity AS BIGINT) AS volume,
 l_linenumber AS load
FROM {lineitem}
"""

TABLES = ("customer", "events", "lineitem", "orders", "part", "supplier")


def derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run a template over the Parquet tables of ``sf_dir``."""
    names = [t for t in TABLES if f"{{{t}}}" in text]
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in names})


def event_log(spark: SparkSession, sf_dir: str, text: str = QUOTES) -> DataFrame:
    """Quotes as log messages, with the time at which each one arrived."""
    quotes = derive(spark, sf_dir, text)
    fields = [name for name in EVENT if name in quotes.columns]
    payload = (
        F.when(F.col("form") == "not json", "not json")
        .when(F.col("form") == "json", F.to_json(F.struct(*fields)))
        .cast("binary")
    )
    return quotes.select(
        F.col("symbol").cast("binary").alias("key"),
        payload.alias("value"),
        F.lit("stock-prices").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.timestamp_seconds(F.lit(ARRIVAL_EPOCH)).alias("timestamp"),
        _arrived().alias("arrived"),
    )


def _arrived() -> Column:
    return F.timestamp_seconds(F.lit(ARRIVAL_EPOCH) + F.col("arrival"))


def checked(spark: SparkSession, sf_dir: str, text: str = QUOTES) -> DataFrame:
    return validate(to_envelope(event_log(spark, sf_dir, text), F.col("arrived")))


def silver(spark: SparkSession, sf_dir: str, text: str = QUOTES) -> DataFrame:
    """Silver with all columns. The fields follow from the payload, so the dedup carries the payload alone."""
    log = to_envelope(event_log(spark, sf_dir, text), F.col("arrived"))
    return with_date(with_fields(clean(split_valid(validate(log)), log.columns)))


def silver_bars(spark: SparkSession, sf_dir: str, *columns: str, text: str = QUOTES) -> DataFrame:
    """Some columns of silver, ``timestamp`` among them, and the date."""
    return with_date(clean(split_valid(checked(spark, sf_dir, text)), columns))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_daily(silver(spark, sf_dir), derive(spark, sf_dir, VERSIONS))


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The star tables. Silver feeds two of them, so it is stored first, as the batch job does."""
    ensure_checkpoint_dir(spark)
    rows = silver_bars(spark, sf_dir, "symbol", "timestamp", "high", "low", "close", "volume")
    rows, versions = rows.checkpoint(), derive(spark, sf_dir, VERSIONS)
    return Star(fact_daily(rows, versions), versions, dim_date(rows))


FIRST_LOAD, SECOND_LOAD = "2024-01-08", "2024-01-20"


#: What a star with its own dimension needs of silver.
STAR_COLUMNS = ("symbol", "timestamp", "high", "low", "close", "volume", "currency", "source")


def derived_star(spark: SparkSession, sf_dir: str) -> Star:
    """The star whose ticker dimension comes from the same silver as the fact, loaded on two days: the
    first load sees events up to the middle of January, the second one all of them."""
    ensure_checkpoint_dir(spark)
    rows = silver_bars(spark, sf_dir, *STAR_COLUMNS).checkpoint()
    names = derive(spark, sf_dir, SYMBOL_NAMES)
    early = current_attrs(rows.where("date < '2024-01-16'"), names).checkpoint()
    first = scd2.initial(early, FIRST_LOAD).checkpoint()
    versions = scd2.merge(first, current_attrs(rows, names).checkpoint(), SECOND_LOAD).checkpoint()
    return Star(fact_daily(rows, versions), versions, dim_date(rows))


#: What the loads of the wide star see (events before a day; None: all), and their run dates.
WIDE_LOADS = (("1997-01-01", "1997-01-02"), ("1999-07-01", "1999-07-02"), (None, "2000-06-01"))


def first_load() -> Column:
    """Place in ``WIDE_LOADS`` of the first load that sees a row; the last one sees all."""
    loads = [F.when(F.col("date") < before, i) for i, (before, _) in enumerate(WIDE_LOADS[:-1])]
    return F.coalesce(*loads, F.lit(len(WIDE_LOADS) - 1))


def wide_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir, WIDE_QUOTES)


def wide_star(spark: SparkSession, sf_dir: str) -> Star:
    """The star of all order lines, with a dimension of all parts that three loads of the same silver leave.

    Each load sees what the one before saw and more. What they see is aggregated in one pass, by the first load
    that sees it."""
    rows = store(silver_bars(spark, sf_dir, *STAR_COLUMNS, text=WIDE_QUOTES))
    seen = store(seen_attrs(rows.withColumn("_load", first_load()), "_load"))
    names, versions = derive(spark, sf_dir, WIDE_NAMES), None
    for i, (_, day) in enumerate(WIDE_LOADS):
        attrs = store(latest_attrs(seen.where(F.col("_load") <= i), names))
        versions = store(scd2.initial(attrs, day) if versions is None else scd2.merge(versions, attrs, day))
    return Star(fact_daily(rows, versions), versions, dim_date(rows))


def out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension after yearly loads that come in any order: the middle first, the last before the others."""
    loads = store(derive(spark, sf_dir, LOADED))
    days = sorted(r["date"] for r in loads.select("date").distinct().collect())  # a handful of days
    order = [days[len(days) // 2], days[-1], *days[:len(days) // 2], *days[len(days) // 2 + 1:-1]]
    dimension, done = None, []
    for day in order:
        incoming = loads.where(F.col("date") == F.lit(day)).drop("date")
        log = loads.where(F.col("date").isin(done)).select("symbol", F.col("date").alias("load_date"))
        dimension = store(
            scd2.initial(incoming, str(day)) if dimension is None else scd2.merge_late(dimension, incoming, log, str(day))
        )
        done.append(day)
    return dimension

"""Registered queries and the SQL that checks them."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from barlake import fixtures as fx
from barlake.operators import bars, counters, scd2
from barlake.operators.calendar import dim_date
from barlake.operators.counts import layer_counts
from barlake.operators.facts import as_of_carry, daily_ohlcv, fact_daily
from barlake.operators.offsets import offset_gaps
from barlake.operators.partials import daily_partials, fold
from barlake.operators.replay import accepted
from barlake.operators.surrogate import dense_ids
from barlake.operators.tickers import current_attrs, incoming_attrs
from barlake.operators.validation import reason_counts, split_quarantine, split_valid
from barlake.plans import analytics
from barlake.schemas import EVENT
from barlake.session import ensure_checkpoint_dir

try:
    from barlake.llm import queries as llm
except ModuleNotFoundError as missing:  # only if that subpackage is not there
    if not str(missing.name).startswith("barlake.llm"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

ENVELOPE_COLUMNS = (
    "raw_payload", "kafka_key", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "bronze_ingested_at",
)
PRICES = ("open", "high", "low", "close", "volume")
ALL_COLUMNS = (*ENVELOPE_COLUMNS, *EVENT)
ALL_TIMES = ("kafka_timestamp", "bronze_ingested_at")
EVENT_COLUMNS = ("kafka_partition", "kafka_offset", "symbol", "timestamp", *PRICES, "currency", "source")


def _text(frame: DataFrame, *columns: str) -> DataFrame:
    """Dates and times as text, so both engines are compared on the same type."""
    return frame.withColumns({c: F.col(c).cast("string") for c in columns})


def _bronze_validate(spark: SparkSession, sf: str) -> DataFrame:
    return fx.checked(spark, sf).select(*EVENT_COLUMNS, "error_reason")


def _bronze_valid(spark: SparkSession, sf: str) -> DataFrame:
    return split_valid(fx.checked(spark, sf)).select(*EVENT_COLUMNS, "date")


def _bronze_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return split_quarantine(fx.checked(spark, sf)).select(*EVENT_COLUMNS, "error_reason", "date")


def _quarantine_reason_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reason_counts(split_quarantine(fx.checked(spark, sf)))


def _silver_clean(spark: SparkSession, sf: str) -> DataFrame:
    return fx.silver(spark, sf).select(*EVENT_COLUMNS, "date")


def _dim_date(spark: SparkSession, sf: str) -> DataFrame:
    return _text(dim_date(fx.silver(spark, sf)), "full_date")


def _fact_daily(spark: SparkSession, sf: str) -> DataFrame:
    return fx.fact(spark, sf)


def _daily_ohlcv(spark: SparkSession, sf: str) -> DataFrame:
    return _text(daily_ohlcv(fx.derive(spark, sf, fx.SUPPLIER_BARS)), "date")


def _listings(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return fx.derive(spark, sf, fx.LISTINGS), fx.derive(spark, sf, fx.LISTING_NAMES)


def _incoming_attrs(spark: SparkSession, sf: str) -> DataFrame:
    return incoming_attrs(*_listings(spark, sf))


def _current_attrs(spark: SparkSession, sf: str) -> DataFrame:
    return current_attrs(*_listings(spark, sf))


def _scd2_initial(spark: SparkSession, sf: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    dim = scd2.initial(current_attrs(*_listings(spark, sf)).checkpoint(), fx.RUN_DATE)
    return _text(dim, "effective_from", "effective_to")


def _scd2_merge(spark: SparkSession, sf: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    attrs = current_attrs(*_listings(spark, sf)).checkpoint()
    dim = scd2.merge(fx.derive(spark, sf, fx.EXISTING), attrs, fx.RUN_DATE)
    return _text(dim, "effective_from", "effective_to")


def _scd2_violations(spark: SparkSession, sf: str) -> DataFrame:
    """What a first load on top of an existing dimension would break."""
    reloaded = scd2.initial(current_attrs(*_listings(spark, sf)), fx.RUN_DATE)
    return scd2.violations(fx.derive(spark, sf, fx.EXISTING).unionByName(reloaded))


def _surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    names = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_name").alias("symbol"))
    return dense_ids(names, "symbol", "ticker_key", start=1000)


def _analytics(name: str, *dates: str) -> Query:
    return lambda spark, sf: _text(fx.star(spark, sf).run(name), *dates)


def _top_avg_close(spark: SparkSession, sf: str) -> DataFrame:
    versions = fx.derive(spark, sf, fx.VERSIONS)
    return analytics.run("top_avg_close", fact=fx.fact(spark, sf), ticker=versions)


def _current_directory(spark: SparkSession, sf: str) -> DataFrame:
    versions = fx.derive(spark, sf, fx.VERSIONS)
    return _text(analytics.run("current_directory", ticker=versions), "effective_from")


def _latest_bar(spark: SparkSession, sf: str) -> DataFrame:
    return _text(bars.latest_bar(fx.derive(spark, sf, fx.USER_BARS)), "ts")


def _shaped(spark: SparkSession, sf: str) -> DataFrame:
    fetched = F.timestamp_seconds(F.lit(fx.ARRIVAL_EPOCH))
    rows = fx.derive(spark, sf, fx.USER_BARS)
    return bars.shape_contract(rows, zone="-05:00", ingested_at=fetched)


def _to_event_json(spark: SparkSession, sf: str) -> DataFrame:
    return bars.to_event_json(_shaped(spark, sf))


def _samples(spark: SparkSession, sf: str) -> DataFrame:
    return fx.derive(spark, sf, fx.SAMPLES)


def _counter_rate(spark: SparkSession, sf: str) -> DataFrame:
    rated = counters.counter_rate(_samples(spark, sf), ["metric", "symbol"], 3600, tie="event_id")
    return rated.select("metric", "symbol", "event_id", "rate")


def _counter_increases(spark: SparkSession, sf: str) -> DataFrame:
    deltas = counters.increases(_samples(spark, sf), ["metric", "symbol"], tie="event_id")
    return deltas.select("metric", "symbol", "event_id", "delta")


def _avg_latency_5m(spark: SparkSession, sf: str) -> DataFrame:
    latency = counters.average_latency(
        _samples(spark, sf), "fetch_sum", "fetch_count", tie="event_id"
    )
    return _text(latency, "window_start")


def _avg_latency_sliding(spark: SparkSession, sf: str) -> DataFrame:
    latency = counters.average_latency(
        _samples(spark, sf), "fetch_sum", "fetch_count", step="1 minute", tie="event_id"
    )
    return _text(latency, "window_start")


def _records_rate(spark: SparkSession, sf: str) -> DataFrame:
    sent = _samples(spark, sf).where("metric = 'fetch_count'")
    return _text(counters.records_rate(sent, tie="event_id"), "window_start")


def _missing_bars(spark: SparkSession, sf: str) -> DataFrame:
    return bars.missing_bars(fx.silver(spark, sf), step_seconds=3_600)


def _star_from_events(spark: SparkSession, sf: str) -> DataFrame:
    return _text(fx.derived_star(spark, sf).run("daily_summary"), "full_date")


def _derived_versions(spark: SparkSession, sf: str) -> DataFrame:
    return _text(fx.derived_star(spark, sf).ticker, "effective_from", "effective_to")


def _wide_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return _text(split_valid(fx.checked(spark, sf, fx.WIDE_QUOTES)).select(*ALL_COLUMNS, "date"), *ALL_TIMES)


def _wide_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    rejected = split_quarantine(fx.checked(spark, sf, fx.WIDE_QUOTES))
    return _text(rejected.select(*ALL_COLUMNS, "error_reason", "date"), *ALL_TIMES)


def _wide_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _text(fx.wide_silver(spark, sf).select(*ALL_COLUMNS, "date"), *ALL_TIMES)


def _wide_versions(spark: SparkSession, sf: str) -> DataFrame:
    return _text(fx.wide_star(spark, sf).ticker, "effective_from", "effective_to")


def _wide_fact(spark: SparkSession, sf: str) -> DataFrame:
    return fx.wide_star(spark, sf).fact


def _wide(name: str, *dates: str) -> Query:
    return lambda spark, sf: _text(fx.wide_star(spark, sf).run(name), *dates)


def _history(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.history(fx.derive(spark, sf, fx.OBSERVED))


def _scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    return _text(_history(spark, sf), "effective_from", "effective_to")


def _scd2_out_of_order(spark: SparkSession, sf: str) -> DataFrame:
    return _text(fx.out_of_order(spark, sf).drop("ticker_key"), "effective_from", "effective_to")


def _fact_as_of_carry(spark: SparkSession, sf: str) -> DataFrame:
    return fact_daily(fx.derive(spark, sf, fx.HOT_BARS), _history(spark, sf), as_of_carry)


def _offset_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze and quarantine together, in chunks of 512 offsets."""
    stored = fx.derive(spark, sf, fx.STORED_OFFSETS)
    bronze, quarantine = stored.where("event_type <> 'error'"), stored.where("event_type = 'error'")
    return offset_gaps(bronze.unionByName(quarantine), chunk=512)


def _daily_from_partials(spark: SparkSession, sf: str) -> DataFrame:
    return _text(fold(daily_partials(fx.derive(spark, sf, fx.LOADED_BARS))), "date")


def _replayed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """What rules that allow any volume and unequal prices accept of the quarantine."""
    def newer(broken: Column) -> Column:
        return F.concat_ws(",", F.when(broken | F.col("symbol").isNull() | F.col("timestamp").isNull(), "unusable"),
                           F.when(F.expr("close <= 0"), "close<=0"))

    rejected = split_quarantine(fx.checked(spark, sf, fx.WIDE_QUOTES))
    return _text(accepted(rejected, newer).select(*ALL_COLUMNS, "date"), *ALL_TIMES)


def _totals_or_zero(spark: SparkSession, sf: str) -> DataFrame:
    return counters.totals_or_zero(
        _samples(spark, sf), ["fetch_count", "fetch_failures"], tie="event_id"
    )


def _records_per_minute(spark: SparkSession, sf: str) -> DataFrame:
    events = spark.read.parquet(f"{sf}/events.parquet")
    sent = events.select(F.col("event_type").alias("symbol"), "ts")
    return _text(counters.records_per_minute(sent), "minute")


def _counted_per_minute(spark: SparkSession, sf: str) -> DataFrame:
    sent = _samples(spark, sf).where("metric = 'fetch_count'")
    return _text(counters.counted_per_minute(sent, tie="event_id"), "minute")


def _layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    return layer_counts(fx.checked(spark, sf))


def entry(spark: SparkSession) -> DataFrame:
    """Volume per weekday, from raw events through every layer."""
    return fx.star(spark, "/root/testdata/sf0.001").run("volume_by_dow")


def queries() -> dict[str, Query]:
    return {**own_queries(), **(llm.queries() if llm else {})}


def oracle_sql() -> dict[str, str]:
    return {**own_sql(), **(llm.SQL if llm else {})}


def own_queries() -> dict[str, Query]:
    """Queries of the bar pipeline, each with its SQL in ``own_sql``."""
    return {
        "bronze_validate": _bronze_validate,
        "bronze_valid": _bronze_valid,
        "bronze_quarantine": _bronze_quarantine,
        "quarantine_reason_counts": _quarantine_reason_counts,
        "silver_clean": _silver_clean,
        "dim_date": _dim_date,
        "incoming_attrs": _incoming_attrs,
        "current_attrs": _current_attrs,
        "surrogate_keys": _surrogate_keys,
        "scd2_initial": _scd2_initial,
        "scd2_merge": _scd2_merge,
        "scd2_violations": _scd2_violations,
        "daily_ohlcv": _daily_ohlcv,
        "fact_daily": _fact_daily,
        "star_from_events": _star_from_events,
        "derived_versions": _derived_versions,
        "q_daily_summary": _analytics("daily_summary", "full_date"),
        "q_top_avg_close": _top_avg_close,
        "q_volume_by_dow": _analytics("volume_by_dow"),
        "q_price_range": _analytics("price_range", "full_date"),
        "q_current_directory": _current_directory,
        "wide_bronze": _wide_bronze,
        "wide_quarantine": _wide_quarantine,
        "wide_silver": _wide_silver,
        "wide_versions": _wide_versions,
        "wide_fact": _wide_fact,
        "wide_daily_summary": _wide("daily_summary", "full_date"),
        "wide_top_avg_close": _wide("top_avg_close"),
        "wide_volume_by_dow": _wide("volume_by_dow"),
        "wide_price_range": _wide("price_range", "full_date"),
        "scd2_history": _scd2_history,
        "scd2_out_of_order": _scd2_out_of_order,
        "fact_as_of_carry": _fact_as_of_carry,
        "offset_gaps": _offset_gaps,
        "daily_from_partials": _daily_from_partials,
        "replayed_rows": _replayed_rows,
        "latest_bar": _latest_bar,
        "shape_contract": _shaped,
        "to_event_json": _to_event_json,
        "records_per_minute": _records_per_minute,
        "counted_per_minute": _counted_per_minute,
        "counter_increases": _counter_increases,
        "counter_rate": _counter_rate,
        "avg_latency_5m": _avg_latency_5m,
        "avg_latency_sliding": _avg_latency_sliding,
        "records_rate_1m": _records_rate,
        "missing_bars": _missing_bars,
        "totals_or_zero": _totals_or_zero,
        "layer_counts": _layer_counts,
    }


# Checking SQL ---------------------------------------------------------------------------------

def _parsed(columns: tuple[str, ...]) -> str:
    return ", ".join(f"CASE WHEN form = 'json' THEN {c} END AS {c}" for c in columns)


_REASON = """CASE WHEN form <> 'json' THEN 'malformed_json' ELSE concat_ws(',',
          CASE WHEN symbol IS NULL THEN 'missing_symbol' END,
          CASE WHEN timestamp IS NULL THEN 'missing_timestamp' END,
          CASE WHEN volume IS NULL THEN 'invalid_numeric' END,
          CASE WHEN close <= 0 THEN 'close<=0' END, CASE WHEN volume < 0 THEN 'volume<0' END,
          CASE WHEN high < low THEN 'high<low' END, CASE WHEN high < open THEN 'high<open' END,
          CASE WHEN high < close THEN 'high<close' END, CASE WHEN low > open THEN 'low>open' END,
          CASE WHEN low > close THEN 'low>close' END) END AS error_reason"""


def _json_member(name: str) -> str:
    text = EVENT[name] == "string"
    return f"""'"{name}":{'"' if text else ''}' || {name} || '{'"' if text else ''}'"""


def _silver_sql(checked: str) -> str:
    return f"""
        SELECT * EXCLUDE (rn), substr(timestamp, 1, 10) AS date
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol, timestamp
               ORDER BY arrival DESC, kafka_offset DESC, kafka_partition DESC) AS rn
              FROM {checked} WHERE error_reason = '') v
        WHERE rn = 1 AND close > 0"""


def _fact_sql(silver: str, versions: str) -> str:
    return f"""
        SELECT CAST(replace(f.date, '-', '') AS INT) AS date_key, v.ticker_key, day_high, day_low,
         avg_close, total_volume
        FROM (SELECT symbol, date, max(high) AS day_high, min(low) AS day_low, avg(close) AS avg_close,
               CAST(sum(volume) AS BIGINT) AS total_volume FROM {silver} GROUP BY symbol, date) f
        LEFT JOIN {versions} v ON f.symbol = v.symbol
         AND CAST(f.date AS DATE) >= v.effective_from AND CAST(f.date AS DATE) < v.effective_to"""


def _calendar_sql(silver: str) -> str:
    return f"""
        SELECT CAST(replace(date, '-', '') AS INT) AS date_key, date AS full_date,
         CAST(year(CAST(date AS DATE)) AS INT) AS year, CAST(month(CAST(date AS DATE)) AS INT) AS month,
         CAST(day(CAST(date AS DATE)) AS INT) AS day, dayname(CAST(date AS DATE)) AS day_of_week,
         dayname(CAST(date AS DATE)) IN ('Saturday', 'Sunday') AS is_weekend
        FROM (SELECT DISTINCT date FROM {silver}) d"""


def _history_sql(observed: str) -> str:
    """Versions of attributes seen on some days: gaps and islands."""
    return f"""
        SELECT CAST(row_number() OVER (ORDER BY date, symbol) AS INT) AS ticker_key, symbol, company_name, currency, source,
         date AS effective_from, coalesce(lead(date) OVER along, DATE '9999-12-31') AS effective_to,
         lead(date) OVER along IS NULL AS is_current
        FROM (SELECT *, row_number() OVER before = 1 OR company_name IS DISTINCT FROM lag(company_name) OVER before
               OR currency IS DISTINCT FROM lag(currency) OVER before OR source IS DISTINCT FROM lag(source) OVER before AS begins
              FROM {observed} WINDOW before AS (PARTITION BY symbol ORDER BY date)) o
        WHERE begins WINDOW along AS (PARTITION BY symbol ORDER BY date)"""


_STAR_SQL = {
    "daily_summary": """SELECT v.symbol, v.company_name, c.full_date, f.day_high, f.day_low, f.avg_close, f.total_volume
            FROM {fact} f JOIN {versions} v ON f.ticker_key = v.ticker_key
            JOIN {calendar} c ON f.date_key = c.date_key ORDER BY v.symbol, c.full_date""",
    "top_avg_close": """SELECT v.company_name, f.avg_close FROM {fact} f JOIN {versions} v ON f.ticker_key = v.ticker_key
            ORDER BY f.avg_close DESC NULLS FIRST, v.company_name NULLS LAST, f.date_key LIMIT 1""",
    "volume_by_dow": """SELECT c.day_of_week, CAST(sum(f.total_volume) AS BIGINT) AS total_volume
            FROM {fact} f JOIN {calendar} c ON f.date_key = c.date_key
            GROUP BY c.day_of_week ORDER BY total_volume DESC""",
    "price_range": """SELECT v.symbol, c.full_date, f.day_high - f.day_low AS price_range
            FROM {fact} f JOIN {versions} v ON f.ticker_key = v.ticker_key
            JOIN {calendar} c ON f.date_key = c.date_key ORDER BY price_range DESC""",
}
_WIDE = {"fact": "wide_fact", "versions": "wide_versions", "calendar": "wide_calendar"}


_VIEWS = {
    **{
        name: getattr(fx, name.upper()).format(**{t: t for t in fx.TABLES})
        for name in (
            "quotes", "versions", "supplier_bars", "user_bars", "listings", "listing_names",
            "existing", "samples", "symbol_names", "wide_quotes", "wide_names", "hot_bars", "observed", "loaded",
            "stored_offsets", "loaded_bars",
        )
    },
    "checked": f"""
        SELECT kafka_partition, kafka_offset, arrival, {_parsed(("symbol", "timestamp", *PRICES, "currency", "source"))}, {_REASON}
        FROM quotes""",
    "silver": _silver_sql("checked"),
    "fact": _fact_sql("silver", "versions"),
    "wide_checked": f"""
        SELECT arrival, CASE form WHEN 'json' THEN concat('{{', concat_ws(',', {", ".join(map(_json_member, EVENT))}), '}}')
          WHEN 'not json' THEN form END AS raw_payload,
         symbol AS kafka_key, 'stock-prices' AS kafka_topic, kafka_partition, kafka_offset,
         '2024-02-01 12:00:00' AS kafka_timestamp,
         CAST(TIMESTAMP '2024-02-01 12:00:00' + to_seconds(arrival) AS VARCHAR) AS bronze_ingested_at,
         {_parsed(tuple(EVENT))}, {_REASON}
        FROM wide_quotes""",
    "wide_silver": _silver_sql("wide_checked"),
    "wide_loaded": " UNION ALL ".join(f"""
        SELECT symbol, DATE '{day}' AS date, company_name, currency, source
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC, currency DESC, source DESC) AS rn
              FROM wide_silver WHERE {'true' if before is None else f"date < '{before}'"}) s
        LEFT JOIN wide_names USING (symbol) WHERE rn = 1""" for before, day in fx.WIDE_LOADS),
    "wide_versions": _history_sql("wide_loaded"),
    "wide_fact": _fact_sql("wide_silver", "wide_versions"),
    "wide_calendar": _calendar_sql("wide_silver"),
    "history": _history_sql("observed"),
    "loaded_history": _history_sql("loaded"),
    "hot_fact": _fact_sql("hot_bars", "history"),
    "early_attrs": """
        SELECT symbol, company_name, currency, source
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC, currency DESC, source DESC) AS rn
              FROM silver WHERE date < '2024-01-16') s
        LEFT JOIN symbol_names USING (symbol) WHERE rn = 1""",
    "late_attrs": """
        SELECT symbol, company_name, currency, source
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC, currency DESC, source DESC) AS rn
              FROM silver) s
        LEFT JOIN symbol_names USING (symbol) WHERE rn = 1""",
    "derived": f"""
        SELECT CAST(row_number() OVER (ORDER BY e.symbol) AS INT) AS ticker_key, e.symbol, e.company_name, e.currency,
         e.source, DATE '{fx.FIRST_LOAD}' AS effective_from, CASE WHEN l.source = e.source AND l.currency = e.currency
          THEN DATE '9999-12-31' ELSE DATE '{fx.SECOND_LOAD}' END AS effective_to,
         l.source = e.source AND l.currency = e.currency AS is_current
        FROM early_attrs e JOIN late_attrs l ON e.symbol = l.symbol
        UNION ALL
        SELECT CAST(row_number() OVER (ORDER BY l.symbol) + (SELECT count(*) FROM early_attrs) AS INT), l.symbol,
         l.company_name, l.currency, l.source, DATE '{fx.SECOND_LOAD}', DATE '9999-12-31', true
        FROM late_attrs l LEFT JOIN early_attrs e ON e.symbol = l.symbol
        WHERE e.symbol IS NULL OR l.source <> e.source OR l.currency <> e.currency""",
    "calendar": _calendar_sql("silver"),
    "attrs": """
        SELECT symbol, company_name, currency, source
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol
               ORDER BY timestamp DESC, currency DESC, source DESC) AS rn FROM listings) l
        LEFT JOIN listing_names USING (symbol) WHERE rn = 1""",
    "affected": """
        SELECT a.* FROM attrs a LEFT JOIN (SELECT * FROM existing WHERE is_current) c ON a.symbol = c.symbol
        WHERE c.symbol IS NULL OR a.company_name IS DISTINCT FROM c.company_name
         OR a.currency IS DISTINCT FROM c.currency OR a.source IS DISTINCT FROM c.source""",
    "merged": f"""
        SELECT ticker_key, symbol, company_name, currency, source, effective_from,
         CASE WHEN is_current AND symbol IN (SELECT symbol FROM affected) THEN DATE '{fx.RUN_DATE}'
          ELSE effective_to END AS effective_to,
         is_current AND symbol NOT IN (SELECT symbol FROM affected) AS is_current
        FROM existing
        UNION ALL
        SELECT CAST(row_number() OVER (ORDER BY symbol) + (SELECT max(ticker_key) FROM existing) AS INT),
         symbol, company_name, currency, source, DATE '{fx.RUN_DATE}', DATE '9999-12-31', true
        FROM affected""",
    "deltas": """
        SELECT *, CASE WHEN before IS NULL THEN 0.0 WHEN value < before THEN value
         ELSE value - before END AS delta
        FROM (SELECT *, lag(value) OVER (PARTITION BY metric, symbol ORDER BY ts, event_id) AS before
              FROM samples) s""",
    "shaped": """
        SELECT symbol, strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
         CAST(format('{:.2f}', open) AS DOUBLE) AS open, CAST(format('{:.2f}', high) AS DOUBLE) AS high,
         CAST(format('{:.2f}', low) AS DOUBLE) AS low, CAST(format('{:.2f}', close) AS DOUBLE) AS close,
         CAST(trunc(volume) AS BIGINT) AS volume, 'yfinance' AS source, '1m' AS interval,
         'USD' AS currency, '2024-02-01T12:00:00Z' AS ingested_at
        FROM user_bars""",
}
_NEEDS = {
    "checked": ("quotes",),
    "silver": ("checked",),
    "fact": ("silver", "versions"),
    "calendar": ("silver",),
    "wide_checked": ("wide_quotes",),
    "wide_silver": ("wide_checked",),
    "wide_loaded": ("wide_silver", "wide_names"),
    "wide_versions": ("wide_loaded",),
    "wide_fact": ("wide_versions",),
    "wide_calendar": ("wide_silver",),
    "history": ("observed",),
    "loaded_history": ("loaded",),
    "hot_fact": ("hot_bars", "history"),
    "early_attrs": ("silver", "symbol_names"),
    "late_attrs": ("silver", "symbol_names"),
    "derived": ("early_attrs", "late_attrs"),
    "attrs": ("listings", "listing_names"),
    "affected": ("attrs", "existing"),
    "merged": ("affected",),
    "deltas": ("samples",),
    "shaped": ("user_bars",),
}


def _with(final: str, *views: str) -> str:
    """Prefix a statement with the views it needs, in dependency order."""
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, ()):
            add(needed)
        ordered.setdefault(name, _VIEWS[name])

    for view in views:
        add(view)
    return "WITH " + ",\n".join(f"{n} AS ({text})" for n, text in ordered.items()) + f"\n{final}"


def own_sql() -> dict[str, str]:
    event = ", ".join(EVENT_COLUMNS)
    dim = """SELECT ticker_key, symbol, company_name, currency, source,
        CAST(effective_from AS VARCHAR) AS effective_from, CAST(effective_to AS VARCHAR) AS effective_to,
        is_current FROM {}"""
    first_load = f"""SELECT CAST(row_number() OVER (ORDER BY symbol) AS INT) AS ticker_key, symbol,
        company_name, currency, source, '{fx.RUN_DATE}' AS effective_from, '9999-12-31' AS effective_to,
        true AS is_current FROM attrs"""
    return {
        "bronze_validate": _with(f"SELECT {event}, error_reason FROM checked", "checked"),
        "bronze_valid": _with(
            f"SELECT {event}, substr(timestamp, 1, 10) AS date FROM checked WHERE error_reason = ''",
            "checked",
        ),
        "bronze_quarantine": _with(
            f"SELECT {event}, error_reason, '2024-02-01' AS date FROM checked WHERE error_reason <> ''",
            "checked",
        ),
        "quarantine_reason_counts": _with(
            "SELECT error_reason, count(*) AS n FROM checked WHERE error_reason <> '' GROUP BY error_reason",
            "checked",
        ),
        "silver_clean": _with(f"SELECT {event}, date FROM silver", "silver"),
        "dim_date": _with("SELECT * FROM calendar", "calendar"),
        "incoming_attrs": _with(
            """SELECT symbol, company_name, currency, source
            FROM (SELECT DISTINCT symbol, currency, source FROM listings) l
            LEFT JOIN listing_names USING (symbol)""",
            "listings", "listing_names",
        ),
        "current_attrs": _with("SELECT * FROM attrs", "attrs"),
        "surrogate_keys": """SELECT c_name AS symbol,
            CAST(1000 + row_number() OVER (ORDER BY c_name) AS INT) AS ticker_key FROM customer""",
        "scd2_initial": _with(first_load, "attrs"),
        "scd2_merge": _with(dim.format("merged"), "merged"),
        "scd2_violations": _with(
            """SELECT symbol, count(*) FILTER (WHERE is_current) AS current_versions,
             count(*) FILTER (WHERE following < effective_to) AS overlapping
            FROM (SELECT *, lead(effective_from) OVER (PARTITION BY symbol
                   ORDER BY effective_from, effective_to) AS following
                  FROM (SELECT symbol, effective_from, effective_to, is_current FROM existing UNION ALL
                        SELECT symbol, DATE '2024-02-01', DATE '9999-12-31', true FROM attrs) d) v
            GROUP BY symbol HAVING current_versions > 1 OR overlapping > 0""",
            "attrs", "existing",
        ),
        "daily_ohlcv": _with(
            """SELECT symbol, date, max(high) AS day_high, min(low) AS day_low, avg(close) AS avg_close,
            CAST(sum(volume) AS BIGINT) AS total_volume FROM supplier_bars GROUP BY symbol, date""",
            "supplier_bars",
        ),
        "fact_daily": _with("SELECT * FROM fact", "fact"),
        "q_daily_summary": _with(
            """SELECT v.symbol, v.company_name, c.full_date, f.day_high, f.day_low, f.avg_close, f.total_volume
            FROM fact f JOIN versions v ON f.ticker_key = v.ticker_key
            JOIN calendar c ON f.date_key = c.date_key ORDER BY v.symbol, c.full_date""",
            "fact", "calendar",
        ),
        "star_from_events": _with(
            """SELECT v.symbol, v.company_name, f.date AS full_date, max(f.high) AS day_high, min(f.low) AS day_low,
             avg(f.close) AS avg_close, CAST(sum(f.volume) AS BIGINT) AS total_volume
            FROM silver f JOIN derived v ON f.symbol = v.symbol
             AND CAST(f.date AS DATE) >= v.effective_from AND CAST(f.date AS DATE) < v.effective_to
            GROUP BY v.symbol, v.company_name, f.date""",
            "derived",
        ),
        "derived_versions": _with(dim.format("derived"), "derived"),
        "q_top_avg_close": _with(
            """SELECT v.company_name, f.avg_close FROM fact f JOIN versions v ON f.ticker_key = v.ticker_key
            ORDER BY f.avg_close DESC, v.company_name, f.date_key LIMIT 1""",
            "fact",
        ),
        "q_volume_by_dow": _with(
            """SELECT c.day_of_week, CAST(sum(f.total_volume) AS BIGINT) AS total_volume
            FROM fact f JOIN calendar c ON f.date_key = c.date_key
            GROUP BY c.day_of_week ORDER BY total_volume DESC""",
            "fact", "calendar",
        ),
        "q_price_range": _with(
            """SELECT v.symbol, c.full_date, f.day_high - f.day_low AS price_range
            FROM fact f JOIN versions v ON f.ticker_key = v.ticker_key
            JOIN calendar c ON f.date_key = c.date_key ORDER BY price_range DESC""",
            "fact", "calendar",
        ),
        "wide_bronze": _with(
            f"SELECT {', '.join(ALL_COLUMNS)}, substr(timestamp, 1, 10) AS date FROM wide_checked WHERE error_reason = ''",
            "wide_checked",
        ),
        "wide_quarantine": _with(
            f"SELECT {', '.join(ALL_COLUMNS)}, error_reason, '2024-02-01' AS date FROM wide_checked WHERE error_reason <> ''",
            "wide_checked",
        ),
        "wide_silver": _with(f"SELECT {', '.join(ALL_COLUMNS)}, date FROM wide_silver", "wide_silver"),
        "wide_versions": _with(dim.format("wide_versions"), "wide_versions"),
        "wide_fact": _with("SELECT * FROM wide_fact", "wide_fact"),
        **{
            f"wide_{name}": _with(text.format(**_WIDE), "wide_fact", "wide_calendar") for name, text in _STAR_SQL.items()
        },
        "scd2_history": _with(dim.format("history"), "history"),
        "scd2_out_of_order": _with(dim.format("loaded_history").replace("ticker_key, ", "", 1), "loaded_history"),
        "offset_gaps": _with(
            """SELECT kafka_partition, 'missing' AS kind, kafka_offset + 1 AS first_offset, following - 1 AS last_offset,
             following - kafka_offset - 1 AS n
            FROM (SELECT kafka_partition, kafka_offset, lead(kafka_offset) OVER (PARTITION BY kafka_partition ORDER BY kafka_offset)
                  AS following FROM (SELECT DISTINCT kafka_partition, kafka_offset FROM stored_offsets) d) f
            WHERE following > kafka_offset + 1
            UNION ALL
            SELECT kafka_partition, 'repeated', min(kafka_offset), max(kafka_offset), CAST(sum(n - 1) AS BIGINT)
            FROM (SELECT *, kafka_offset - row_number() OVER (PARTITION BY kafka_partition ORDER BY kafka_offset) AS island
                  FROM (SELECT kafka_partition, kafka_offset, count(*) AS n FROM stored_offsets GROUP BY ALL HAVING n > 1) c) i
            GROUP BY kafka_partition, island""",
            "stored_offsets",
        ),
        "daily_from_partials": _with(
            """SELECT symbol, date, max(high) AS day_high, min(low) AS day_low, avg(close) AS avg_close,
            CAST(sum(volume) AS BIGINT) AS total_volume FROM loaded_bars GROUP BY symbol, date""",
            "loaded_bars",
        ),
        "replayed_rows": _with(
            f"""SELECT {', '.join(ALL_COLUMNS)}, substr(timestamp, 1, 10) AS date FROM wide_checked
            WHERE error_reason <> '' AND error_reason <> 'malformed_json' AND symbol IS NOT NULL AND timestamp IS NOT NULL
             AND (close IS NULL OR close > 0)""",
            "wide_checked",
        ),
        "fact_as_of_carry": _with("SELECT * FROM hot_fact", "hot_fact"),
        "q_current_directory": _with(
            """SELECT symbol, company_name, currency, CAST(effective_from AS VARCHAR) AS effective_from
            FROM versions WHERE is_current ORDER BY symbol""",
            "versions",
        ),
        "latest_bar": _with(
            """SELECT symbol, CAST(ts AS VARCHAR) AS ts, open, high, low, close, volume
            FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS rn FROM user_bars) b
            WHERE rn = 1""",
            "user_bars",
        ),
        "shape_contract": _with("SELECT * FROM shaped", "shaped"),
        "to_event_json": _with(
            """SELECT symbol AS key, concat('{"symbol":"', symbol, '","timestamp":"', timestamp,
            '","open":', open, ',"high":', high, ',"low":', low, ',"close":', close, ',"volume":', volume,
            ',"source":"', source, '","interval":"', interval, '","currency":"', currency,
            '","ingested_at":"', ingested_at, '"}') AS value FROM shaped""",
            "shaped",
        ),
        "records_per_minute": """SELECT CAST(date_trunc('minute', ts) AS VARCHAR) AS minute,
            event_type AS symbol, count(*) AS records FROM events GROUP BY ALL""",
        "counted_per_minute": _with(
            """SELECT CAST(date_trunc('minute', ts) AS VARCHAR) AS minute, symbol, sum(delta) AS records
            FROM deltas WHERE metric = 'fetch_count' GROUP BY ALL""",
            "deltas",
        ),
        "counter_increases": _with("SELECT metric, symbol, event_id, delta FROM deltas", "deltas"),
        "counter_rate": _with(
            """SELECT s.metric, s.symbol, s.event_id, coalesce(sum(d.delta), 0) / 3600 AS rate
            FROM deltas s LEFT JOIN (SELECT metric, symbol, ts, delta, lag(ts) OVER (PARTITION BY metric, symbol
              ORDER BY ts, event_id) AS prior, event_id FROM deltas) d
             ON d.metric = s.metric AND d.symbol = s.symbol AND d.prior >= s.ts - INTERVAL 1 HOUR AND d.ts <= s.ts
            GROUP BY ALL""",
            "deltas",
        ),
        "avg_latency_5m": _with(
            """SELECT CAST(time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') AS VARCHAR) AS window_start,
            sum(CASE WHEN metric = 'fetch_sum' THEN delta END)
             / nullif(sum(CASE WHEN metric = 'fetch_count' THEN delta END), 0) AS avg_latency
            FROM deltas GROUP BY 1""",
            "deltas",
        ),
        "avg_latency_sliding": _with(
            """SELECT CAST(date_trunc('minute', ts) - to_minutes(i) AS VARCHAR) AS window_start,
            sum(CASE WHEN metric = 'fetch_sum' THEN delta END)
             / nullif(sum(CASE WHEN metric = 'fetch_count' THEN delta END), 0) AS avg_latency
            FROM deltas, (SELECT unnest([0, 1, 2, 3, 4]) AS i) steps GROUP BY 1""",
            "deltas",
        ),
        "records_rate_1m": _with(
            """SELECT CAST(time_bucket(INTERVAL 15 SECOND, ts, TIMESTAMP '1970-01-01') - to_seconds(15 * i) AS VARCHAR)
             AS window_start, symbol, sum(delta) AS records_per_minute
            FROM deltas, (SELECT unnest([0, 1, 2, 3]) AS i) steps WHERE metric = 'fetch_count' GROUP BY 1, 2""",
            "deltas",
        ),
        "missing_bars": _with(
            """SELECT symbol, concat(date, 'T', lpad(CAST(unnest(range(hour + 1, following)) AS VARCHAR), 2, '0'), ':00:00Z')
             AS timestamp
            FROM (SELECT *, lead(hour) OVER (PARTITION BY symbol, date ORDER BY hour) AS following
                  FROM (SELECT DISTINCT symbol, date, CAST(substr(timestamp, 12, 2) AS BIGINT) AS hour FROM silver) s) n
            WHERE following > hour + 1""",
            "silver",
        ),
        "totals_or_zero": _with(
            """SELECT m.metric, coalesce(sum(l.value), 0.0) AS total
            FROM (SELECT unnest(['fetch_count', 'fetch_failures']) AS metric) m
            LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY metric, symbol
                        ORDER BY ts DESC, event_id DESC) AS rn FROM samples) l
             ON l.metric = m.metric AND l.rn = 1
            GROUP BY m.metric""",
            "samples",
        ),
        "layer_counts": _with(
            """SELECT 'events' AS layer, count(*) AS n FROM checked
            UNION ALL SELECT 'bronze', count(*) FROM checked WHERE error_reason = ''
            UNION ALL SELECT 'quarantine', count(*) FROM checked WHERE error_reason <> ''
            UNION ALL SELECT 'silver', count(*) FROM silver""",
            "silver",
        ),
    }

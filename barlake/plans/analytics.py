"""Analyst queries over the star schema, as Spark SQL with the three tables as parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

# Sorts end in columns that tell rows apart: a range of the sort can then be cut inside a value that
# many rows share, and the order is always the same.
QUERIES = {
    "daily_summary": """
        SELECT symbol, company_name, full_date, day_high, day_low, avg_close, total_volume
        FROM {fact} JOIN {ticker} USING (ticker_key) JOIN {calendar} USING (date_key)
        ORDER BY symbol ASC NULLS LAST, full_date ASC NULLS LAST
    """,
    "top_avg_close": """
        SELECT company_name, avg_close
        FROM {fact} JOIN {ticker} USING (ticker_key)
        ORDER BY avg_close DESC NULLS FIRST, company_name ASC NULLS LAST, date_key ASC NULLS LAST
        LIMIT 1
    """,
    "volume_by_dow": """
        SELECT day_of_week, sum(total_volume) AS total_volume
        FROM {fact} JOIN {calendar} USING (date_key)
        GROUP BY day_of_week
        ORDER BY total_volume DESC NULLS FIRST, day_of_week ASC NULLS LAST
    """,
    "price_range": """
        SELECT symbol, full_date, day_high - day_low AS price_range
        FROM {fact} JOIN {ticker} USING (ticker_key) JOIN {calendar} USING (date_key)
        ORDER BY price_range DESC NULLS FIRST, symbol ASC NULLS LAST, full_date ASC NULLS LAST
    """,
    "current_directory": """
        SELECT symbol, company_name, currency, effective_from
        FROM {ticker} WHERE is_current
        ORDER BY symbol ASC NULLS LAST
    """,
}


def run(name: str, **tables: DataFrame) -> DataFrame:
    """One of ``QUERIES`` over the tables it names: ``fact``, ``ticker``, ``calendar``.

    NULL order is spelled out as the warehouse database sorts.
    """
    return next(iter(tables.values())).sparkSession.sql(QUERIES[name], **tables)


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    ticker: DataFrame
    calendar: DataFrame

    def run(self, name: str) -> DataFrame:
        named = {t: getattr(self, t) for t in ("fact", "ticker", "calendar")}
        return run(name, **{t: frame for t, frame in named.items() if f"{{{t}}}" in QUERIES[name]})

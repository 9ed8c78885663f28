"""Names, types and constants shared by all layers."""

from __future__ import annotations

# Fixed values of the data contract: column names and types in order. ------------------------
EVENT = {
    "symbol": "string",
    "timestamp": "string",
    "open": "double",
    "high": "double",
    "low": "double",
    "close": "double",
    "volume": "bigint",
    "source": "string",
    "interval": "string",
    "currency": "string",
    "ingested_at": "string",
}
DIM_TICKER = {
    "ticker_key": "int",
    "symbol": "string",
    "company_name": "string",
    "currency": "string",
    "source": "string",
    "effective_from": "date",
    "effective_to": "date",
    "is_current": "boolean",
}
FACT = {
    "date_key": "int",
    "ticker_key": "int",
    "day_high": "double",
    "day_low": "double",
    "avg_close": "double",
    "total_volume": "bigint",
}
OPEN_END = "9999-12-31"
TRACKED = ("company_name", "currency", "source")
NATURAL_KEY = ("symbol", "timestamp")
COMPANY_NAMES = {
    "AAPL": "Apple Inc.",
    "MSFT": "Microsoft Corporation",
    "GOOGL": "Alphabet Inc.",
    "AMZN": "Amazon.com Inc.",
}
BAR_SOURCE = "yfinance"
BAR_INTERVAL = "1m"
BAR_CURRENCY = "USD"
# ---------------------------------------------------------------------------------------------

GOLD_TABLES = ("dim_date", "dim_ticker", "fact_daily_prices")


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())

"""Ticker attributes observed in silver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.schemas import COMPANY_NAMES, TRACKED

Names = Mapping[str, str] | DataFrame


def _named(attrs: DataFrame, names: Names) -> DataFrame:
    if isinstance(names, DataFrame):
        # One row per ticker on the left by now; the optimizer broadcasts names only if its size allows.
        named = attrs.join(names.select("symbol", "company_name"), "symbol", "left")
    else:
        entries = [F.lit(text) for pair in names.items() for text in pair]
        name = F.create_map(*entries)[F.col("symbol")] if entries else F.lit(None).cast("string")
        named = attrs.withColumn("company_name", name)
    return named.select("symbol", *TRACKED)


def incoming_attrs(silver: DataFrame, names: Names = COMPANY_NAMES) -> DataFrame:
    """Every distinct ``(symbol, currency, source)`` with the company name; NULL if unmapped."""
    return _named(silver.select("symbol", "currency", "source").distinct(), names)


def seen_attrs(silver: DataFrame, *by: str) -> DataFrame:
    """``(*by, symbol, currency, source, seen)``: the newest event time, in microseconds, of every pair.

    The big pass: its buffer has a fixed width, so it is a hash aggregate that collapses each map task
    to a handful of rows. Kept ``by`` date, it can be brought up to date one date at a time.
    """
    seen = F.unix_micros(F.col("timestamp").try_cast("timestamp"))
    return silver.groupBy(*by, "symbol", "currency", "source").agg(F.max(seen).alias("seen"))


def latest_attrs(pairs: DataFrame, names: Names = COMPANY_NAMES) -> DataFrame:
    """The latest ``(currency, source)`` per symbol of ``seen_attrs``: exactly one row per symbol."""
    latest = pairs.groupBy("symbol").agg(F.max(F.struct("seen", "currency", "source")).alias("_latest"))
    return _named(latest.select("symbol", "_latest.currency", "_latest.source"), names)


def current_attrs(silver: DataFrame, names: Names = COMPANY_NAMES) -> DataFrame:
    """The latest ``(currency, source)`` per symbol in all of silver."""
    return latest_attrs(seen_attrs(silver), names)

"""Date and time column functions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _iso(utc_ntz: Column) -> Column:
    text = F.substring(utc_ntz.cast("string"), 1, 19)
    return F.concat(F.replace(text, F.lit(" "), F.lit("T")), F.lit("Z"))


def iso_utc(instant: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` of an instant (TIMESTAMP)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return _iso(epoch + F.make_dt_interval(secs=F.unix_seconds(instant)))


def local_iso_utc(wall_clock: Column, zone: str) -> Column:
    """Same text for a zone-less wall clock time (TIMESTAMP_NTZ) that was read in ``zone``."""
    return _iso(F.convert_timezone(F.lit(zone), F.lit("UTC"), wall_clock))


def calendar_date(date: Column) -> Column:
    """A layer's ``date`` column as DATE, whether it was inferred as string or date; NULL if unusable."""
    return date.try_cast("date")


def date_key(date: Column) -> Column:
    """DATE -> yyyyMMdd as INT."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)

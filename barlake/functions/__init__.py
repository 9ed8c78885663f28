from barlake.functions.numeric import round_cents
from barlake.functions.times import calendar_date, date_key, iso_utc, local_iso_utc

__all__ = ["calendar_date", "date_key", "iso_utc", "local_iso_utc", "round_cents"]

"""Timestamps without zone and windows counted back from a date."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two spellings a survey or inventory uses.
KNOWN_TIME = r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2})?$"


def to_minute(ts: Column) -> Column:
    """Without seconds; by way of text, as date_trunc would go through the session zone."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 16).try_cast("timestamp_ntz")


def timestamp(value: datetime) -> Column:
    """A literal without zone, whatever the session zone is."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def parse(text: Column) -> Column:
    """Text to timestamp; NULL when it is neither of the known spellings."""
    return F.when(text.rlike(KNOWN_TIME), text.try_cast("timestamp_ntz"))


def years_before(value: datetime, years: int) -> Column:
    """The same day years earlier; 29 February falls back to the 28th."""
    return timestamp(value) - F.make_ym_interval(F.lit(years))


def days_before(value: datetime, days: int) -> Column:
    return timestamp(value - timedelta(days=days))


def after(ts: Column, limit: Column) -> Column:
    return F.coalesce(ts > limit, F.lit(False))


def before(ts: Column, limit: Column) -> Column:
    return F.coalesce(ts < limit, F.lit(False))


def within(ts: Column, start: Column, end: Column) -> Column:
    return F.coalesce((ts >= start) & (ts <= end), F.lit(False))

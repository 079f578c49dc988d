"""Whole seconds of zone-free timestamps, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_minutes(ts: Column) -> Column:
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 1440 + F.hour(ts) * 60 + F.minute(ts)


def epoch_seconds(ts: Column) -> Column:
    return epoch_minutes(ts) * 60 + F.second(ts)


def since(ts: Column, as_of: Column, hours: int = 1) -> Column:
    """True for rows at most ``hours`` before ``as_of`` (or after it)."""
    return ts >= as_of - F.make_dt_interval(hours=F.lit(hours))

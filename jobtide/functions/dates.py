"""Epoch seconds, UTC timestamps and calendar days.

Timestamps are ``TIMESTAMP_NTZ`` holding UTC wall time, so no result depends on the session zone.
"""

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_to_utc(seconds: Column) -> Column:
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", seconds, zero)


def day_of(timestamp: Column) -> Column:
    return F.to_date(timestamp)


def utc_time(at: datetime) -> datetime:
    """A time as UTC wall time without a zone; one that has no zone is taken to be in UTC."""
    return at if at.tzinfo is None else at.astimezone(timezone.utc).replace(tzinfo=None)


def utc_literal(at: datetime) -> Column:
    return F.lit(utc_time(at).isoformat(sep=" ")).cast("timestamp_ntz")

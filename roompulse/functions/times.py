"""Time parsing, truncation and the clock that replaces "now"."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Producers write ISO-8601 local times and leave the fraction out
# when it is zero.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
ISO_OUT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
MINUTE_TEXT = "yyyy-MM-dd HH:mm:00"
CLOCK_MINUTE = "HH:mm"
CLOCK_SECOND = "HH:mm:ss"


def parse_iso(text: Column) -> Column:
    """ISO text to a timestamp; null where it does not parse."""
    return F.try_to_timestamp(text, F.lit(ISO_PATTERN))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, ISO_OUT)


def minute_text(ts: Column) -> Column:
    """The minute a timestamp falls in, as ``yyyy-MM-dd HH:mm:00``."""
    return F.date_format(ts, MINUTE_TEXT)


def minute_of(ts: Column) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def bucket_start(ts: Column, minutes: int) -> Column:
    """Start of the half-open bucket of ``minutes`` that holds ``ts``."""
    past_hour = F.minute(ts) % F.lit(minutes)
    return minute_of(ts) - F.make_dt_interval(mins=past_hour)


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def minutes(n: int) -> Column:
    return F.make_dt_interval(mins=F.lit(n))


def days(n: int) -> Column:
    return F.make_dt_interval(days=F.lit(n))


def clock(df: DataFrame, ts: str, as_of: datetime | str | None = None) -> Column:
    """The moment a report looks back from.

    Given explicitly it is a literal, which reaches the scan as a pushed filter.
    Otherwise it is the newest timestamp of the input, as a scalar subquery: one
    partial aggregate over a single column and no join.
    """
    if as_of is not None:
        return F.lit(as_of).cast("timestamp_ntz")
    return df.agg(F.max(ts)).scalar()

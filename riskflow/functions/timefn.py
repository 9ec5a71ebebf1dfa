"""Time arithmetic with the source pipeline's exact semantics (whole seconds, calendar days)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_seconds(ts) -> Column:
    """Whole epoch seconds (fraction truncated), like ``unix_timestamp``; works on zoned and NTZ."""
    return F.unix_timestamp(_c(ts))


def minutes_between(later, earlier) -> Column:
    """(whole seconds of ``later`` - whole seconds of ``earlier``) / 60, unrounded."""
    return (epoch_seconds(later) - epoch_seconds(earlier)) / F.lit(60.0)


def day_diff(later, earlier) -> Column:
    """Calendar-day difference (may be negative), like ``datediff``."""
    return F.datediff(_c(later), _c(earlier))


def parse_timestamp(text) -> Column:
    """String → zone-less timestamp; malformed input gives NULL instead of failing under ANSI."""
    return F.try_to_timestamp(_c(text)).cast("timestamp_ntz")


def time_bucket(ts, bucket_seconds: int) -> Column:
    """Integer bucket of a timestamp, used to split long per-key sequences across tasks."""
    return F.floor(epoch_seconds(ts) / F.lit(bucket_seconds)).cast("long")

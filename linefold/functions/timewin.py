"""Relative time windows as Column predicates.

The original job pasted SQL text fragments built from the clock. Here the
clock is a parameter: ``as_of`` is the UTC instant of the run (naive
``datetime``), so a pass can be replayed, and every predicate is a plain
comparison with a literal that Catalyst folds and pushes to the scan.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from linefold.functions import constants as K
from linefold.functions.columns import col, lit_date, lit_ts


def local_now(as_of: dt.datetime, tz: str = K.PARIS) -> dt.datetime:
    """Wall clock of ``tz`` at the UTC instant ``as_of``, cut to seconds."""
    aware = as_of.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(tz))
    return aware.replace(tzinfo=None, microsecond=0)


def local_today(as_of: dt.datetime, tz: str = K.PARIS) -> dt.date:
    """The day of ``as_of`` in ``tz`` (midnight Paris starts the window)."""
    return local_now(as_of, tz).date()


def day_start(day: dt.date, tz: str = K.PARIS) -> dt.datetime:
    """The UTC instant at which ``day`` begins in ``tz``."""
    return dt.datetime.combine(day, dt.time(), ZoneInfo(tz)).astimezone(dt.timezone.utc).replace(tzinfo=None)


def from_day(instant, day: dt.date, tz: str = K.PARIS) -> Column:
    """Whether a UTC instant falls on ``day`` in ``tz`` or later: as its local
    date compared, but rows are not converted to ``tz`` for it. (Clocks are not
    set back across a midnight there, so days follow each other as instants do.)"""
    return col(instant).cast("timestamp_ntz") >= lit_ts(day_start(day, tz))


def since_today(c, as_of: dt.datetime, tz: str = K.PARIS) -> Column:
    """``c >= `` the day of the run in Paris."""
    return col(c) >= lit_date(local_today(as_of, tz))


def last_minutes(c, minutes: int, as_of: dt.datetime, tz: str = K.PARIS) -> Column:
    """``c >= `` Paris wall clock ``minutes`` before the run."""
    return col(c) >= lit_ts(local_now(as_of - dt.timedelta(minutes=minutes), tz))


def months_back(as_of: dt.datetime, months: int) -> dt.date:
    """CURRENT_DATE (UTC) minus ``months`` months, end of month clamped."""
    d = as_of.date()
    y, m = divmod(d.month - 1 - months, 12)
    year, month = d.year + y, m + 1
    for day in (d.day, 30, 29, 28):
        try:
            return dt.date(year, month, day)
        except ValueError:
            continue
    raise AssertionError("unreachable")


def last_months(c, months: int, as_of: dt.datetime) -> Column:
    """``c >= `` UTC day of the run minus ``months`` months."""
    return col(c) >= lit_date(months_back(as_of, months))


def window_start(pattern: str, as_of: dt.datetime, tz: str = K.PARIS) -> dt.date:
    """First day of a named load pattern.

    'LAST_24H' and '5MIN' both mean "since midnight in Paris". Any other name
    raises (the original silently produced no predicate).
    """
    p = pattern.upper()
    if p in ("LAST_24H", "5MIN"):
        return local_today(as_of, tz)
    raise ValueError(f"unknown load pattern: {pattern!r}")


def pattern_predicate(pattern: str, c, as_of: dt.datetime, tz: str = K.PARIS) -> Column:
    return col(c) >= lit_date(window_start(pattern, as_of, tz))


def timestamp_window_start(pattern: str, as_of: dt.datetime, tz: str = K.PARIS) -> dt.datetime:
    """First Paris wall clock of a named load pattern on timestamps: '5MIN'
    looks back ten minutes, twice the time between passes."""
    if pattern.upper() == "5MIN":
        return local_now(as_of - dt.timedelta(minutes=K.FIVE_MINUTE_LOOKBACK), tz)
    raise ValueError(f"unknown load pattern: {pattern!r}")


def timestamp_predicate(pattern: str, c, as_of: dt.datetime, tz: str = K.PARIS) -> Column:
    return col(c) >= lit_ts(timestamp_window_start(pattern, as_of, tz))


def long_window_start(pattern: str, as_of: dt.datetime) -> dt.date:
    """Start of the long window (originals of backorders): 3 months back."""
    if pattern.upper() == "5MIN":
        return months_back(as_of, K.ORIGINAL_LOOKBACK_MONTHS)
    raise ValueError(f"unknown load pattern: {pattern!r}")


def day_before(d: dt.date) -> dt.date:
    """Partition bound of ``DATE_ADD(ingest_date, 1) >= d`` i.e. ``ingest_date >= d - 1``."""
    return d - dt.timedelta(days=1)


def ingest_since(ingest_date, since: dt.date) -> Column:
    """Load-day test, shifted by a day, written so it prunes partitions."""
    return col(ingest_date) >= lit_date(day_before(since))


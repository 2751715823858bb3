"""Calendar helpers.

The first half runs on the driver and touches job parameters only, never data.
The second half are column expressions.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.functions.columns import col

BACKFILL_LOOKBACK_DAYS = 14
CONTACT_GRACE = timedelta(hours=1)


# --- job parameters ---------------------------------------------------------

def day_to_date(day: int) -> date:
    """20240115 -> date(2024, 1, 15)"""
    return datetime.strptime(str(day), "%Y%m%d").date()


def date_to_day(value: date) -> int:
    return value.year * 10000 + value.month * 100 + value.day


def month_of(day: int) -> int:
    return day // 100


def month_bounds(month: int) -> tuple[int, int]:
    """First and last calendar day of a yyyyMM month, as yyyyMMdd."""
    first = day_to_date(month * 100 + 1)
    following = (first.replace(day=28) + timedelta(days=4)).replace(day=1)
    return date_to_day(first), date_to_day(following - timedelta(days=1))


def days_before(day: int, n: int) -> int:
    return date_to_day(day_to_date(day) - timedelta(days=n))


def backfill_bounds(day: int, lookback: int = BACKFILL_LOOKBACK_DAYS) -> tuple[int, int]:
    """Days a daily run recomputes: from the earlier of the month start and
    ``day - lookback`` up to ``day``, both included."""
    return min(month_bounds(month_of(day))[0], days_before(day, lookback)), day


def backfill_days(spark: SparkSession, start: int, end: int) -> DataFrame:
    """One row per calendar day in ``[start, end]`` as an int column ``day``."""
    dates = F.sequence(F.lit(day_to_date(start)), F.lit(day_to_date(end)))
    return spark.range(1).select(F.explode(F.transform(dates, to_day_int)).alias("day"))


# --- column expressions -----------------------------------------------------

def to_day_int(c: str | Column) -> Column:
    """Date or timestamp -> yyyyMMdd int."""
    c = col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def day_int_to_date(c: str | Column) -> Column:
    return F.to_date(col(c).cast("string"), "yyyyMMdd")


def within_days(c: str | Column, start: int, end: int) -> Column:
    """``to_date(c) BETWEEN start AND end`` as a plain range on the time column, so
    that it reaches the file scan. Bounds are written as text: Spark reads them in
    the column's own type, with or without time zone, and leaves the column bare."""
    c = col(c)
    return (c >= _at(_midnight(start))) & (c < _at(_midnight(end) + timedelta(days=1)))


def overlaps_days(start: str | Column, end: str | Column, lo: int, hi: int) -> Column:
    """The dates from ``start`` to ``end`` share a day with ``[lo, hi]``, again as plain
    ranges on the time columns."""
    after_hi = _at(_midnight(hi) + timedelta(days=1))
    return (col(start) < after_hi) & (col(end) >= _at(_midnight(lo)))


def within_contact_window(c: str | Column, start: int, end: int) -> Column:
    """From ``start`` 00:00:00 to the day after ``end`` at 01:00:00, both included."""
    c = col(c)
    return (c >= _at(_midnight(start))) & (
        c <= _at(_midnight(end) + timedelta(days=1) + CONTACT_GRACE)
    )


def contact_days(c: str | Column, start: int, end: int) -> Column:
    """Array of the days (int) in ``[start, end]`` whose contact window holds the
    instant ``c``: its own date and, up to 01:00:00, the date before."""
    c = col(c)
    own = F.to_date(c)
    grace = F.lit(CONTACT_GRACE)
    days = F.array(
        to_day_int(own),
        F.when(c <= F.date_trunc("day", c) + grace, to_day_int(F.date_sub(own, 1))),
    )
    return F.filter(days, lambda d: d.between(start, end))


def instant_of(epoch_ms: str | Column) -> Column:
    """Timestamp of an epoch-millisecond value."""
    return F.timestamp_millis(col(epoch_ms))


def instant_before(epoch_ms: str | Column, seconds: int = 1) -> Column:
    """Timestamp ``seconds`` before an epoch-millisecond value."""
    return instant_of(col(epoch_ms) - F.lit(seconds * 1000))


def _midnight(day: int) -> datetime:
    return datetime.combine(day_to_date(day), datetime.min.time())


def _at(instant: datetime) -> Column:
    return F.lit(instant.isoformat(sep=" "))

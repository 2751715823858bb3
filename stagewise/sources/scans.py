"""Scans. Every one puts its bounds on the bare partition or time column, which
prunes partitions and reaches the file reader; column pruning is Catalyst's."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.functions.dates import date_to_day, day_to_date, month_bounds, month_of, within_days

# The days an event query may span, and the types of events.
MAX_EVENT_DAYS = 7
EVENT_TYPES = ("click", "dev", "get", "enter", "popup", "other")

EVENT_COLUMNS = (
    "u_user", "event_time", "scene", "option", "event_type", "event_key", "operate_ids",
    "operate_id", "task_id", "os", "page_type", "product_id", "day",
)


def scan_events(
    events: DataFrame,
    start: int,
    end: int,
    event_types: Iterable[str],
    event_keys: Iterable[str] | None = None,
    columns: Iterable[str] = EVENT_COLUMNS,
) -> DataFrame:
    """Events of the days ``[start, end]``; one day when they are equal."""
    kept = scan_days(events, start, end).where(F.col("event_type").isin(*event_types))
    if event_keys is not None:
        kept = kept.where(F.col("event_key").isin(*event_keys))
    return kept.select(*columns)


def scan_days(df: DataFrame, start: int, end: int, day: str = "day") -> DataFrame:
    if start == end:
        return df.where(F.col(day) == start)
    return df.where(F.col(day).between(start, end))


def scan_month(df: DataFrame, month: int, day: str = "day") -> DataFrame:
    """All days of a yyyyMM month. ``int(day / 100) = month`` hides the column from
    file statistics; a range on it does not."""
    return scan_days(df, month * 100 + 1, month * 100 + 31, day)


def scan_month_to_date(df: DataFrame, day_value: int, day: str = "day") -> DataFrame:
    return scan_days(df, month_bounds(month_of(day_value))[0], day_value, day)


def eligible_orders(orders: DataFrame) -> DataFrame:
    """Orders that count for a sales conversion. NULL in any tested column drops the row."""
    return orders.where(
        (F.col("is_test") == F.lit(False)) & (F.col("in_salary") == 1) & (F.col("worker_id") != 0)
    )


# Work places whose orders the paid pool counts, and departments it does not.
PAID_WORKPLACES = (4, 400, 702)
EXCLUDED_REGIMENTS = (0, 303, 546)


def eligible_team_orders(orders: DataFrame, start: int, end: int) -> DataFrame:
    """Orders of the paid pool, paid in ``[start, end]``."""
    return orders.where(
        F.col("workplace_id").isin(*PAID_WORKPLACES)
        & ~F.col("regiment_id").isin(*EXCLUDED_REGIMENTS)
        & (F.col("worker_id") != 0)
        & (F.col("in_salary") == 1)
        & within_days("pay_time", start, end)
    )


def guarded_scan(
    events: DataFrame,
    start: int,
    end: int,
    event_types: Iterable[str],
    columns: Iterable[str],
    limit: int | None = None,
    known_types: Iterable[str] = EVENT_TYPES,
) -> DataFrame:
    """Ad-hoc event scan that refuses what the query rules forbid: no event type,
    more than seven days, ``*`` instead of named columns. All rows come unless ``limit`` asks for fewer."""
    event_types, columns = list(event_types), list(columns)
    unknown = set(event_types) - set(known_types)
    if not event_types or unknown:
        raise ValueError(f"event types must be among {tuple(known_types)}, got {event_types}")
    if not columns or "*" in columns:
        raise ValueError("columns must be named")
    if limit is not None and limit < 1:
        raise ValueError("a limit must be 1 or more")
    span = (day_to_date(end) - day_to_date(start)).days + 1
    if not 1 <= span <= MAX_EVENT_DAYS:
        raise ValueError(f"{date_to_day(day_to_date(start))}..{end} is {span} days, allowed are 1 to 7")
    found = scan_events(events, start, end, event_types, columns=columns)
    return found if limit is None else found.limit(limit)

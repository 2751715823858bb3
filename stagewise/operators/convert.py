"""Order conversion: count and amount of a user's orders in date windows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.functions.dates import (
    date_to_day,
    day_to_date,
    month_bounds,
    month_of,
    to_day_int,
    within_days,
)

MONTH_END = "month_end"


def conversions(
    orders: DataFrame,
    key: str,
    paid_at: str,
    amount: str,
    start: int,
    end: int,
    windows: dict[str, int | str],
) -> DataFrame:
    """One row per key and anchor day in ``[start, end]`` that converted in at
    least one window. ``windows`` maps a name to a number of days (both ends in:
    7 covers eight dates) or to :data:`MONTH_END`. Columns: key, ``day``,
    ``paid_<name>_order_cnt`` and ``paid_<name>_amount``, NULL where the window is empty.

    Orders are summed per key and date before anything else, so what is spread to
    the anchor days is at most one row per key and date however hot the key is.
    All windows and all anchor days come from one pass over the orders.
    """
    reach = max([n for n in windows.values() if n != MONTH_END], default=0)
    to_month_end = MONTH_END in windows.values()
    last = date_to_day(day_to_date(end) + timedelta(days=reach))
    if to_month_end:
        last = max(last, month_bounds(month_of(end))[1])

    per_date = (
        orders.where(within_days(paid_at, start, last))
        .groupBy(key, F.to_date(paid_at).alias("_paid_on"))
        .agg(F.count(F.lit(1)).alias("_cnt"), F.sum(amount).alias("_amount"))
    )
    earliest = F.date_sub("_paid_on", reach)
    if to_month_end:
        earliest = F.least(earliest, F.trunc("_paid_on", "month"))
    first_anchor = F.greatest(earliest, F.lit(day_to_date(start)))
    last_anchor = F.least(F.col("_paid_on"), F.lit(day_to_date(end)))
    anchored = (
        per_date.withColumn("_lo", first_anchor)
        .withColumn("_hi", last_anchor)
        .where(F.col("_lo") <= F.col("_hi"))
        .withColumn("_anchor", F.explode(F.sequence("_lo", "_hi")))
    )
    aggregates: list[Column] = []
    for name, reach_days in windows.items():
        until = (
            F.last_day("_anchor") if reach_days == MONTH_END else F.date_add("_anchor", reach_days)
        )
        inside = F.col("_paid_on") <= until
        aggregates += [
            F.sum(F.when(inside, F.col("_cnt"))).alias(f"paid_{name}_order_cnt"),
            F.sum(F.when(inside, F.col("_amount"))).alias(f"paid_{name}_amount"),
        ]
    return anchored.groupBy(key, to_day_int("_anchor").alias("day")).agg(*aggregates)


def total_orders(orders: DataFrame, key: str, amount: str, name: str) -> DataFrame:
    """Count and amount over all given orders of a key."""
    return orders.groupBy(key).agg(
        F.count(F.lit(1)).alias(f"paid_{name}_order_cnt"), F.sum(amount).alias(f"paid_{name}_amount")
    )

"""The nightly jobs: parameters in, partitions overwritten. A target is a path, the name of a
catalog table that is partitioned by ``day`` or ``month``, or a :class:`Published` table, which readers see change in one step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.functions.dates import (
    backfill_bounds,
    day_to_date,
    days_before,
    month_of,
)
from stagewise.plans.backfill import changed_days, day_fingerprints, runs_of
from stagewise.plans.funnel import FunnelTables, daily_funnel, monthly_funnel
from stagewise.plans.pool import PaidPoolTables, month_pool, paid_pool
from stagewise.sources.publish import Published
from stagewise.sources.sinks import overwrite_partition, write_days


def run_daily_funnel(tables: FunnelTables, day: int, target: str | Published) -> list[int]:
    """Recomputes every day of the backfill range of ``day`` in one job: contacts and
    orders of the days before keep arriving. Returns the days that were overwritten."""
    start, end = backfill_bounds(day)
    span = (day_to_date(end) - day_to_date(start)).days
    days = [days_before(end, n) for n in range(span, -1, -1)]
    write_days(daily_funnel(tables, start, end), target, days)
    return days


def run_changed_days(tables: FunnelTables, day: int, target: Published, ledger: Published) -> list[int]:
    """Like :func:`run_daily_funnel`, but only for days of the backfill range whose inputs have changed since they were last
    computed, by the fingerprints in ``ledger``. Returns the days that were recomputed. If a run ends between the
    two publishes its days are computed again, with the same result."""
    start, end = backfill_bounds(day)
    now = day_fingerprints(tables, start, end)
    days = changed_days(now, ledger)
    if not days:
        return []
    parts = [daily_funnel(tables, *run) for run in runs_of(days)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    target.publish(whole, days)
    ledger.publish(now.where(F.col("day").isin(days)), days)
    return days


def run_monthly_funnel(tables: FunnelTables, day: int, target: str | Published) -> None:
    month = month_of(day)
    overwrite_partition(monthly_funnel(tables, month), target, {"month": month})


def run_month_pool(
    pool_days: DataFrame, denials: DataFrame, allocations: DataFrame, day: int, target: str | Published
) -> None:
    month = month_of(day)
    overwrite_partition(month_pool(pool_days, denials, allocations, month), target, {"month": month})


def run_paid_pool(tables: PaidPoolTables, day: int, target: str | Published) -> None:
    overwrite_partition(paid_pool(tables, day), target, {"month": month_of(day)})

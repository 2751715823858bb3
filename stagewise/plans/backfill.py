"""Which days of a backfill have to be computed again: a ledger of fingerprints of each day's inputs.

A day of the funnel reads the rows of every input that fall into the day's window. Its fingerprint of an input is made of the number of those
rows, the sum of their hashes and the exclusive or of other hashes: the order and the place of rows do not matter, repeated rows do.
"""

from __future__ import annotations

from calendar import monthrange
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.functions.dates import date_to_day, day_to_date
from stagewise.plans.funnel import FunnelTables
from stagewise.sources.publish import Published


def _orders_until(day: date) -> date:
    month_end = day.replace(day=monthrange(day.year, day.month)[1])
    return max(day + timedelta(days=14), month_end)


def _inputs() -> dict[str, tuple]:
    """Per input: the columns that place a row in time (first, last), and the last date that a day's window takes. A
    window begins with the day itself. Inputs without columns concern every day."""
    same, next_ = lambda d: d, lambda d: d + timedelta(days=1)
    of_day = F.to_date(F.col("day").cast("string"), "yyyyMMdd")
    return {
        "events": (of_day, of_day, same),
        "users": (of_day, of_day, same),
        "contacts": (F.to_date("created_at"), F.to_date("created_at"), next_),
        "clues": (F.to_date("created_at"), F.to_date("created_at"), next_),
        "orders": (F.to_date("pay_time"), F.to_date("pay_time"), _orders_until),
        "service_periods": (F.to_date("start_time"), F.to_date("end_time"), same),
        "school_periods": (F.to_date("start_time"), F.to_date("end_time"), same),
        "channels": (F.to_date("effective_time"), F.to_date("invalid_time"), same),
        "teams": None,
        "grades": None,
    }


def day_fingerprints(tables: FunnelTables, start: int, end: int) -> DataFrame:
    """One row per day of ``[start, end]`` and input. Each input is read once; hashes are summed on the map side."""
    span = (day_to_date(end) - day_to_date(start)).days
    dates = [day_to_date(start) + timedelta(days=n) for n in range(span + 1)]
    spark = tables.events.sparkSession
    days = spark.createDataFrame([(date_to_day(d),) for d in dates], "day int")
    whole = None
    for name, placed in _inputs().items():
        df = getattr(tables, name)
        found = _touched(df, placed, dates).groupBy("_day").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("_hash").cast("decimal(20,0)")).alias("total"), F.bit_xor("_other").alias("mix")
        )
        row = days.join(found, F.col("day") == F.col("_day"), "left").select(
            F.lit(name).alias("input"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            F.coalesce("total", F.lit(0)).cast("decimal(38,0)").alias("total"), F.coalesce("mix", F.lit(0)).alias("mix"), "day",
        )
        whole = row if whole is None else whole.unionByName(row)
    return whole


def _touched(df: DataFrame, placed: tuple | None, dates: list[date]) -> DataFrame:
    """``_day, _hash, _other``: a row's hashes for every day whose window holds it."""
    names = [F.col(f"`{c}`") for c in sorted(df.columns)]
    hashes = [F.xxhash64(*names).alias("_hash"), F.xxhash64(F.lit(1), *names).alias("_other")]
    if placed is None:
        every: Column = F.array(*[F.lit(date_to_day(d)) for d in dates])
        return df.select(*hashes, F.explode(every).alias("_day"))
    first, last, until = placed
    windows = F.array(*[F.struct(F.lit(date_to_day(d)).alias("day"), F.lit(d).alias("lo"), F.lit(until(d)).alias("hi")) for d in dates])
    reach = F.filter(windows, lambda w: (first <= w["hi"]) & (last >= w["lo"]))
    lo, hi = dates[0], max(until(d) for d in dates)
    return df.where((first <= F.lit(hi)) & (last >= F.lit(lo))).select(
        *hashes, F.explode(F.transform(reach, lambda w: w["day"])).alias("_day")
    )


def changed_days(now: DataFrame, ledger: Published) -> list[int]:
    """Days whose fingerprints are not those of the ledger; a row per day and input reaches the driver."""
    if not ledger.versions():
        return sorted(r.day for r in now.select("day").distinct().collect())
    columns = now.columns
    return sorted(r.day for r in now.exceptAll(ledger.read().select(*columns)).select("day").distinct().collect())


def runs_of(days: list[int]) -> list[tuple[int, int]]:
    """Days as runs of neighbours, first and last."""
    runs: list[tuple[int, int]] = []
    for day in sorted(days):
        if runs and day_to_date(day) - day_to_date(runs[-1][1]) == timedelta(days=1):
            runs[-1] = (runs[-1][0], day)
        else:
            runs.append((day, day))
    return runs

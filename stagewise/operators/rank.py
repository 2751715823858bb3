"""First, last and last-n rows per key.

``row_number() <= n`` is planned with a group limit on both sides of the
exchange, so a key that holds a third of the table sends at most ``n`` rows per
map task, not its whole history.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewise.functions.columns import col, names


def _top(df: DataFrame, keys, order: list[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*names(keys)).orderBy(*order)
    return df.withColumn("_rk", F.row_number().over(window)).where(F.col("_rk") <= n).drop("_rk")


def first_by(df: DataFrame, keys, order, tie_break: Iterable[str] = ()) -> DataFrame:
    """The earliest row per key; NULL order values come first, as in Spark SQL.
    ``tie_break`` columns settle rows that share the order value."""
    return _top(df, keys, [col(c).asc() for c in [*names(order), *tie_break]], 1)


def latest_by(df: DataFrame, keys, order, tie_break: Iterable[str] = ()) -> DataFrame:
    """The latest row per key; ties are settled by the smallest ``tie_break``."""
    ordering = [col(c).desc() for c in names(order)] + [col(c).asc() for c in tie_break]
    return _top(df, keys, ordering, 1)


def last_n_by(df: DataFrame, keys, order, n: int, tie_break: Iterable[str] = ()) -> DataFrame:
    """The ``n`` latest rows per key, such as the last turns of a conversation."""
    ordering = [col(c).desc() for c in names(order)] + [col(c).asc() for c in tie_break]
    return _top(df, keys, ordering, n)


def first_and_latest(order, first: Iterable[str], latest: Iterable[str]) -> list[Column]:
    """Aggregates giving the ``first`` columns of the earliest row and the
    ``latest`` columns of the latest row of a group, for use in one ``agg``.

    Struct ordering compares the order columns first and the payload next, which
    also makes ties deterministic. Rows come back as structs named ``_first`` and
    ``_latest``; see :func:`unpack`.
    """
    order = names(order)
    return [
        F.min(F.struct(*order, *[c for c in first if c not in order])).alias("_first"),
        F.max(F.struct(*order, *[c for c in latest if c not in order])).alias("_latest"),
    ]


def unpack(struct: str, columns: Iterable[str], prefix: str = "") -> list[Column]:
    return [F.col(struct)[c].alias(prefix + c) for c in columns]


def first_and_latest_by(
    df: DataFrame, keys, order, first: Iterable[str], latest: Iterable[str]
) -> DataFrame:
    """Both snapshots of every key from one scan and one exchange. Output columns
    are prefixed ``first_`` and ``latest_``."""
    keys, first, latest = names(keys), list(first), list(latest)
    return (
        df.groupBy(*keys)
        .agg(*first_and_latest(order, first, latest))
        .select(*keys, *unpack("_first", first, "first_"), *unpack("_latest", latest, "latest_"))
    )

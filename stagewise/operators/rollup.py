"""Per-key aggregates. All of them combine on the map side."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.functions.columns import col, names

_AGGREGATES = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.count}


def rollup_columns(aggregates: dict[str, str]) -> list[Column]:
    """``{"push_cnt": "sum", ...}`` -> aliased aggregates."""
    return [_AGGREGATES[fn](c).alias(c) for c, fn in aggregates.items()]


def rollup(df: DataFrame, keys, aggregates: dict[str, str]) -> DataFrame:
    return df.groupBy(*names(keys)).agg(*rollup_columns(aggregates))


def collapse_max(df: DataFrame, keys, columns: Iterable[str]) -> DataFrame:
    """Largest value of every column on its own: the output row may mix values of
    several input rows. Use :func:`stagewise.operators.rank.latest_by` to keep a row."""
    return rollup(df, keys, {c: "max" for c in columns})


def distinct_sorted(c: str | Column) -> Column:
    """Sorted distinct non-NULL values of a group, NULL when there are none. The
    result is as long as the value domain (codes, sources), not as the group."""
    values = F.sort_array(F.collect_set(col(c)))
    return F.when(F.size(values) > 0, values)


def has_value(c: str | Column, value) -> Column:
    """Whether a group holds ``value``, without building the set."""
    return F.coalesce(F.max(col(c) == value), F.lit(False))


def max_when(condition: Column, value) -> Column:
    return F.max(F.when(condition, value))


def min_when(condition: Column, value) -> Column:
    return F.min(F.when(condition, value))


def distinct_keys(df: DataFrame, columns) -> DataFrame:
    columns = names(columns)
    return df.select(*columns).dropDuplicates(columns)

"""Small column predicates shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def names(c: str | Iterable[str]) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


def not_blank(c: str | Column, *also_missing: str) -> Column:
    """Neither NULL nor ``""`` nor one of ``also_missing`` (such as ``'undefined'``)."""
    c = col(c)
    keep = c.isNotNull() & (c != "")
    return keep & ~c.isin(*also_missing) if also_missing else keep


def is_text(c: str | Column) -> Column:
    """``length(c) > 0``: NULL is not text."""
    return F.length(col(c)) > 0


def valid_on(start: str | Column, end: str | Column, at: Column) -> Column:
    """The interval contains ``at``, both ends included."""
    return (col(start) <= at) & (col(end) >= at)


def overlaps(start: str | Column, end: str | Column, lo: Column, hi: Column) -> Column:
    """The interval shares at least one point with ``[lo, hi]``."""
    return (col(start) <= hi) & (col(end) >= lo)


def comma_items(c: str | Column) -> Column:
    """First element of an array of comma lists, split: NULL or an empty array
    gives NULL, ``""`` gives one blank item."""
    return F.split(F.get(col(c), F.lit(0)), ",")

"""Point-in-interval joins and dimension versions.

Nothing bounds how many periods or points one key has, and comparing each of a hot key's points with
each of its periods would be quadratic. So time is cut into cells: of ``CELL_SECONDS``, of 4 times
that, and so on. A period is written as the few largest cells that tile what it covers whole, and
as the two small cells at its ends. Of the periods that cover a cell whole only the latest is kept.

What holds in a small cell (the latest period that covers it whole, and those that begin or end in it) is looked up once
per populated cell of a key, one row per size, and not once per point. Points are then joined to
their cell as they are, one row each, and choose among the few periods that the cell has left.
The sizes follow from the range of time alone: building the plan reads no data.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.functions.columns import col, names, overlaps
from stagewise.operators.joins import shuffled
from stagewise.operators.rank import latest_by

CELL_SECONDS = 900
_BITS = 2
_ALWAYS = ("0001-01-01 00:00:00", "9999-12-31 23:59:59")
_ENDS = -1  # level of the cells at the ends of a period


def latest_covering(
    points: DataFrame,
    periods: DataFrame,
    keys,
    at: str,
    start: str,
    end: str,
    take: Iterable[str],
    *,
    within: tuple[str, str] = _ALWAYS,
) -> DataFrame:
    """Left join of every point to the period of its key that holds ``at`` and began
    last (both ends in), adding the period's ``start`` and ``take`` columns; equal
    starts are settled by the largest ``take`` values. All rows of ``points`` stay, equal ones too.

    ``within`` bounds the instants that are looked up (``yyyy-MM-dd HH:mm:ss``): periods are cut
    to it before they become cells. A point outside of it finds nothing.
    """
    keys, take = names(keys), list(take)
    first, last = (datetime.fromisoformat(t) for t in within)
    cells = math.ceil(((last - first).total_seconds() + 1) / CELL_SECONDS) + 1
    sizes = max(1, math.ceil(cells.bit_length() / _BITS))
    origin = F.unix_micros(F.lit(within[0]).cast("timestamp"))

    def micros(c) -> Column:
        return F.unix_micros(col(c).cast("timestamp")) - origin

    usable = _usable(periods, keys, start, end).where(overlaps(start, end, F.lit(within[0]), F.lit(within[1])))
    best = F.struct(start, *take).alias("_best")
    cut = usable.select(
        *keys, best,
        F.greatest(micros(start), F.lit(0)).alias("_lo"),
        F.least(micros(end), micros(F.lit(within[1])) + 999_999).alias("_hi"),
    )
    edge = F.when(F.col("_level") == _ENDS, F.struct("_best", "_lo", "_hi"))
    covers = (
        _cells_of(cut, sizes)
        .groupBy(*keys, "_level", "_cell")
        .agg(F.max(F.when(F.col("_level") >= 0, F.col("_best"))).alias("_whole"), F.collect_set(edge).alias("_edges"))
    )

    unit = F.lit(CELL_SECONDS * 1_000_000)
    known = F.col(at).isNotNull() & micros(at).between(F.lit(0), micros(F.lit(within[1])) + 999_999)
    for key in keys:
        known = known & F.col(key).isNotNull()
    own = F.floor(micros(at) / unit)
    levels = F.concat(
        F.array(F.struct(F.lit(_ENDS).alias("_level"), F.col("_own").alias("_cell"))),
        F.array(*[F.struct(F.lit(n).alias("_level"), F.shiftright("_own", _BITS * n).alias("_cell")) for n in range(sizes)]),
    )
    populated = points.where(known).select(*keys, own.alias("_own")).distinct()
    located = populated.withColumn("_in", F.explode(levels)).select(*keys, "_own", "_in._level", "_in._cell")
    held = (
        located.join(shuffled(covers), [*keys, "_level", "_cell"])
        .groupBy(*keys, "_own")
        .agg(F.max("_whole").alias("_whole"), F.flatten(F.collect_list("_edges")).alias("_edges"))
    )
    joined = points.withColumns({"_own": F.when(known, own), "_at": micros(at)}).join(shuffled(held), [*keys, "_own"], "left")
    inside = F.filter("_edges", lambda e: F.col("_at").between(e["_lo"], e["_hi"]))
    found = F.greatest("_whole", F.array_max(F.transform(inside, lambda e: e["_best"])))
    joined = joined.withColumn("_found", found)
    return joined.select(*points.columns, *[F.col("_found")[c].alias(c) for c in [start, *take]])


def latest_valid(
    versions: DataFrame,
    keys,
    start: str,
    end: str,
    lo: Column,
    hi: Column,
    tie_break: Iterable[str] = (),
) -> DataFrame:
    """Per key, the last version that is valid at some point of ``[lo, hi]``."""
    return latest_by(versions.where(overlaps(start, end, lo, hi)), keys, start, tie_break)


def _usable(periods: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    keep = F.col(start) <= F.col(end)
    for key in keys:
        keep = keep & F.col(key).isNotNull()
    return periods.where(keep)


def _cells_of(cut: DataFrame, sizes: int) -> DataFrame:
    """One row per cell that tiles what a period covers whole (at every size, the cells left over
    at both ends once the next larger size has taken what it can), and one per cell that it begins or ends in."""
    unit = CELL_SECONDS * 1_000_000

    def numbers(lo: str, hi: str) -> str:
        return f"if({lo} < {hi}, sequence({lo}, {hi} - 1), CAST(array() AS array<bigint>))"

    tiles = []
    for n in range(sizes):
        # The cells of size n inside the period are lo..hi-1; those from up to down-1 fill larger cells, if there are any.
        lo, hi = f"shiftright(_from + {(1 << _BITS * n) - 1}L, {_BITS * n})", f"shiftright(_to, {_BITS * n})"
        if n == sizes - 1:
            tiles.append(f"transform({numbers(lo, hi)}, c -> struct({n} AS _level, c AS _cell))")
            continue
        up = f"shiftleft(shiftright({lo} + {(1 << _BITS) - 1}, {_BITS}), {_BITS})"
        down = f"shiftleft(shiftright({hi}, {_BITS}), {_BITS})"
        some = f"concat({numbers(lo, up)}, {numbers(down, hi)})"
        tiles.append(f"transform(if({up} < {down}, {some}, {numbers(lo, hi)}), c -> struct({n} AS _level, c AS _cell))")
    ends = f"transform(array_distinct(array(_lo div {unit}, _hi div {unit})), c -> struct({_ENDS} AS _level, c AS _cell))"
    bounded = cut.withColumns({"_from": F.expr(f"(_lo + {unit - 1}) div {unit}"), "_to": F.expr(f"(_hi + 1) div {unit}")})
    cells = F.expr(f"concat({ends}, if(_from < _to, concat({', '.join(tiles)}), array()))")
    return bounded.withColumn("_in", F.explode(cells)).select(*cut.columns, "_in._level", "_in._cell")

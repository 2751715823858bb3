"""Payment timelines: reverse cumulative amounts and what follows an instant."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stagewise.functions.columns import names
from stagewise.operators.joins import shuffled


#: Minutes in a day, days in a key's history, instants in a minute: what one task orders. Where a key can hold very many
#: instants in a minute, a third size (``"millisecond"``) splits it.
PIECES = ("day", "minute")


def per_instant(df: DataFrame, keys, ts: str, amount: str, pieces: tuple[str, ...] = PIECES) -> DataFrame:
    """Amount (``_total``) and number of rows (``_ties``) per key and instant, and the fine piece
    of the time axis that it lies in (``_fine``). The piece is an aggregate so that what joins demand of
    it is not pushed below: all readers of one key's instants then share one exchange."""
    keys = names(keys)
    usable = F.col(ts).isNotNull()
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    return (
        df.where(usable)
        .groupBy(*keys, ts)
        .agg(
            F.sum(amount).alias("_total"),
            F.count(F.lit(1)).alias("_ties"),
            F.min(F.date_trunc(pieces[-1], ts)).alias("_fine"),
        )
    )


def _sums_before(
    rows: DataFrame, keys: list[str], measures: list[str], pieces: tuple[str, ...], later_first: bool
) -> DataFrame:
    """Per key and fine piece of the time axis (the last of ``pieces``), the sums over all pieces in front of it
    (behind it, with ``later_first``), as ``_before_<measure>``, and the sums of the whole key, as ``_all_<measure>``.

    Pieces of one size are ordered inside one piece of the next larger size only and the largest inside a key, so
    what one task orders is bounded by the calendar and not by the rows of a key.
    """
    cells = rows.groupBy(*keys, "_fine").agg(*[F.sum(m).alias(m) for m in measures])
    order = F.col("_fine").desc() if later_first else F.col("_fine").asc()

    def before(window):
        ahead = window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(F.sum(m).over(ahead), F.lit(0)).alias(f"_before_{m}") for m in measures]

    if len(pieces) == 1:
        whole = Window.partitionBy(*keys)
        return cells.select(*keys, "_fine", *before(whole), *[F.sum(m).over(whole).alias(f"_all_{m}") for m in measures])
    cells = cells.withColumn("_coarse", F.date_trunc(pieces[-2], "_fine"))
    inside = cells.select(*keys, "_coarse", "_fine", *before(Window.partitionBy(*keys, "_coarse")))
    larger = cells.select(*keys, F.col("_coarse").alias("_fine"), *measures)
    outside = _sums_before(larger, keys, measures, pieces[:-1], later_first).withColumnRenamed("_fine", "_coarse")
    outside = outside.withColumnsRenamed({f"_before_{m}": f"_out_{m}" for m in measures})
    total = [(F.col(f"_before_{m}") + F.col(f"_out_{m}")).alias(f"_before_{m}") for m in measures]
    return inside.join(shuffled(outside), [*keys, "_coarse"]).select(*keys, "_fine", *total, *[f"_all_{m}" for m in measures])


def _with_later(instants: DataFrame, keys: list[str], ts: str, pieces: tuple[str, ...], more: list[str]) -> DataFrame:
    """Rows per instant with the amount of it and all later ones (``_after``), and the sums of ``more`` over later pieces."""
    measures = ["_total", "_ties", *more]
    later = _sums_before(instants, keys, measures, pieces, later_first=True)
    inside = Window.partitionBy(*keys, "_fine").orderBy(F.col(ts).desc()).rowsBetween(Window.unboundedPreceding, 0)
    running = instants.withColumns({f"_running_{m}": F.sum(m).over(inside) for m in ["_total", *more]})
    # The number of later rows is never negative; asking for it keeps both sides on one exchange.
    joined = running.join(shuffled(later.where("_before__ties >= 0")), [*keys, "_fine"])
    return joined.withColumn("_after", F.coalesce(F.col("_running__total") + F.col("_before__total"), F.col("_before__total")))


def paid_timeline(
    df: DataFrame, keys, ts: str, amount: str, out: str = "amount_after", position: str = "position", *,
    dedupe_ties: bool = False, pieces: tuple[str, ...] = PIECES,
) -> DataFrame:
    """A key's timeline as rows: keys, ``ts``, :func:`suffix_sum` and the entry's place in time, from 1. Amount and place come from
    the same rows per instant: ``df`` is read once and one pass over the pieces gives both."""
    keys = names(keys)
    instants = per_instant(df, keys, ts, amount, pieces).withColumn("_one", F.lit(1).cast("long"))
    found = _with_later(instants, keys, ts, pieces, ["_one"])
    value = F.col("_after") if dedupe_ties else F.col("_after") * F.col("_ties")
    place = F.col("_all__one") - F.col("_before__one") - F.col("_running__one") + 1
    return found.select(*keys, ts, F.round(value, 2).alias(out), place.alias(position))


def suffix_sum(
    df: DataFrame,
    keys,
    ts: str,
    amount: str,
    out: str = "amount_after",
    *,
    dedupe_ties: bool = False,
    pieces: tuple[str, ...] = PIECES,
) -> DataFrame:
    """Per key and instant, the amount of that and all later rows, to 2 decimals.

    ``n`` rows at one instant count the sum ``n`` times, as joining every row to the
    key's same-or-later rows does; ``dedupe_ties=True`` counts it once.

    The running sum is taken inside fine pieces of the time axis, and the sums of all later
    pieces are added. ``df`` is read once: pieces are summed from the rows per instant, and
    both uses of those ask for the same columns, so that they share one exchange.
    """
    keys = names(keys)
    return suffix_sum_of(per_instant(df, keys, ts, amount, pieces), keys, ts, out, dedupe_ties=dedupe_ties, pieces=pieces)


def suffix_sum_of(
    instants: DataFrame, keys, ts: str, out: str = "amount_after", *, dedupe_ties=False, pieces=PIECES
) -> DataFrame:
    """:func:`suffix_sum` from the rows of :func:`per_instant`."""
    keys = names(keys)
    found = _with_later(instants, keys, ts, pieces, [])
    value = F.col("_after") if dedupe_ties else F.col("_after") * F.col("_ties")
    return found.select(*keys, ts, F.round(value, 2).alias(out))


def timeline(
    df: DataFrame, keys, ts: str, fields: Iterable[str], *, pieces: tuple[str, ...] = PIECES, out: str = "position"
) -> DataFrame:
    """A key's timeline as rows: keys, ``ts``, fields, and the entry's place in the key's order
    of ``(ts, *fields)``, from 1. The form is the same whatever the length of a history; an array
    of all entries is ``collect_list`` over it where histories are known to be short."""
    keys, fields = names(keys), list(fields)
    entries = df.select(*keys, ts, *fields).withColumns(
        {"_one": F.lit(1).cast("long"), "_fine": F.date_trunc(pieces[-1], ts)}
    )
    before = _sums_before(entries, keys, ["_one"], pieces, later_first=False)
    inside = Window.partitionBy(*keys, "_fine").orderBy(ts, *fields)
    numbered = entries.withColumn("_row", F.row_number().over(inside))
    place = (F.col("_row") + F.col("_before__one")).alias(out)
    return numbered.join(before, [*keys, "_fine"]).select(*keys, ts, *fields, place)


def first_after(
    df: DataFrame, instants: DataFrame, key: str, ts: str, amount: str, outputs: dict[str, str]
) -> DataFrame:
    """:func:`first_after_of` over the rows per instant of ``df``."""
    return first_after_of(per_instant(df, key, ts, amount), instants, key, ts, outputs)


def first_after_of(
    entries: DataFrame, instants: DataFrame, key: str, ts: str, outputs: dict[str, str]
) -> DataFrame:
    """First timeline entry strictly after an instant of the same key.

    ``instants`` has one row per key; ``outputs`` maps a name to one of its
    timestamp columns. Gives ``<name>_at`` (when the entry is) and
    ``<name>_amount`` (its :func:`suffix_sum` value), NULL where nothing follows.

    An entry's suffix sum is the sum of everything after the instant, so this is a
    conditional aggregation: no array is built and nothing is sorted.
    """
    joined = entries.join(instants, key)
    aggregates = []
    for name, instant in outputs.items():
        later = F.when(F.col(ts) > F.col(instant), F.col(ts))
        aggregates += [
            F.min(later).alias(f"{name}_at"),
            F.sum(F.when(later.isNotNull(), F.col("_total"))).alias(f"_{name}_sum"),
            F.min_by("_ties", later).alias(f"_{name}_ties"),
        ]
    values = []
    for name in outputs:
        value = F.round(F.col(f"_{name}_sum") * F.col(f"_{name}_ties"), 2)
        values += [F.col(f"{name}_at"), value.alias(f"{name}_amount")]
    return joined.groupBy(key).agg(*aggregates).select(key, *values)

"""Mixing sources to target weights by a time-varying curriculum.

Each source has a weight and a schedule of that weight over training time 0..1. The total share
is dealt by weight; a source never gives more than ``most_repeats`` times its words, and what it
cannot give goes to the others. Inside a source the documents form a stream in the order of a hash
of their id, repeated if the target asks for it; the stream is read up to the target. The place of a
document in the stream, set against the integral of the schedule, gives its position in training; each
reading of a document has a position of its own.

Columns only: no Python code runs on rows. Prefix sums are taken inside (source, hash prefix) cells
and carried over by the cells' totals, so a hot source is as many cells as any other.

Defined cases: a null source is a source of its own, last in order; null, empty and blank texts have
size 0 and are never taken; equal ids keep both rows, the smaller size first; an empty table gives
an empty result; further columns are carried along only if ``keep`` names them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stagewise.llm.shared import read_table, written

WORD = r"[^\x20\x09-\x0D]+"

# Weights and share of the contract.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2

#: Relative weight at equally spaced times, by the same turns as the weights: the heaviest
#: sources early, the lightest late.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))


def position_sql(part: str, turn: str, schedules: Sequence[Sequence[float]] = SCHEDULES) -> str:
    """SQL for the time by which a source has given ``part`` (0..1) of its words: the inverse of
    the integral of its piecewise linear schedule."""
    turns = []
    for k, values in enumerate(schedules):
        if len(values) < 2 or min(values) <= 0:
            raise ValueError("a schedule needs two or more positive values")
        width = 1.0 / (len(values) - 1)
        areas = [(a + b) / 2 * width for a, b in zip(values, values[1:], strict=False)]
        total, done, arms = sum(areas), 0.0, []
        for m, (a, b, area) in enumerate(zip(values, values[1:], areas, strict=False)):
            rest = f"({part} * CAST({total!r} AS DOUBLE) - CAST({done!r} AS DOUBLE))"
            slope = 2.0 * (b - a) / width
            root = f"sqrt(CAST({a * a!r} AS DOUBLE) + CAST({slope!r} AS DOUBLE) * {rest})"
            time = f"CAST({m * width!r} AS DOUBLE) + 2 * {rest} / (CAST({a!r} AS DOUBLE) + {root})"
            done += area
            last = m == len(areas) - 1
            arms.append(f"ELSE {time}" if last else f"WHEN {part} * CAST({total!r} AS DOUBLE) < CAST({done!r} AS DOUBLE) THEN {time}")
        body = f"CASE {' '.join(arms)} END" if len(arms) > 1 else arms[0].removeprefix("ELSE ")
        turns.append(f"WHEN {turn} = {k} THEN {body}")
    return f"CASE {' '.join(turns)} END"


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most_repeats: int = MOST_REPEATS,
) -> DataFrame:
    """``source_key, source_size`` to targets: the level at which the sources that are not at
    their cap share what is left by weight. One row per source."""
    n = len(weights)
    turn = F.pmod(F.row_number().over(Window.orderBy("source_key")) - 1, F.lit(n))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    listed = sizes.select("source_key", "source_size", turn.alias("turn"), weight.alias("weight"))
    listed = listed.withColumn("cap", (F.col("source_size") * most_repeats).cast("double"))
    listed = listed.withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", "source_key").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy(F.lit(1))
    level = (
        F.sum("source_size").over(everywhere) * F.lit(share)
        - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    listed = listed.withColumn("level", level)
    listed = listed.withColumn("rank", F.row_number().over(Window.orderBy("ratio", "source_key")))
    open_from = F.min(F.when(F.col("level") <= F.col("ratio"), F.col("rank"))).over(everywhere)
    listed = listed.withColumn("open_from", open_from)
    at = F.min(F.when(F.col("rank") == F.col("open_from"), F.col("level"))).over(everywhere)
    capped = F.col("open_from").isNull() | (F.col("rank") < F.col("open_from"))
    return listed.select(
        "source_key",
        "source_size",
        "turn",
        F.when(capped, F.col("cap")).otherwise(at * F.col("weight")).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most_repeats: int = MOST_REPEATS,
    schedules: Sequence[Sequence[float]] = SCHEDULES,
    cell_digits: int = 3,
) -> DataFrame:
    """One row per document: ``size``, ``source_size``, ``target`` (of its source), ``taken``
    (words), ``copies`` (whole or cut by the target), ``position`` (training time of the first copy,
    null if not taken), ``start`` (words before it in its source's stream) and ``readings`` (for each
    copy its ``position`` and the words ``taken``), range-sorted by position. ``cell_digits``: hex digits of the hash that
    a cell of the prefix sums has; 16 cells a source for each."""
    if len(schedules) != len(weights):
        raise ValueError("one schedule for each weight")
    key = F.coalesce(F.concat(F.lit("a"), F.col(source)), F.lit("z"))
    mark = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    sized = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            key.alias("source_key"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            mark.alias("mark"),
        )
    ).withColumn("cell", F.substring("mark", 1, cell_digits))
    cells = sized.groupBy("source_key", "cell").agg(F.sum("size").alias("cell_size"))
    earlier = Window.partitionBy("source_key").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "source_key",
        "cell",
        F.coalesce(F.sum("cell_size").over(earlier), F.lit(0)).alias("cell_from"),
    )
    sizes = sized.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most_repeats)
    inside = (
        Window.partitionBy("source_key", "cell")
        .orderBy("mark", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        sized.join(cells, ["source_key", "cell"])
        .withColumn("from", F.col("cell_from") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(targets, "source_key")
        .withColumn("wanted", F.round("target").cast("long"))
    )
    takes = [
        F.least(F.col("size"), F.greatest(F.lit(0), F.col("wanted") - F.col("source_size") * k - F.col("from")))
        for k in range(most_repeats)
    ]
    placed = placed.withColumn("taken", sum(takes[1:], takes[0]).cast("long"))
    copies = [F.when(t > 0, 1).otherwise(0) for t in takes]
    readings = []
    for k, taken in enumerate(takes):
        begin = (F.col("from") + F.col("source_size") * k).cast("double")
        placed = placed.withColumn(f"part_{k}", F.try_divide(begin, F.col("target")))
        position = F.expr(position_sql(f"part_{k}", "turn", schedules))
        readings.append(F.when(taken > 0, F.struct(position.alias("position"), taken.cast("long").alias("taken"))))
    return placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        sum(copies[1:], copies[0]).cast("long").alias("copies"),
        F.when(F.col("taken") > 0, F.expr(position_sql("part_0", "turn", schedules))).alias("position"),
        F.col("from").cast("long").alias("start"),
        F.array_compact(F.array(*readings)).alias("readings"),
    ).orderBy("position", "doc_id")


def training_order(mixed: DataFrame) -> DataFrame:
    """The rows of :func:`mix_sources` with one row per reading (``reading`` from 0, its own ``position`` and ``taken``),
    range-sorted by position: the order of training."""
    others = [c for c in mixed.columns if c not in ("taken", "copies", "position", "readings")]
    return (
        mixed.select(*others, F.posexplode("readings").alias("reading", "one"))
        .select(*others, "reading", "one.position", "one.taken")
        .orderBy("position", "doc_id", "reading")
    )


def op3_mixing(spark, sf_dir):
    mixed = mix_sources(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.drop("start", "readings")  # the columns of the contract


def mixing_sql(documents: str = "documents") -> str:
    """The result of :func:`mix_sources` by one running sum over each source."""
    return f"""
WITH sized AS (
  SELECT doc_id, coalesce('a' || source, 'z') AS source_key,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS mark
  FROM {documents}
), sizes AS (
  SELECT source_key, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source_key) - 1) % 3 AS turn
  FROM sized GROUP BY source_key
), listed AS (
  SELECT *, CASE turn WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         (source_size * 2)::DOUBLE AS cap, cap / weight AS ratio FROM sizes
), levels AS (
  SELECT *, row_number() OVER w AS rank,
         ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - (sum(cap) OVER w - cap))
         / (sum(weight) OVER () - (sum(weight) OVER w - weight)) AS level
  FROM listed
  WINDOW w AS (ORDER BY ratio, source_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), opened AS (
  SELECT *, min(CASE WHEN level <= ratio THEN rank END) OVER () AS open_from FROM levels
), targets AS (
  SELECT source_key, source_size, turn,
         CASE WHEN open_from IS NULL OR rank < open_from THEN cap
              ELSE min(CASE WHEN rank = open_from THEN level END) OVER () * weight END AS target
  FROM opened
), placed AS (
  SELECT doc_id, size, source_size, target, turn, round(target)::BIGINT AS wanted,
         (sum(size) OVER (PARTITION BY source_key ORDER BY mark, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS start
  FROM sized JOIN targets USING (source_key)
), cut AS (
  SELECT *, least(size, greatest(0, wanted - start)) AS one,
         least(size, greatest(0, wanted - source_size - start)) AS two,
         start::DOUBLE / target AS part FROM placed
)
SELECT doc_id, size, source_size, target, (one + two)::BIGINT AS taken,
       ((one > 0)::INT + (two > 0)::INT)::BIGINT AS copies,
       CASE WHEN one + two > 0 THEN {position_sql("part", "turn")} END AS position
FROM cut"""

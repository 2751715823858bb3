"""Join shapes of the funnels. The only join hint is :func:`shuffled`, for sides that grow with the data;
the sizes of dimensions are Spark's to measure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.functions.columns import names


def shuffled(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the data: it meets the other side by an exchange. Before a job runs, Spark takes
    a table for as large as its compressed files, and what it takes for small is collected whole on the driver. Each task
    holds one partition of the side, so its rows must be one or few per key, or dealt by a part number."""
    return side.hint("shuffle_hash")


def enrich(base: DataFrame, other: DataFrame, on: str | list[str] | dict[str, str]) -> DataFrame:
    """Left join that keeps every base row. ``on`` may map base to other names;
    the other side's key columns are dropped in that case."""
    if not isinstance(on, dict):
        return base.join(other, names(on), "left")
    keyed = other.select(
        *[F.col(r).alias(f"_on_{left}") for left, r in on.items()],
        *[c for c in other.columns if c not in on.values()],
    )
    condition = reduce(lambda a, b: a & b, [F.col(left) == F.col(f"_on_{left}") for left in on])
    return base.join(keyed, condition, "left").drop(*[f"_on_{left}" for left in on])


def funnel_join(stages: list[DataFrame], keys: list[dict[str, str]]) -> DataFrame:
    """Left joins along a funnel; ``keys[i]`` maps stage ``i`` columns to stage
    ``i + 1`` columns. A stage that was not reached leaves its columns NULL, and
    several matches in a later stage give several rows.

    The chain is built from the last stage inwards. The rows are those of joining
    from the front, because every join condition is false on NULL, but no join
    ever sees the NULL keys of users who dropped out: joined from the front they
    would all hash to one partition. Where one key of a later stage may hold a large part
    of the rows, see :func:`split_left_join`.
    """
    result = stages[-1]
    for stage, on in zip(reversed(stages[:-1]), reversed(keys)):
        temporary = {f"_on_{r}": F.col(r) for r in on.values()}
        right = result.withColumns(temporary).drop(*[r for r in on.values() if r in on])
        result = stage.join(shuffled(right), _equal(on), "left").drop(*temporary)
    return result


def _equal(on: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_on_{r}") for k, r in on.items()])


#: Rows of one key of the later stage that one task joins.
ROWS_PER_PART = 100_000


def parts_of(right: DataFrame, keys: list[str], rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Distinct keys of a later stage, with the number of ``_parts`` its rows are dealt to."""
    parts = F.ceil(F.count(F.lit(1)) / rows_per_part).cast("int")
    return right.groupBy(*keys).agg(parts.alias("_parts"))


def split_left_join(
    left: DataFrame, right: DataFrame, on: dict[str, str], parts: DataFrame, spread: list[str]
) -> DataFrame:
    """Left join whose right side may hold many rows of one key. Adaptive execution splits a
    hot partition only on the preserved side of an outer join, so here the right side is dealt
    by a part number as well. ``parts`` (see :func:`parts_of`) has a row for each key of
    ``right``; ``right`` carries its ``_parts``, and ``spread`` names columns that tell its rows apart.

    A left row whose key is in ``parts`` goes to all parts of the key and keeps the rows it meets there;
    any other left row goes to one part and stays alone. Each input is read once.
    """
    keys = parts.select(*[F.col(r).alias(f"_on_{r}") for r in on.values()], "_parts")
    known = left.join(shuffled(keys), _equal(on), "left").drop(*[f"_on_{r}" for r in on.values()])
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    dealt = known.withColumn("_part", F.explode(copies))
    number = F.pmod(F.xxhash64(*spread), F.col("_parts").cast("long")).cast("int")
    numbered = right.withColumn("_on__part", number).drop("_parts")
    numbered = numbered.withColumns({f"_on_{r}": F.col(r) for r in on.values()}).drop(
        *[r for r in on.values() if r in left.columns]
    )
    numbered = numbered.withColumn("_met", F.lit(True))
    joined = dealt.join(shuffled(numbered), _equal({**on, "_part": "_part"}), "left")
    kept = joined.where(F.col("_parts").isNull() | F.col("_met"))
    return kept.drop("_parts", "_part", "_met", "_on__part", *[f"_on_{r}" for r in on.values()])


def flag_member(base: DataFrame, members: DataFrame, on: str, name: str) -> DataFrame:
    """Adds ``name`` = 1 where ``on`` occurs in ``members`` and 0 elsewhere."""
    keys = members.select(on).where(F.col(on).isNotNull()).dropDuplicates([on])
    flagged = base.join(keys.withColumn(name, F.lit(1)), on, "left")
    return flagged.withColumn(name, F.coalesce(name, F.lit(0)))


def union_distinct(*frames: DataFrame) -> DataFrame:
    """SQL ``UNION`` by column name. Types must agree: cast codes to string first."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stagewise.operators.intervals import latest_covering, latest_valid

BASE = datetime(2024, 1, 1)


def _instant(rng):
    return BASE + timedelta(
        seconds=rng.choice([0, 1, 60, 3600, rng.randrange(259200)]),
        microseconds=rng.choice([0, 1, 999999, 500000, rng.randrange(10**6)]),
    )


@pytest.fixture(scope="module")
def drawn():
    rng = random.Random(5)
    periods = []
    for i in range(300):
        start, end = sorted([_instant(rng), _instant(rng)])
        kind = rng.random()
        if kind < 0.2:
            start = end
        elif kind < 0.3:
            end = datetime(9999, 12, 31)
        elif kind < 0.4:
            start = datetime(1950, 1, 1)
        elif kind < 0.45:
            start, end = end, start
        periods.append((rng.choice(["u1", "u1", "u2", "u3"]), start, end, f"team{i % 5}"))
    points = [(i, rng.choice(["u1", "u2", "u3", "u9", None]), _instant(rng)) for i in range(200)]
    points += [(1000 + i, u, s) for i, (u, s, _, _) in enumerate(periods)]
    points += [(2000 + i, u, e) for i, (u, _, e, _) in enumerate(periods)]
    return points, periods


WITHIN = {}, {"within": ("2023-12-31 00:00:00", "2024-01-05 23:59:59")}


@pytest.mark.parametrize("options", WITHIN)
def test_latest_covering_equals_brute_force(spark, drawn, options):
    points, periods = drawn
    points = points + points[:50]  # equal points keep all their rows
    p = spark.createDataFrame(points, "id int, u string, at timestamp")
    v = spark.createDataFrame(periods, "u string, s timestamp, e timestamp, team string")
    found = latest_covering(p, v, "u", "at", "s", "e", ["team"], **options)
    got = sorted((r.id, str(r.s), str(r.team)) for r in found.collect())
    want = []
    for i, user, at in points:
        held = [(s, team) for (u, s, e, team) in periods if u == user and s <= at <= e]
        if options and not datetime(2023, 12, 31) <= at <= datetime(2024, 1, 5, 23, 59, 59, 999999):
            held = []
        start, team = max(held) if held else (None, None)
        want.append((i, str(start), str(team)))
    assert got == sorted(want)


def test_building_the_plan_reads_nothing(spark, drawn, plan_of):
    points, periods = drawn
    p = spark.createDataFrame(points, "id int, u string, at timestamp")
    v = spark.createDataFrame(periods, "u string, s timestamp, e timestamp, team string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "")
    found = latest_covering(p, v, "u", "at", "s", "e", ["team"])
    plan = plan_of(found)
    assert list(tracker.getJobIdsForGroup("planning")) == []
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    spark.sparkContext.setJobGroup("other", "")


def test_latest_version_valid_in_period(spark):
    rows = [("a", 1, 5, "old"), ("a", 3, 9, "new"), ("a", 12, 20, "later"), ("b", 1, 2, "gone"), ("c", 10, 10, "edge")]
    df = spark.createDataFrame(rows, "k string, s int, e int, v string")
    got = latest_valid(df, "k", "s", "e", F.lit(4), F.lit(10), ["v"])
    assert sorted((r.k, r.v) for r in got.collect()) == [("a", "new"), ("c", "edge")]


def test_one_key_with_a_million_periods(spark, plan_of):
    """A key with a million periods (each 100 s, begun every 30 s) over a year, and points a second after every 50th begins."""
    n = 1_000_000
    begin = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 30)
    periods = spark.range(n).select(
        F.lit("hot").alias("u"), begin.alias("s"), (begin + F.expr("INTERVAL 100 SECONDS")).alias("e"), F.col("id").alias("team")
    )
    points = spark.range(0, n, 50).select("id", F.lit("hot").alias("u"), (begin + F.expr("INTERVAL 1 SECOND")).alias("at"))
    found = latest_covering(points, periods, "u", "at", "s", "e", ["team"])
    row = found.agg(F.count(F.lit(1)), F.count(F.when(F.col("team") == F.col("id"), 1))).first()
    assert tuple(row) == (n // 50, n // 50)


def test_a_point_is_one_row_in_the_exchange(spark, drawn, plan_of):
    """Only cells are looked up row by row; the points themselves meet their cell once, with all their columns."""
    points, periods = drawn
    p = spark.createDataFrame(points, "id int, u string, at timestamp")
    v = spark.createDataFrame(periods, "u string, s timestamp, e timestamp, team string")
    found = latest_covering(p, v, "u", "at", "s", "e", ["team"])
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LogicalRDD") == 3, "points twice (cells, rows), periods once"
    for line in text.splitlines():
        assert "Generate" not in line or "id#" not in line

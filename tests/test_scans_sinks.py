import base64
import csv
import io
import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stagewise.functions.dates import within_days
from stagewise.sources import adhoc, scans, sinks


@pytest.fixture(scope="module")
def event_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables") / "events")
    rows = [
        (f"u{i % 7}", i, ["click", "get", "dev"][i % 3], "k", day)
        for i in range(60)
        for day in (20240130, 20240131, 20240201, 20240202)
    ]
    df = spark.createDataFrame(rows, "u_user string, event_time long, event_type string, event_key string, day int")
    df.write.partitionBy("day").parquet(path)
    return spark.read.parquet(path)


def test_event_scan_prunes_partitions_columns_and_rows(event_table, plan_of):
    got = scans.scan_events(event_table, 20240131, 20240201, ["click"], ["k"], ["u_user", "day"])
    plan = plan_of(got)
    assert "PartitionFilters: [isnotnull(day" in plan and "day#" in plan.split("PartitionFilters")[1]
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(event_key), EqualTo(event_type,click), EqualTo(event_key,k)]" in plan
    assert "ReadSchema: struct<u_user:string,event_type:string,event_key:string>" in plan
    assert got.count() == 40


def test_month_scan_is_a_range_on_the_partition(event_table, plan_of):
    month = scans.scan_month(event_table, 202401)
    assert {r.day for r in month.select("day").distinct().collect()} == {20240130, 20240131}
    assert "(day" in plan_of(month).split("PartitionFilters")[1].split("]")[0]
    to_date = scans.scan_month_to_date(event_table, 20240201)
    assert {r.day for r in to_date.select("day").distinct().collect()} == {20240201}


def test_time_range_reaches_the_files(spark, plan_of):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = plan_of(events.where(within_days("ts", 20240110, 20240111)))
    assert "GreaterThanOrEqual(ts,2024-01-10T00:00" in plan and "LessThan(ts,2024-01-12T00:00" in plan


def test_order_filters_drop_missing_values(spark):
    schema = "id int, is_test boolean, in_salary int, worker_id int, workplace_id int, regiment_id int, pay_time timestamp_ntz"
    from datetime import datetime

    at = datetime(2024, 1, 5)
    rows = [
        (1, False, 1, 7, 4, 9, at), (2, True, 1, 7, 4, 9, at), (3, False, 0, 7, 4, 9, at), (4, False, 1, 0, 4, 9, at),
        (5, None, 1, 7, 4, 9, at), (6, False, 1, 7, 5, 9, at), (7, False, 1, 7, 4, 303, at), (8, False, 1, 7, 4, None, at),
        (9, False, 1, 7, 702, 1, datetime(2024, 2, 1)),
    ]
    orders = spark.createDataFrame(rows, schema)
    assert sorted(r.id for r in scans.eligible_orders(orders).collect()) == [1, 6, 7, 8, 9]
    team = scans.eligible_team_orders(orders, 20240101, 20240131)
    assert sorted(r.id for r in team.collect()) == [1, 2, 5]


def test_guarded_scan_refuses_what_the_rules_forbid(event_table):
    good = dict(start=20240130, end=20240201, event_types=["click"], columns=["u_user", "day"])
    assert scans.guarded_scan(event_table, **good).count() == 60
    for bad in (
        {"event_types": []}, {"event_types": ["purchase"]}, {"columns": ["*"]}, {"columns": []},
        {"end": 20240206}, {"end": 20240129}, {"limit": 0},
    ):
        with pytest.raises(ValueError):
            scans.guarded_scan(event_table, **{**good, **bad})


def test_nothing_is_cut_unless_asked_for(spark):
    many = spark.range(150_000).selectExpr("cast(id as string) u_user", "20240130 day", "'click' event_type")
    adhoc.register_tables(spark, {"many": many})
    assert adhoc.run_sql(spark, "select * from many").count() == 150_000
    kept = scans.guarded_scan(many, 20240130, 20240130, ["click"], ["u_user", "day"])
    assert kept.count() == 150_000 and scans.guarded_scan(many, 20240130, 20240130, ["click"], ["u_user"], limit=7).count() == 7


def test_adhoc_sql_takes_a_limit(spark, event_table):
    adhoc.register_tables(spark, {"front": event_table})
    assert adhoc.run_sql(spark, "select day, count(*) n from front group by day;").count() == 4
    assert adhoc.run_sql(spark, "select * from front", limit=5).count() == 5


def _days(spark, path):
    rows = spark.read.parquet(path).collect()
    return sorted((r.day, r.x) for r in rows)


def test_writing_days_replaces_exactly_those_days(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, 20240101), (2, 20240102), (3, 20240103)], "x int, day int")
    sinks.write_days(first, path, [20240101, 20240102, 20240103])
    again = spark.createDataFrame([(9, 20240102)], "x int, day int")
    sinks.write_days(again, path, [20240102, 20240103])
    assert _days(spark, path) == [(20240101, 1), (20240102, 9)]
    stray = spark.createDataFrame([(5, 20240102), (8, 20240109)], "x int, day int")
    with pytest.raises(ValueError, match="20240109"):
        sinks.write_days(stray, path, [20240102, 20240103])
    failing = spark.createDataFrame([(0, 20240102)], "x int, day int").selectExpr("1 / x AS x", "day")
    with pytest.raises(Exception):  # noqa: B017
        sinks.write_days(failing, path, [20240101, 20240102])
    assert _days(spark, path) == [(20240101, 1), (20240102, 9)]
    assert not [d for d in os.listdir(path) if "staging" in d]


def test_writing_days_of_a_table(spark):
    spark.sql("CREATE TABLE day_rows (x INT, y STRING, day INT) USING parquet PARTITIONED BY (day)")
    try:
        first = spark.createDataFrame([("a", 1, 20240101), ("b", 2, 20240102), ("c", 3, 20240103)], "y string, x int, day int")
        sinks.write_days(first, "day_rows", [20240101, 20240102, 20240103])
        again = spark.createDataFrame([("d", 9, 20240102)], "y string, x int, day int")
        sinks.write_days(again, "day_rows", [20240102, 20240103])
        got = sorted((r.day, r.x, r.y) for r in spark.table("day_rows").collect())
        assert got == [(20240101, 1, "a"), (20240102, 9, "d")]
    finally:
        spark.sql("DROP TABLE day_rows")


def test_writing_one_partition_keeps_the_others_even_when_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1,), (2,)], "x int")
    sinks.write_partition(df, path, {"month": 202401})
    sinks.write_partition(df, path, {"month": 202402})
    sinks.write_partition(df.where("x > 5"), path, {"month": 202401})
    assert [(r.month, r.x) for r in spark.read.parquet(path).orderBy("x").collect()] == [(202402, 1), (202402, 2)]


def test_writing_one_partition_of_a_table_matches_names(spark):
    spark.sql("CREATE TABLE pool_months (x INT, y STRING, month INT) USING parquet PARTITIONED BY (month)")
    try:
        for month in (202401, 202402):
            df = spark.createDataFrame([("a", month % 100)], "y string, x int")
            sinks.write_table_partition(df, "pool_months", {"month": month})
        sinks.write_table_partition(spark.createDataFrame([("b", 7)], "y string, x int"), "pool_months", {"month": 202401})
        got = spark.table("pool_months").orderBy("month").collect()
        assert [(r.month, r.x, r.y) for r in got] == [(202401, 7, "b"), (202402, 2, "a")]
    finally:
        spark.sql("DROP TABLE pool_months")


def test_delivery_by_size(spark, tmp_path):
    path = str(tmp_path / "out")
    numbers = spark.range(100).select(F.col("id").cast("int").alias("n"))
    assert sinks.deliver(numbers.where("n < 0"), path).kind == "empty"
    inline = sinks.deliver(numbers.where("n < 20"), path)
    assert (inline.kind, inline.rows) == ("inline", 20) and inline.text.splitlines()[:2] == ["n", "0"]
    assert not os.path.exists(path)
    filed = sinks.deliver(numbers.where("n < 21"), path)
    assert (filed.kind, filed.rows) == ("file", 21)
    assert spark.read.csv(path, header=True).count() == 21


def test_delivery_keeps_every_value(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [
        (k, f'first "line" {k}\nsecond\tline, {k}', datetime(2024, 1, 2, 3, 4, 5, 123456 + k), None) for k in range(30)
    ]
    df = spark.createDataFrame(rows, "n int, body string, at timestamp, gap void").repartition(4).orderBy(F.desc("n"))
    inline = sinks.deliver(df.where("n < 7"), path)
    got = list(csv.reader(io.StringIO(inline.text), delimiter="\t"))
    assert (inline.kind, inline.rows) == ("inline", 7) and got[0] == ["n", "body", "at", "gap"]
    assert [(int(n), body, at[:26], gap) for n, body, at, gap in got[1:]] == [
        (k, body, f"{at:%Y-%m-%d %H:%M:%S.%f}", "") for k, body, at, _ in reversed(rows[:7])
    ]
    filed = sinks.deliver(df, path)
    back = spark.read.schema("n int, body string, at timestamp, gap string").csv(path, header=True, multiLine=True)
    assert filed.rows == 30 and sorted(map(tuple, back.collect())) == rows
    assert os.listdir(tmp_path) == ["out"]


def test_delivery_keeps_order_and_types_without_a_sort(spark, tmp_path):
    path = str(tmp_path / "out")
    values = [(k, Decimal(k) / 8, date(2024, 1, 1 + k % 9), k / 3, " a ", "", None, ["x", None], bytes([k])) for k in range(90)]
    schema = "n int, d decimal(10,3), at date, share double, edge string, blank string, gap string, list array<string>, raw binary"
    df = spark.createDataFrame(values, schema).repartition(7).orderBy(F.desc("n"))
    inline = sinks.deliver(df.where("n < 9"), path)
    got = list(csv.reader(io.StringIO(inline.text), delimiter="\t"))
    assert [int(r[0]) for r in got[1:]] == list(range(8, -1, -1))
    assert [(Decimal(r[1]), float(r[3]), r[4], r[7]) for r in got[1:]] == [(v[1], v[3], " a ", '["x",null]') for v in reversed(values[:9])]
    filed = sinks.deliver(df, path)
    rows = [r for name in sinks.ordered_files(spark, path) for r in csv.reader(open(name)) if r[0] != "n"]
    assert filed.rows == 90 and [int(r[0]) for r in rows] == list(range(89, -1, -1))
    assert rows[0][-1] == base64.b64encode(bytes([89])).decode()
    # A failing plan leaves the delivery before it alone; a later one takes its place.
    with pytest.raises(Exception):  # noqa: B017
        sinks.deliver(df.select(F.raise_error(F.lit("no")).alias("n")), path)
    assert spark.read.options(**sinks.CSV).csv(path).count() == 90
    assert sinks.deliver(df.where("n >= 30"), path).rows == 60
    assert spark.read.options(**sinks.CSV).csv(path).count() == 60 and os.listdir(tmp_path) == ["out"]

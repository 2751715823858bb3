from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stagewise.functions.columns import comma_items, not_blank
from stagewise.operators import convert, joins, rank, rollup, timeline


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_first_and_latest_rows_settle_ties(spark, plan_of):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("a", 2, "w"), ("b", None, "n"), ("b", 5, "m"), (None, 1, "q")],
        "k string, t int, v string",
    )
    assert rows(rank.first_by(df, "k", "t", ["v"])) == [(None, 1, "q"), ("a", 1, "y"), ("b", None, "n")]
    assert rows(rank.latest_by(df, "k", "t", ["v"])) == [(None, 1, "q"), ("a", 2, "w"), ("b", 5, "m")]
    both = rank.first_and_latest_by(df, "k", ["t", "v"], ["v"], ["v"])
    assert rows(both) == [(None, "q", "q"), ("a", "y", "x"), ("b", "n", "m")]
    assert rows(rank.last_n_by(df, "k", "t", 2, ["v"])) == [
        (None, 1, "q"), ("a", 2, "w"), ("a", 2, "x"), ("b", None, "n"), ("b", 5, "m"),
    ]
    assert plan_of(rank.last_n_by(df, "k", "t", 12)).count("WindowGroupLimit") == 2


def test_rollup_family(spark):
    df = spark.createDataFrame(
        [("a", 3, "x"), ("a", 1, None), ("a", 3, "y"), ("b", 0, None)], "k string, n int, s string"
    )
    got = df.groupBy("k").agg(
        rollup.distinct_sorted(F.when(F.col("n") > 0, F.col("n"))).alias("set"),
        rollup.has_value("s", "x").alias("has"),
        rollup.max_when(F.col("s").isNotNull(), F.col("n")).alias("hi"),
        rollup.min_when(F.col("n") > 1, F.col("s")).alias("lo"),
    )
    assert rows(got, "k") == [("a", [1, 3], True, 3, "x"), ("b", None, False, None, None)]
    assert rows(rollup.collapse_max(df, "k", ["n", "s"])) == [("a", 3, "y"), ("b", 0, None)]
    assert rows(rollup.distinct_keys(df, ["k", "n"])) == [("a", 1), ("a", 3), ("b", 0)]


def test_comma_items_and_blanks(spark):
    df = spark.createDataFrame([(None,), ([],), ([""],), (["a, b", "c"],)], "l array<string>")
    assert [r.x for r in df.select(comma_items("l").alias("x")).collect()] == [None, None, [""], ["a", " b"]]
    words = spark.createDataFrame([(None,), ("",), ("undefined",), ("x",)], "w string")
    assert [r.w for r in words.where(not_blank("w", "undefined")).collect()] == ["x"]
    assert [r.w for r in words.where(not_blank("w")).collect()] == ["undefined", "x"]


def test_funnel_join_equals_joining_from_the_front(spark):
    a = spark.createDataFrame([("u1", 1), ("u2", 1), (None, 1), ("u3", 2)], "a string, n int")
    b = spark.createDataFrame([("u1", 1), ("u1", 1), ("u3", 1), (None, 1)], "b string, bn int")
    c = spark.createDataFrame([("u1", "p"), ("u1", "q"), ("u3", "r"), (None, "s")], "c string, v string")
    got = joins.funnel_join([a, b, c], [{"a": "b", "n": "bn"}, {"b": "c"}])
    front = a.join(b, (F.col("a") == F.col("b")) & (F.col("n") == F.col("bn")), "left").join(
        c, F.col("b") == F.col("c"), "left"
    )
    assert sorted(map(str, got.select(*front.columns).collect())) == sorted(map(str, front.collect()))
    assert got.count() == 7


@pytest.mark.parametrize("rows_per_part", [1, 2, 100])
def test_split_left_join_equals_a_left_join(spark, rows_per_part):
    left = spark.createDataFrame([("u1", 1), ("u1", 2), ("u2", 3), (None, 4), ("u2", 3)], "a string, n int")
    right = spark.createDataFrame([("u1", i) for i in range(5)] + [("u3", 9), (None, 8)], "b string, v int")
    parts = joins.parts_of(right.where("b is not null"), ["b"], rows_per_part)
    dealt = right.join(parts, "b")
    got = joins.split_left_join(left, dealt, {"a": "b"}, parts, ["v"]).select("a", "n", "b", "v")
    want = left.join(right, F.col("a") == F.col("b"), "left")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_flags_enrichment_and_union(spark):
    base = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    members = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(joins.flag_member(base, members, "k", "f"), "k") == [(None, 0), (1, 1), (2, 0)]
    other = spark.createDataFrame([(1, "x")], "r int, v string")
    assert rows(joins.enrich(base, other, {"k": "r"}), "k") == [(None, None), (1, "x"), (2, None)]
    assert rows(joins.union_distinct(base, members, base), "k") == [(None,), (1,), (2,)]


def _orders(spark, dates):
    data = [("u", datetime.fromisoformat(d), 10.0) for d in dates]
    return spark.createDataFrame(data, "user string, paid timestamp_ntz, amount double")


def test_conversion_windows_include_both_ends(spark):
    orders = _orders(spark, ["2024-01-27 09:00", "2024-02-03 23:59", "2024-02-04 00:00", "2024-01-31 12:00", "2024-02-10 00:00"])
    windows = {"7d": 7, "14d": 14, "month": convert.MONTH_END}
    got = convert.conversions(orders, "user", "paid", "amount", 20240127, 20240127, windows)
    assert rows(got) == [("u", 20240127, 3, 30.0, 5, 50.0, 2, 20.0)]
    wide = {r.day: r for r in convert.conversions(orders, "user", "paid", "amount", 20240101, 20240210, windows).collect()}
    # A month window starts at its anchor and never leaves the month.
    assert (wide[20240101].paid_month_order_cnt, wide[20240101].paid_7d_order_cnt) == (2, None)
    assert wide[20240201].paid_month_order_cnt == 3 and wide[20240204].paid_7d_order_cnt == 2
    assert wide[20240205].paid_14d_amount == 10.0 and 20240211 not in wide


def test_conversions_for_many_days_equal_one_day_runs(spark):
    orders = _orders(spark, [f"2024-01-{d:02d} 10:00" for d in (1, 1, 9, 15, 20, 30)] + ["2024-02-11 01:00"])
    windows = {"7d": 7, "14d": 14, "month": convert.MONTH_END}
    together = convert.conversions(orders, "user", "paid", "amount", 20240110, 20240131, windows)
    alone = []
    for day in (20240110, 20240116, 20240131):
        alone += rows(convert.conversions(orders, "user", "paid", "amount", day, day, windows))
    assert [r for r in rows(together, "day") if r[1] in (20240110, 20240116, 20240131)] == alone


def _payments(spark):
    t = [datetime(2024, 1, 1), datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 30), datetime(2024, 1, 2), datetime(2024, 1, 2), datetime(2024, 3, 1)]
    data = [("a", x, float(i + 1)) for i, x in enumerate(t)] + [("b", t[0], None), ("b", t[3], -2.0), ("c", None, 5.0), (None, t[0], 9.0)]
    return spark.createDataFrame(data, "u string, t timestamp_ntz, m double")


def _self_join(spark, df):
    df.createOrReplaceTempView("payments")
    return spark.sql(
        """SELECT x.u, x.t, round(sum(y.m), 2) AS amount_after FROM payments x
           JOIN payments y ON x.u = y.u AND y.t >= x.t GROUP BY x.u, x.t"""
    )


def test_suffix_sum_equals_the_self_join(spark):
    df = _payments(spark)
    for pieces in (("day", "minute"), ("month", "hour"), ("year", "second")):
        assert rows(timeline.suffix_sum(df, "u", "t", "m", pieces=pieces)) == rows(_self_join(spark, df))
    clean = timeline.suffix_sum(df, "u", "t", "m", dedupe_ties=True)
    assert [r[2] for r in rows(clean)] == [21.0, 18.0, 15.0, 6.0, -2.0, -2.0]


def test_suffix_sum_equals_the_self_join_on_given_orders(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(
        F.col("o_custkey").alias("u"), F.col("o_orderdate").alias("t"), F.col("o_totalprice").alias("m")
    )
    got, want = timeline.suffix_sum(orders, "u", "t", "m", pieces=("year", "month")), _self_join(spark, orders)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_timeline_places_every_entry(spark):
    df = _payments(spark).where("t is not null and u is not null")
    got = [(r.u, r.position, r.m) for r in timeline.timeline(df, "u", "t", ["m"]).orderBy("u", "position").collect()]
    assert got == [("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, 3.0), ("a", 4, 4.0), ("a", 5, 5.0), ("a", 6, 6.0), ("b", 1, None), ("b", 2, -2.0)]


def test_a_long_day_of_one_user_keeps_its_form(spark):
    """25,000 entries of one user inside one hour: one row each, in order, summed right."""
    df = spark.range(25_000).select(
        F.lit("u").alias("u"), F.expr("timestamp'2024-01-01 10:00:00' + make_dt_interval(0, 0, 0, id * 0.1)").alias("t"), F.lit(1.0).alias("m")
    )
    after = timeline.suffix_sum(df, "u", "t", "m")
    line = timeline.timeline(after, "u", "t", ["amount_after"])
    assert line.count() == 25_000
    assert line.where("amount_after + position <> 25001").count() == 0


def test_orders_are_read_once(spark, plan_of, tmp_path):
    path = str(tmp_path / "orders")
    _payments(spark).write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(timeline.suffix_sum(spark.read.parquet(path), "u", "t", "m"), final=True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "83886080")
    assert plan.count("FileScan parquet") == 1


def test_first_after_is_strict_and_counts_ties(spark):
    instants = spark.createDataFrame(
        [("a", datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 30), None), ("b", datetime(2024, 1, 2), None, None)],
        "u string, x timestamp_ntz, y timestamp_ntz, z timestamp_ntz",
    )
    got = timeline.first_after(_payments(spark), instants, "u", "t", "m", {"x": "x", "y": "y", "z": "z"})
    a, b = got.orderBy("u").collect()
    assert (a.x_at, a.x_amount) == (datetime(2024, 1, 1, 0, 30), 18.0)
    assert (a.y_at, a.y_amount) == (datetime(2024, 1, 2), 30.0)  # two rows at that instant
    assert a.z_at is None and a.z_amount is None and b.x_amount is None


def test_first_after_equals_looking_up_the_timeline(spark):
    df = _payments(spark).where("u = 'a'")
    entries = sorted((r.t, r.amount_after) for r in timeline.suffix_sum(df, "u", "t", "m").collect())
    for instant in [t for t, _ in entries] + [datetime(2023, 1, 1), datetime(2024, 2, 1)]:
        at = spark.createDataFrame([("a", instant)], "u string, x timestamp_ntz")
        row = timeline.first_after(df, at, "u", "t", "m", {"x": "x"}).first()
        later = [v for t, v in entries if t > instant]
        assert row.x_amount == (later[0] if later else None)


def test_date_type_survives(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),)], "d date")
    assert rank.first_by(df, "d", "d").first().d == date(2024, 1, 1)


def test_paid_timeline_is_amount_and_place_in_one_pass(spark, tmp_path, plan_of):
    df = _payments(spark)
    line = timeline.timeline(timeline.suffix_sum(df, "u", "t", "m"), "u", "t", ["amount_after"])
    for pieces in (timeline.PIECES, ("day",), ("year", "day", "millisecond")):
        got = timeline.paid_timeline(df, "u", "t", "m", pieces=pieces)
        assert rows(got.select(*line.columns)) == rows(line)
    df.write.parquet(f"{tmp_path}/paid")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(timeline.paid_timeline(spark.read.parquet(f"{tmp_path}/paid"), "u", "t", "m"), final=True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "83886080")
    assert plan.count("FileScan") == 1, "all readers share the exchange of the rows per instant"


def test_a_user_with_all_rows_in_one_minute_is_split(spark):
    """200,000 payments of one user within a minute, 300 microseconds apart: no task orders more than a millisecond's or a minute's pieces."""
    n = 200_000
    at = F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 300)
    df = spark.range(n).select(F.lit("u").alias("u"), at.alias("t"), F.lit(1.0).alias("m"), "id")
    found = timeline.paid_timeline(df, "u", "t", "m", pieces=("day", "minute", "millisecond"))
    off = found.join(df, ["u", "t"]).where((F.col("amount_after") != n - F.col("id")) | (F.col("position") != F.col("id") + 1))
    assert found.count() == n and off.isEmpty()

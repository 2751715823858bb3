from datetime import date, datetime

from pyspark.sql import functions as F

from stagewise.plans import pool
from stagewise.plans.jobs import run_month_pool, run_paid_pool


def at(text):
    return datetime.fromisoformat(text)


def _pool_days(spark):
    columns = ["active_u_user", "day", *pool.LATEST_COLUMNS, *pool.FIRST_COLUMNS, *pool.ROLLED_UP]
    numeric = {"day", "before_sum_amount", "push_cnt", "datepool_cnt", "all_user_clue_cnt", "all_add_wechat_cnt", "regist_duration"}
    schema = ", ".join(f"{c} {'int' if c in numeric else 'string'}" for c in columns)
    base = {c: None for c in columns}
    rows = [
        base | dict(active_u_user="u", day=20240103, grade="first", user_allocation="first", push_cnt=1, regist_duration=5, all_user_clue_cnt=9, before_sum_amount=1),
        base | dict(active_u_user="u", day=20240120, grade="last", user_allocation="last", push_cnt=2, regist_duration=3, all_user_clue_cnt=4, push_u_user="u"),
        base | dict(active_u_user="u", day=20240201, grade="next month", push_cnt=50),
        base | dict(active_u_user=None, day=20240105, grade="lost", push_cnt=7),
        base | dict(active_u_user="w", day=20240131, grade="w"),
    ]
    return spark.createDataFrame([tuple(r.values()) for r in rows], schema)


def _month_inputs(spark):
    denials = spark.createDataFrame(
        [("u", "later", 2, at("2024-01-09 00:00"), 20240109), ("u", None, None, at("2024-01-08 00:00"), 20240108), ("u", "x", 2, at("2024-01-10 00:00"), 20240110),
         ("u", "x", 1, at("2024-01-11 00:00"), 20240111), ("u", "x", 7, at("2024-02-11 00:00"), 20240211), ("w", "zero", 0, at("2024-01-11 00:00"), 20240111)],
        "user_id string, deny_reason string, deny_index int, created_at timestamp, day int",
    )
    allocations = spark.createDataFrame(
        [("u", "other", 20240101), ("u", "mid_school", 20240131), ("w", None, 20240102)], "user_id string, clue_source string, day int"
    )
    return _pool_days(spark), denials, allocations


def test_month_pool(spark):
    got = pool.month_pool(*_month_inputs(spark), 202401)
    assert got.columns == pool.MONTH_POOL_COLUMNS and len(got.columns) == 42
    rows = {r.active_u_user: r for r in got.collect()}
    u = rows["u"]
    assert (u.grade, u.user_allocation, u.push_cnt, u.regist_duration, u.all_user_clue_cnt, u.before_sum_amount) == ("last", "first", 3, 3, 9, 1)
    assert (u.push_u_user, u.first_deny_reason, u.first_deny_index, u.deny_index_reason_arr) == ("u", "", 0, [1, 2])
    assert (u.recieve_u_user, u.recieve_u_user_all) == ("u", "u")
    w = rows["w"]
    assert (w.first_deny_reason, w.first_deny_index, w.deny_index_reason_arr) == ("zero", 0, None)
    assert (w.recieve_u_user, w.recieve_u_user_all) == (None, "w")
    # The missing user is rolled up but has no snapshot.
    assert (rows[None].push_cnt, rows[None].grade) == (7, None)


def test_month_pool_reads_each_table_once(spark, plan_of, tmp_path):
    paths = []
    for i, df in enumerate(_month_inputs(spark)):
        paths.append(str(tmp_path / str(i)))
        df.write.partitionBy("day").parquet(paths[-1])
    plan = plan_of(pool.month_pool(*[spark.read.parquet(p) for p in paths], 202401))
    assert plan.count("FileScan") == 3 and plan.count("(day") >= 3


def _paid_tables(spark):
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    order = lambda u, t, a, **o: (u, at(t), a, o.get("place", 4), 1, 1, 1)
    status = ", ".join(f"{c} string" for c in pool.PAY_STATUS_COLUMNS)
    none = [None] * (len(pool.PAY_STATUS_COLUMNS) - 1)
    return pool.PaidPoolTables(
        orders=df(
            [order("u", "2024-01-05 10:00:00", 10.0), order("u", "2024-01-06 10:00:00", 20.0), order("u", "2024-01-06 10:00:00", 5.0),
             order("u", "2024-01-07 10:00:00", 1.0), order("u", "2024-01-08 10:00:00", 100.0, place=9), order("v", "2024-01-05 10:00:00", 3.0)],
            "user_id string, pay_time timestamp, amount double, workplace_id int, regiment_id int, worker_id int, in_salary int",
        ),
        pay_status=df([(1, 20240103, "early", *none), (1, 20240104, "late", *none), (2, 20240103, "v", *none), (3, 20240103, "idle", *none)], f"user_sk int, day int, {status}"),
        activity=df([(1, "u", "al", 20240104), (1, "u", "later", 20240105), (2, "v", None, 20240103), (4, "x", None, 20240103)], "user_sk int, u_user string, user_allocation string, day int"),
        clues=df(
            [("u", 1, at("2024-01-05 10:00:00"), 20240105, at("2024-01-09 00:00:00"), "mid_school"), ("u", 1, at("2024-01-04 00:00:00"), 20240104, at("2024-01-04 00:00:00"), "other"),
             ("u", 1, at("2024-01-04 00:00:00"), 20240104, at("2024-01-20 00:00:00"), "other"), ("v", 2, at("2024-01-04 00:00:00"), 20240104, at("2024-01-20 00:00:00"), "other")],
            "user_id string, user_sk int, created_at timestamp, created_sk int, clue_expire_time timestamp, clue_source string",
        ),
        pushes=df([("u", "r", 1, at("2024-01-02 00:00:00"), 20240102), ("v", "second", 2, at("2024-01-04 00:00:00"), 20240104), ("v", "first", 1, at("2024-01-03 00:00:00"), 20240103)],
                  "user_id string, deny_reason string, deny_index int, created_at timestamp, day int"),
        produced=df([("u", 20240110), ("u", 20240111), ("z", 20240111)], "userid string, day int"),
    )


def test_paid_pool(spark):
    got = pool.paid_pool(_paid_tables(spark), 20240115)
    assert got.columns == pool.PAID_POOL_COLUMNS and len(got.columns) == 24
    rows = {r.active_u_user: r for r in got.collect()}
    assert sorted(rows) == ["u", "v"] and got.count() == 2
    u, v = rows["u"], rows["v"]
    assert (u.active_first_date_month, u.grade_name_month, u.user_allocation_month) == (date(2024, 1, 4), "early", "al")
    assert (u.is_tele_belong_first_month, v.is_tele_belong_first_month) == (1, 0)
    assert (u.push_u_user, u.enter_datapool_u_user, u.recieve_u_user, u.recieve_u_user_all) == ("u", "u", "u", "u")
    # Paid at the very moment of receiving does not count; two payments at one instant count twice.
    assert (u.recieve_paid_u_user, u.recieve_paid_amount) == ("u", 52.0)
    assert (u.recieve_all_paid_u_user, u.recieve_all_paid_amount) == ("u", 36.0)
    assert (u.active_paid_u_user_all, u.active_paid_amount_all, u.first_deny_reason) == ("u", 52.0, None)
    assert (v.enter_datapool_u_user, v.first_deny_reason, v.first_deny_index) == (None, "first", 1)
    assert (v.recieve_u_user_all, v.active_recieve_u_user_all, v.recieve_all_paid_amount, v.active_paid_amount_all) == (None, "v", None, 3.0)


def test_pool_jobs(spark, tmp_path):
    month, paid = str(tmp_path / "month"), str(tmp_path / "paid")
    run_month_pool(*_month_inputs(spark), 20240131, month)
    run_paid_pool(_paid_tables(spark), 20240115, paid)
    assert spark.read.parquet(month).groupBy("month").count().collect()[0][:] == (202401, 3)
    assert spark.read.parquet(paid).select(F.max("month"), F.count("*")).first()[:] == (202401, 2)

"""Tables that change in one step, clustered tables, incremental backfill, streams without repeats, guarded SQL."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stagewise.plans.backfill import runs_of
from stagewise.plans.funnel import FunnelTables, daily_funnel
from stagewise.plans.jobs import run_changed_days
from stagewise.sources.clustered import write_clustered
from stagewise.sources.guard import RefusedSql, guarded_sql
from stagewise.sources.publish import Published
from stagewise.sources.sinks import overwrite_partition, write_days
from stagewise.streaming.dedup import once_only
from workload import inputs

SCHEMA = "user string, n int, day int"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# --- publish ----------------------------------------------------------------------


def test_a_publish_that_fails_halfway_changes_nothing(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"), "day")
    old = [("a", 1, 20240101), ("b", 2, 20240102), ("c", 3, 20240103)]
    assert table.publish(frame(spark, *old), [20240101, 20240102, 20240103]) == 1
    # One task writes its day, the other fails after that.
    bad = spark.range(0, 2, 1, 2).select(
        F.lit("x").alias("user"), F.when(F.col("id") == 1, F.raise_error(F.lit("halfway"))).otherwise(7).cast("int").alias("n"),
        (F.col("id") + 20240101).cast("int").alias("day"),
    )
    with pytest.raises(Exception, match="halfway"):
        table.publish(bad, [20240101, 20240102])
    with pytest.raises(ValueError, match="20240109"):
        table.publish(frame(spark, ("x", 1, 20240109)), [20240101])
    with pytest.raises(ValueError, match="the table has"):
        table.publish(spark.createDataFrame([(1, 20240101)], "user int, day int"), [20240101])
    assert rows_of(table.read()) == old and table.versions() == [1]


def test_a_reader_sees_old_or_new(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"), "day")
    write_days(frame(spark, ("a", 1, 20240101), ("b", 2, 20240102)), table, [20240101, 20240102])
    before = table.read()
    write_days(frame(spark, ("z", 9, 20240102)), table, [20240101, 20240102])  # the first day ends up empty
    assert rows_of(before) == [("a", 1, 20240101), ("b", 2, 20240102)], "a reader that began earlier still reads the old files"
    assert rows_of(table.read()) == [("z", 9, 20240102)] and rows_of(table.read(1)) == rows_of(before)
    overwrite_partition(frame(spark, ("m", 1, 0)).drop("day"), table, {"day": 20240105})
    assert sorted(r[2] for r in rows_of(table.read())) == [20240102, 20240105]
    plan = table.read().where("day = 20240105")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert len(table.vacuum(keep=1)) == 1 and table.versions() == [3]
    assert sorted(r[2] for r in rows_of(table.read())) == [20240102, 20240105]


def test_two_publishes_at_once_keep_both(spark, tmp_path, monkeypatch):
    first, second = (Published(spark, str(tmp_path / "t"), "day") for _ in range(2))
    visible = first._make_visible

    def late(manifest):
        if second.versions() == []:
            second.publish(frame(spark, ("b", 2, 20240102)), [20240102])
        return visible(manifest)

    monkeypatch.setattr(first, "_make_visible", late)
    assert first.publish(frame(spark, ("a", 1, 20240101)), [20240101]) == 2
    assert rows_of(first.read()) == [("a", 1, 20240101), ("b", 2, 20240102)]


# --- clustered --------------------------------------------------------------------


def test_joins_of_clustered_tables_need_no_exchange(spark, plan_of):
    users = spark.range(500).select(F.concat(F.lit("u"), "id").alias("user"), F.col("id").cast("int").alias("n"))
    events = spark.range(3000).select(
        F.concat(F.lit("u"), F.col("id") % 700).alias("user"), F.col("id").alias("event"), (20240101 + F.col("id") % 2).cast("int").alias("day")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        write_clustered(users, "clustered_users", ["user"], buckets=8)
        write_clustered(events, "clustered_events", ["user"], partition="day", buckets=8)
        write_clustered(events.where("day = 20240101").withColumn("event", F.col("event") + 10_000), "clustered_events", ["user"], "day", 8)
        joined = spark.table("clustered_events").join(spark.table("clustered_users"), "user").groupBy("user").agg(F.sum("event").alias("s"))
        assert "Exchange" not in plan_of(joined, final=True)
        changed = events.withColumn("event", F.when(F.col("day") == 20240101, F.col("event") + 10_000).otherwise(F.col("event")))
        want = changed.join(users, "user").groupBy("user").agg(F.sum("event").alias("s"))
        assert rows_of(joined) == rows_of(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "83886080")
        spark.sql("DROP TABLE IF EXISTS clustered_users")
        spark.sql("DROP TABLE IF EXISTS clustered_events")


# --- incremental backfill ---------------------------------------------------------


def test_only_days_whose_windows_hold_a_changed_row_are_computed(spark, tmp_path):
    given = inputs.funnel_tables(spark, "/root/testdata/sf0.001", (20240101, 20240131))
    stored = {}
    for name in FunnelTables.__dataclass_fields__:
        getattr(given, name).write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    tables = FunnelTables(**stored)
    target, ledger = Published(spark, str(tmp_path / "funnel"), "day"), Published(spark, str(tmp_path / "ledger"), "day")
    every = run_changed_days(tables, 20240120, target, ledger)
    assert (every[0], every[-1], len(every)) == (20240101, 20240120, 20)
    assert run_changed_days(tables, 20240120, target, ledger) == []
    # The same rows in another order and other files are the same inputs.
    shuffled = replace(tables, orders=tables.orders.repartition(3).orderBy("amount"))
    assert run_changed_days(shuffled, 20240120, target, ledger) == []
    # A contact that arrives late concerns its own day and the one before.
    contact = tables.contacts.where("created_at >= '2024-01-10' AND created_at < '2024-01-11'").limit(1).withColumn("worker_id", F.lit(987).cast(tables.contacts.schema["worker_id"].dataType))
    late = replace(tables, contacts=tables.contacts.unionByName(contact))
    assert run_changed_days(late, 20240120, target, ledger) == [20240109, 20240110]
    # An order of February counts for the days whose 14 days reach it.
    order = tables.orders.limit(1).withColumn("pay_time", F.lit(datetime(2024, 2, 2, 3)).cast(tables.orders.schema["pay_time"].dataType))
    more = replace(late, orders=tables.orders.unionByName(order))
    assert run_changed_days(more, 20240120, target, ledger) == [20240119, 20240120]
    whole = daily_funnel(more, 20240101, 20240120)
    assert sorted(map(str, target.read().select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
    assert runs_of([20240131, 20240201, 20240203]) == [(20240131, 20240201), (20240203, 20240203)]


# --- streams ----------------------------------------------------------------------


def test_a_repeat_never_passes(spark, tmp_path):
    schema = "id string, at timestamp, v int"
    source, point = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    day = datetime(2024, 1, 1)

    def deliver(*rows):
        spark.createDataFrame([(i, day, v) for i, v in rows], schema).coalesce(1).write.mode("append").parquet(source)

    def run(checkpoint=point):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        query = once_only(stream, "id", "seen_ids", "passed", buckets=4)
        query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        for name in ("passed", "seen_ids"):
            spark.catalog.refreshTable(name)  # the stream runs in a session of its own
        return sorted((r.id or "", r.v) for r in spark.table("passed").collect())

    try:
        deliver(("a", 1), ("b", 1), ("a", 1), (None, 5), (None, 5))
        assert run() == [("", 5), ("", 5), ("a", 1), ("b", 1)]
        deliver(("a", 2), ("c", 1))  # after a restart
        assert run() == [("", 5), ("", 5), ("a", 1), ("b", 1), ("c", 1)]
        deliver(("b", 3), ("c", 3), ("d", 1))
        want = [("", 5), ("", 5), ("a", 1), ("b", 1), ("c", 1), ("d", 1)]
        assert run() == want
        # A stream that lost its checkpoint delivers every batch again.
        assert run(str(tmp_path / "other")) == want
        assert spark.table("seen_ids").count() == 4
    finally:
        for name in ("seen_ids", "passed"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


# --- guarded SQL ------------------------------------------------------------------

GOOD = [
    "select u_user, day from ev where day = 20240101 and event_type = 'click'",
    "select e.u_user, count(*) as n from ev e where e.day between 20240130 and 20240202 and e.event_type in ('click', 'get') group by e.u_user",
    "with c as (select u_user from ev where day >= 20240101 and day < 20240105 and event_type = 'get') select c.u_user, p.name from c left join people p on c.u_user = p.u_user",
    "select name from people where u_user in (select u_user from ev where 20240101 = day and event_type = 'click')",
    "select a.u_user from people a left join ev b on a.u_user = b.u_user and b.day = 20240101 and b.event_type = 'click'",
    "with ev as (select u_user from people) select u_user from ev",
]
BAD = {
    "select * from ev where day = 20240101 and event_type = 'click'": "named",
    "with c as (select * from people) select u_user from c": "named",
    "select p.*, 1 as one from people p": "named",
    "select u_user from ev where event_type = 'click'": "bounded",
    "select u_user from ev where day >= 20240101 and event_type = 'click'": "bounded",
    "select u_user from ev where (day = 20240101 or event_type = 'click') and event_type = 'click'": "bounded",
    "select u_user from ev where day between 20240101 and 20240108 and event_type = 'click'": "8 days",
    "select u_user from ev where day in (20240101, 20240301) and event_type = 'click'": "days",
    "select u_user from ev where day = 20240101": "event_type",
    "select u_user from ev where day = 20240101 and event_type in ('click', 'wrong')": "event_type",
    "select p.name from people p, ev e where e.day = 20240101 and e.event_type = 'get' and p.u_user = e.u_user": "joined",
    "select x.n from (select u_user, day, count(1) as n from ev where event_type = 'get' group by u_user, day) x where x.day = 20240101": "bounded",
    "select name from people where u_user in (select u_user from ev where event_type = 'click')": "bounded",
    "with c as (select u_user from ev e where e.event_type = 'get') select u_user from c": "bounded",
    "select e.u_user from ev e left join people p on e.u_user = p.u_user and e.day = 20240101 and e.event_type = 'get'": "bounded",
    "select u_user from ev where day = 20240101 and event_type = 'get' union all select u_user from ev": "bounded",
}


@pytest.fixture(scope="module")
def views(spark):
    days = [20240101, 20240104, 20240131, 20240202]
    rows = [(f"u{k}", d, t) for k in range(3) for d in days for t in ("click", "get")]
    spark.createDataFrame(rows, "u_user string, day int, event_type string").createOrReplaceTempView("ev")
    spark.createDataFrame([("u1", "one"), ("u2", "two")], "u_user string, name string").createOrReplaceTempView("people")


@pytest.mark.parametrize("text", GOOD)
def test_good_queries_run(spark, views, text):
    assert guarded_sql(spark, text, ["ev"]).collect()


@pytest.mark.parametrize("text", BAD)
def test_bad_queries_are_refused(spark, views, text):
    with pytest.raises(RefusedSql, match=BAD[text]):
        guarded_sql(spark, text, ["ev"])

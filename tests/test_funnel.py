"""Handmade edge rows for the daily and monthly funnels."""

from dataclasses import fields
from datetime import datetime, timezone

import pytest

from stagewise.plans import funnel
from stagewise.plans.jobs import run_daily_funnel, run_monthly_funnel
from workload import inputs

EVENT = (
    "u_user string, event_time long, scene string, option string, event_type string, event_key string, "
    "operate_ids array<string>, operate_id string, task_id string, os string, page_type string, product_id string, day int"
)


def ms(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


def at(text):
    return datetime.fromisoformat(text)


def shown(user="u", time="2024-01-10 12:00:00", ops=("o1",), task="317", **other):
    e = dict(scene="s", option="x", os="ios", page_type="引流", product_id="01") | other
    return (user, ms(time), e["scene"], e["option"], "get", "get_PaySceneEntrance", None if ops is None else list(ops),
            None, task, e["os"], e["page_type"], e["product_id"], int(time[:10].replace("-", "")))


def clicked(user="u", time="2024-01-10 12:01:00", op="o1", task="317", **other):
    e = dict(scene="s", option="x", os="ios", page_type="DRAINAGE", product_id="127") | other
    return (user, ms(time), e["scene"], e["option"], "click", "click_PaySceneEntrance", None, op, task, e["os"],
            e["page_type"], e["product_id"], int(time[:10].replace("-", "")))


@pytest.fixture
def tables(spark):
    def build(events=(), contacts=(), clues=(), service=(), school=(), users=(), orders=(), channels=()):
        def df(rows, schema):
            return spark.createDataFrame(list(rows), schema)

        attributes = ", ".join(f"{c} string" for c in funnel.USER_ATTRIBUTES)
        return funnel.FunnelTables(
            events=df(events, EVENT),
            contacts=df(contacts, "user_id string, channel_id string, external_user_id string, worker_id int, channel int, created_at timestamp"),
            clues=df(clues, "user_id string, worker_id int, we_com_open_id string, info_uuid string, created_at timestamp, clue_source string, qr_code_channel_id string"),
            service_periods=df(service, "user_id string, team_id int, start_time timestamp, end_time timestamp"),
            teams=df([(1, "north"), (2, "south")], "id int, name string"),
            school_periods=df(school, "user_id string, start_time timestamp, end_time timestamp, attribution string"),
            users=df(users, f"u_user string, day int, {attributes}"),
            grades=df([("g1", "stage one")], "grade_name string, stage_name string"),
            orders=df(orders, "user_id string, pay_time timestamp, amount double, is_test boolean, in_salary int, worker_id int"),
            channels=df(channels, "qr_code_id string, scene_name string, clue_level_name string, resource_entrance_name string, type_name string, effective_time timestamp, invalid_time timestamp, deleted_at timestamp"),
        )

    return build


def entrances(df):
    return sorted((r.u_user, r.task_id, r.operate_id) for r in df.collect())


def test_exposure_rules(tables):
    t = tables(
        [
            shown("list", ops=["a, b,,", "ignored"]),
            shown("null list", ops=None), shown("empty list", ops=[]), shown("blank list", ops=[""]),
            shown(None), shown(""), shown("no task", task=None), shown("blank task", task=""), shown("unset", task="undefined"),
            shown("web", os="web"), shown("no os", os=None), shown("page", page_type="other"), shown("product", product_id="02"),
            shown("shop", ops=["434754f3-c808-4c4c-b671-f0789db1d5d1, 92ce6aa4-9932-4edf-a8cf-cbe4854b3ada,92ce6aa4-9932-4edf-a8cf-cbe4854b3ada"],
                  scene="shop-baozang-hotEnter", page_type=None, task=None),
            clicked("clicks"),
        ]
    ).events
    assert entrances(funnel.exposures(t, 20240110, 20240110)) == [
        ("list", "317", "a"), ("list", "317", "b"),
        ("shop", "315", "92ce6aa4-9932-4edf-a8cf-cbe4854b3ada"),  # not trimmed, so the middle one is unknown
        ("shop", "317", "434754f3-c808-4c4c-b671-f0789db1d5d1"),
    ]


def test_click_rules(tables):
    shop = "e908068c-7f74-4fca-9aa6-a7b8c995dbef"
    t = tables(
        [clicked("trim", op=" o1 "), clicked("unset", task="undefined"), clicked("blank", task=""), clicked("no op", op=None),
         clicked("shop", op=shop, task="999", scene="shop-baozang-hotEnter"), clicked("other", op="zz", task=None, scene="shop-baozang-hotEnter")]
    ).events
    got = funnel.clicks(t, 20240110, 20240110).collect()
    assert sorted((r.u_user, r.task_id, r.operate_id) for r in got if r.operate_id) == [
        ("shop", "316", shop), ("shop", "999", shop), ("trim", "317", "o1"), ("unset", "undefined", "o1"),
    ]
    assert [r.u_user for r in got if r.operate_id is None] == ["no op"]


def test_first_event_is_per_day_or_per_month(tables):
    t = tables(
        [shown(time="2024-01-10 12:00:00", option="b"), shown(time="2024-01-10 12:00:00", option="a"), shown(time="2024-01-11 08:00:00"),
         shown(time="2024-01-09 20:00:00", scene=None), shown(time="2024-01-09 21:00:00", scene=None)]
    ).events
    per_day = funnel.first_exposures(t, 20240101, 20240131, per_day=True)
    assert sorted((r.day, r.option) for r in per_day.collect()) == [(20240109, "x"), (20240110, "a"), (20240111, "x")]
    per_month = funnel.first_exposures(t, 20240101, 20240131, per_day=False)
    assert sorted((r.day, r.option) for r in per_month.collect()) == [(20240109, "x"), (20240110, "a")]


TEAM_CASES = {
    "at start": (("2024-01-10 11:59:59", "2024-01-12 00:00:00"), "north", "north"),
    "at end": (("2024-01-01 00:00:00", "2024-01-10 11:59:59"), "north", "north"),
    "too late": (("2024-01-10 12:00:00", "2024-01-12 00:00:00"), "无服务期", "无服务期"),
    "too early": (("2024-01-01 00:00:00", "2024-01-10 11:59:58"), "无服务期", "无服务期"),
}


def test_team_before_the_exposure(tables):
    t = tables(
        [shown(user) for user in TEAM_CASES] + [shown("school a"), shown("school b"), shown("both"), shown("none"), shown("midnight", "2024-01-10 00:00:00")],
        service=[(u, 1, at(s), at(e)) for u, ((s, e), _, _) in TEAM_CASES.items()]
        + [("both", 2, at("2024-01-05 00:00:00"), at("2024-02-01 00:00:00")), ("both", 9, at("2024-01-09 00:00:00"), at("2024-02-01 00:00:00")),
           ("midnight", 1, at("2024-01-01 00:00:00"), at("2024-01-09 23:59:59"))],
        school=[("school a", at("2024-01-01 00:00:00"), at("2024-02-01 00:00:00"), "a"), ("school b", at("2024-01-01 00:00:00"), at("2024-02-01 00:00:00"), "b"),
                ("both", at("2024-01-04 00:00:00"), at("2024-02-01 00:00:00"), "b")],
    )
    day = {r.u_user: r.team_name for r in funnel.daily_exposures(t, 20240110, 20240110).collect()}
    month = {r.u_user: r.team_name for r in funnel.monthly_exposures(t, 20240101, 20240131).collect()}
    for user, (_, by_day, by_month) in TEAM_CASES.items():
        assert (day[user], month[user]) == (by_day, by_month)
    # The day counts one attribution only; a period must hold on the day itself.
    assert (day["school a"], month["school a"]) == ("无服务期", "入校")
    assert (day["school b"], month["school b"]) == ("入校", "入校")
    assert (day["both"], day["none"]) == ("south", "无服务期")
    assert (day["midnight"], month["midnight"]) == ("无服务期", "north")


def test_daily_contacts(tables):
    contact = lambda u, t, ext="e", w=1, ch=3: (u, "317", ext, w, ch, at(t))
    clue = lambda u, t, ext="e", w=1, n="i": (u, w, ext, n, at(t), "any", "0")
    t = tables(
        contacts=[
            contact("same day", "2024-01-10 09:00:00"), contact("next morning", "2024-01-11 00:30:00"),
            contact("got then added", "2024-01-10 09:00:00", ext=""), contact("got then added", "2024-01-11 01:00:00"),
            contact("added too late", "2024-01-10 09:00:00", ext=None), contact("added too late", "2024-01-11 01:00:01"),
            contact("other channel", "2024-01-10 09:00:00", ch=1), contact("", "2024-01-10 09:00:00"),
            contact("two pulls", "2024-01-10 09:00:00"), contact("wrong worker", "2024-01-10 09:00:00"),
        ],
        clues=[
            clue("same day", "2024-01-10 10:00:00"), clue("got then added", "2024-01-11 01:00:00"),
            clue("two pulls", "2024-01-10 10:00:00", n="a"), clue("two pulls", "2024-01-10 11:00:00", n="b"),
            clue("two pulls", "2024-01-10 11:00:00", ext=""), clue("wrong worker", "2024-01-10 10:00:00", w=2),
        ],
        orders=[("same day", at("2024-01-10 09:00:00"), 5.0, False, 1, 1), ("same day", at("2024-01-18 09:00:00"), 7.0, False, 1, 1),
                ("same day", at("2024-01-10 09:00:00"), 50.0, True, 1, 1)],
    )
    rows = [r for r in funnel.daily_contacts(t, 20240110, 20240110).collect()]
    got = sorted((r.get_wechat_user, r.add_wechat_user is not None, r.pull_wechat_user is not None, r.info_uuid) for r in rows)
    assert got == [
        ("added too late", False, False, None), ("got then added", True, True, "i"), ("same day", True, True, "i"),
        ("two pulls", True, True, "a"), ("two pulls", True, True, "b"), ("wrong worker", True, False, None),
    ]
    paid = next(r for r in rows if r.get_wechat_user == "same day")
    assert (paid.paid_7d_order_cnt, paid.paid_7d_amount, paid.paid_14d_amount, paid.paid_current_month_amount) == (1, 5.0, 12.0, 12.0)
    assert next(r for r in rows if r.info_uuid == "a").paid_14d_order_cnt is None
    # As part of a range the early-morning contact belongs to both of its days.
    both = funnel.daily_contacts(t, 20240110, 20240111).collect()
    assert ("next morning", 20240111) in {(r.get_wechat_user, r.day) for r in both}
    assert ("got then added", 20240111) in {(r.get_wechat_user, r.day) for r in both}


def test_monthly_contacts_keep_the_first_pull_of_two_sources(tables):
    t = tables(
        contacts=[("u", "317", "e", 1, 3, at("2024-01-31 09:00:00")), ("v", "317", "e", 1, 3, at("2024-02-01 00:30:00"))],
        clues=[("u", 9, "x", "late", at("2024-01-20 00:00:00"), "WeCom", "317"), ("u", 9, "x", "first", at("2024-01-02 00:00:00"), "WeCom", "317"),
               ("u", 9, "x", "source", at("2024-01-01 00:00:00"), "mid_school", "317"), ("u", 9, "x", "channel", at("2024-01-01 00:00:00"), "WeCom", "316")],
        orders=[("u", at("2024-01-01 00:00:00"), 4.0, False, 1, 1)],
    )
    rows = funnel.monthly_contacts(t, 20240101, 20240131).collect()
    assert [(r.get_wechat_user, r.info_uuid, r.paid_current_month_amount) for r in rows] == [("u", "first", 4.0)]


def _user(user, day, **values):
    return (user, day, *[values.get(c) for c in funnel.USER_ATTRIBUTES])


def test_user_attributes_by_day_and_month(tables):
    t = tables(users=[_user("u", 20240110, grade="g1", city="b"), _user("u", 20240110, grade="g0", city="c"), _user("u", 20240112, grade="g9", city="a")])
    day = funnel.daily_users(t, 20240110, 20240110).first()
    assert (day.grade, day.city, day.stage_name) == ("g1", "c", "stage one")
    month = funnel.monthly_users(t, 20240101, 20240131).first()
    assert (month.grade, month.city, month.stage_name) == ("g9", "a", None)


def test_channel_versions(tables):
    def version(code, name, start, end, kind="k", deleted=None):
        return (code, name, "l", "d", kind, at(start), at(end), deleted)

    t = tables(
        channels=[
            version("1", "old", "2024-01-01 10:00:00", "2024-01-10 09:00:00"), version("1", "new", "2024-01-10 08:00:00", "2024-03-01 00:00:00"),
            version("2", "test", "2024-01-01 00:00:00", "2024-03-01 00:00:00", kind="测试类型"), version("3", "untyped", "2024-01-01 00:00:00", "2024-03-01 00:00:00", kind=None),
            version("4", "deleted", "2024-01-01 00:00:00", "2024-03-01 00:00:00", deleted=at("2024-01-02 00:00:00")),
        ]
    )
    days = {(r.day, r.qr_code_id): r.scene_name for r in funnel.daily_channels(t, 20240109, 20240111).collect()}
    assert days == {(20240109, "1"): "old", (20240110, "1"): "new", (20240111, "1"): "new"}
    assert [r.scene_name for r in funnel.monthly_channels(t, 20240101, 20240131).collect()] == ["new"]


def _whole_funnel(tables):
    return tables(
        [shown("u"), clicked("u"), shown("u", "2024-01-12 12:00:00"), shown("v", "2024-01-12 12:00:00"), clicked("v", "2024-01-13 12:00:00")],
        contacts=[("u", "317", "e", 1, 3, at("2024-01-10 13:00:00"))],
        clues=[("u", 1, "e", "i", at("2024-01-10 14:00:00"), "WeCom", "317")],
        users=[_user("u", 20240110, grade="g1"), _user("v", 20240112, grade="g2")],
        orders=[("u", at("2024-01-10 15:00:00"), 9.5, False, 1, 1)],
        channels=[("317", "n", "l", "d", "k", at("2024-01-01 00:00:00"), at("2024-03-01 00:00:00"), None)],
    )


def test_funnel_columns_and_stages(tables):
    t = _whole_funnel(tables)
    daily = funnel.daily_funnel(t, 20240101, 20240131)
    assert daily.columns == [*funnel.DAILY_COLUMNS, "day"] and len(funnel.DAILY_COLUMNS) == 37
    rows = {(r.day, r.get_entrance_user): r for r in daily.collect()}
    assert sorted(rows) == [(20240110, "u"), (20240112, "u"), (20240112, "v")]
    first = rows[20240110, "u"]
    assert (first.click_entrance_user, first.pull_wechat_user, first.paid_7d_user, first.paid_7d_amount, first.scene_name, first.stage_name) == ("u", "u", "u", 9.5, "n", "stage one")
    assert rows[20240112, "u"].click_entrance_user is None and rows[20240112, "u"].grade is None
    monthly = funnel.monthly_funnel(t, 202401)
    assert monthly.columns == funnel.MONTHLY_COLUMNS and len(funnel.MONTHLY_COLUMNS) == 31
    rows = {r.get_entrance_user: r for r in monthly.collect()}
    assert rows["u"].paid_current_month_user == "u" and rows["v"].click_entrance_user == "v"


def test_a_range_of_days_equals_its_days(tables):
    t = _whole_funnel(tables)
    together = funnel.daily_funnel(t, 20240109, 20240113)
    alone = [str(r) for d in range(20240109, 20240114) for r in funnel.daily_funnel(t, d).collect()]
    assert sorted(str(r) for r in together.collect()) == sorted(alone)


def test_jobs_overwrite_their_partitions(spark, tables, tmp_path):
    t = _whole_funnel(tables)
    daily = str(tmp_path / "daily")
    days = run_daily_funnel(t, 20240115, daily)
    assert days[0] == 20240101 and len(days) == 15
    run_daily_funnel(t, 20240115, daily)
    assert sorted((r.day, r.get_entrance_user) for r in spark.read.parquet(daily).collect()) == [(20240110, "u"), (20240112, "u"), (20240112, "v")]
    monthly = str(tmp_path / "monthly")
    run_monthly_funnel(t, 20240115, monthly)
    assert {r.month for r in spark.read.parquet(monthly).collect()} == {202401}


def test_every_source_is_read_few_times(spark, tmp_path, plan_of):
    """With broadcasting off, after exchange reuse: contacts and clues at most three times, orders once."""
    given = inputs.funnel_tables(spark, "/root/testdata/sf0.001", (20240101, 20240131))
    stored = {}
    for f in fields(funnel.FunnelTables):
        path = str(tmp_path / f"stored_{f.name}")
        getattr(given, f.name).write.parquet(path)
        stored[f.name] = spark.read.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = plan_of(funnel.daily_funnel(funnel.FunnelTables(**stored), 20240101, 20240131), final=True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "83886080")
        spark.conf.set("spark.sql.maxMetadataStringLength", "100")
    times = {name: plan.count(f"/stored_{name}]") for name in stored}
    assert times["contacts"] <= 3 and times["clues"] <= 3 and times["orders"] == 1, times
    assert plan.count("Exchange hashpartitioning") <= 41, plan.count("Exchange hashpartitioning")

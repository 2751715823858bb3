"""Exposure -> click -> contact -> order funnels, daily and monthly.

The two are siblings, not one funnel with two date ranges: they differ in the scope
of the first event, the contact keys, the validity of service periods, the choice of
user attributes and the conversion windows. What they share is below; what differs
is in :func:`daily_funnel` and :func:`monthly_funnel`.

The daily funnel takes a range of days and carries ``day`` in every key, so a
backfill of a month is one job over one scan and not thirty.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.functions.columns import comma_items, is_text, not_blank
from stagewise.functions.dates import (
    contact_days,
    day_to_date,
    instant_of,
    month_bounds,
    overlaps_days,
    to_day_int,
    within_contact_window,
    within_days,
)
from stagewise.operators.convert import MONTH_END, conversions, total_orders
from stagewise.operators.intervals import latest_covering
from stagewise.operators.joins import ROWS_PER_PART, enrich, funnel_join, parts_of, shuffled, split_left_join
from stagewise.operators.rank import first_by, latest_by
from stagewise.operators.rollup import collapse_max, distinct_keys
from stagewise.sources.scans import eligible_orders, scan_days, scan_events

# What marks an entrance event, and the entrances whose operation id
# stands for a channel code.
EXPOSURE_TYPE, EXPOSURE_KEY = "get", "get_PaySceneEntrance"
CLICK_TYPE, CLICK_KEY = "click", "click_PaySceneEntrance"
PAGE_TYPES = ("引流", "DRAINAGE")
PAGE_LABEL = "引流"
PRODUCTS = ("01", "127")
SYSTEMS = ("android", "harmony", "ios", "weapp")
UNSET_TASK = "undefined"
SHOP_SCENE = "shop-baozang-hotEnter"
SHOP_CHANNELS = {
    "434754f3-c808-4c4c-b671-f0789db1d5d1": "317",
    "a975d5a8-fd34-461b-9cfb-6720d5655c09": "317",
    "7f53a8d4-7c46-4d23-926f-709eaa24d6bb": "316",
    "e908068c-7f74-4fca-9aa6-a7b8c995dbef": "316",
    "92ce6aa4-9932-4edf-a8cf-cbe4854b3ada": "315",
    "4ae78fed-9a98-4b7f-ac20-b10c8894cc38": "315",
}
CONTACT_CHANNEL = 3
CONTACT_CLUE_SOURCES = ("WeCom", "building_blocks_goods_wecom")
SCHOOL_ATTRIBUTION = "b"
SCHOOL_TEAM = "入校"
NO_TEAM = "无服务期"
TEST_CHANNEL_TYPE = "测试类型"

# Output columns in the order of the contract.
ENTRANCE = ["u_user", "scene", "task_id", "operate_id"]
USER_ATTRIBUTES = [
    "grade", "gender", "regist_time", "user_attribution", "active_user_attribution", "city_class",
    "province", "city", "user_pay_status_statistics", "user_pay_status_business",
]
CHANNEL_ATTRIBUTES = ["scene_name", "clue_level_name", "resource_entrance_name", "type_name"]
CONTACT_COLUMNS = ["get_wechat_user", "add_wechat_user", "pull_wechat_user", "info_uuid"]
DAILY_WINDOWS = {"7d": 7, "14d": 14, "current_month": MONTH_END}


def _output(windows) -> list[str]:
    paid = [c for w in windows for c in (f"paid_{w}_user", f"paid_{w}_order_cnt", f"paid_{w}_amount")]
    return [
        "scene", "option", "operate_id", "page_type", "task_id", "get_entrance_user",
        "click_entrance_user", *CONTACT_COLUMNS, *USER_ATTRIBUTES, *paid, "event_time",
        "before_get_entrance_team_name", *CHANNEL_ATTRIBUTES, "stage_name",
    ]


DAILY_COLUMNS = _output(DAILY_WINDOWS)
MONTHLY_COLUMNS = _output(["current_month"])


@dataclass(frozen=True)
class FunnelTables:
    events: DataFrame  # scans.EVENT_COLUMNS
    contacts: DataFrame  # user_id, channel_id, external_user_id, worker_id, channel, created_at
    clues: DataFrame  # user_id, worker_id, we_com_open_id, info_uuid, created_at, clue_source, qr_code_channel_id
    service_periods: DataFrame  # user_id, team_id, start_time, end_time
    teams: DataFrame  # id, name
    school_periods: DataFrame  # user_id, start_time, end_time, attribution
    users: DataFrame  # u_user, day, USER_ATTRIBUTES
    grades: DataFrame  # grade_name, stage_name
    orders: DataFrame  # user_id, pay_time, amount, is_test, in_salary, worker_id
    channels: DataFrame  # qr_code_id, CHANNEL_ATTRIBUTES, effective_time, invalid_time, deleted_at


# --- entrance events ----------------------------------------------------------

def _entry(task: Column, operate: Column) -> Column:
    return F.struct(task.cast("string").alias("task_id"), operate.alias("operate_id"))


def _shop_channel(operate: Column) -> Column:
    code = F
    for operate_id, channel in SHOP_CHANNELS.items():
        code = code.when(operate == operate_id, channel)
    return code.otherwise(None)


def _entries(events: DataFrame, *arrays: Column) -> DataFrame:
    """One row per entrance of an event. Both rules read the same row, so one scan and
    one explode stand for a union of two scans; equal entrances of an event need no
    removal because only the first per entrance survives later."""
    nothing = F.array().cast("array<struct<task_id:string,operate_id:string>>")
    both = F.concat(*[F.coalesce(a, nothing) for a in arrays])
    kept = [c for c in events.columns if c not in ("task_id", "operate_id", "operate_ids")]
    return events.select(*kept, F.explode(both).alias("_e")).select(
        *kept, "_e.task_id", "_e.operate_id"
    )


def _entrance_events(events: DataFrame, start: int, end: int, kind: str, key: str) -> DataFrame:
    return scan_events(events, start, end, [kind], [key]).where(
        F.col("product_id").isin(*PRODUCTS) & F.col("os").isin(*SYSTEMS) & is_text("u_user")
    )


def exposures(events: DataFrame, start: int, end: int) -> DataFrame:
    """Entrances shown, one row per event and entrance."""
    seen = _entrance_events(events, start, end, EXPOSURE_TYPE, EXPOSURE_KEY)
    by_task = F.col("page_type").isin(*PAGE_TYPES) & not_blank("task_id", UNSET_TASK)
    shown = F.transform(comma_items("operate_ids"), lambda o: _entry(F.col("task_id"), F.trim(o)))
    shop = F.filter(comma_items("operate_ids"), lambda o: o.isin(*SHOP_CHANNELS))
    shop = F.transform(shop, lambda o: _entry(_shop_channel(o), o))
    rows = _entries(seen, F.when(by_task, shown), F.when(F.col("scene") == SHOP_SCENE, shop))
    return rows.where(F.col("operate_id") != "")


def clicks(events: DataFrame, start: int, end: int) -> DataFrame:
    """Entrances clicked. Unlike exposures, a click keeps the unset task id."""
    seen = _entrance_events(events, start, end, CLICK_TYPE, CLICK_KEY)
    operate = F.col("operate_id")
    by_task = F.col("page_type").isin(*PAGE_TYPES) & not_blank("task_id")
    shop = (F.col("scene") == SHOP_SCENE) & operate.isin(*SHOP_CHANNELS)
    return _entries(
        seen,
        F.when(by_task, F.array(_entry(F.col("task_id"), F.trim(operate)))),
        F.when(shop, F.array(_entry(_shop_channel(operate), operate))),
    )


def first_exposures(events: DataFrame, start: int, end: int, *, per_day: bool) -> DataFrame:
    keys = [*(["day"] if per_day else []), *ENTRANCE]
    return first_by(exposures(events, start, end), keys, "event_time", ["option"])


def first_clicks(events: DataFrame, start: int, end: int, *, per_day: bool) -> DataFrame:
    keys = [*(["day"] if per_day else []), *ENTRANCE]
    return first_by(clicks(events, start, end), keys, "event_time", ["option"])


# --- service period before the exposure ---------------------------------------

def _periods(tables: FunnelTables, school_periods: DataFrame, lo: int, hi: int) -> DataFrame:
    """Service and school periods that share a day with ``[lo, hi]``."""
    columns = ["user_id", "team_name", "start_time", "end_time"]
    teams = tables.teams.select(F.col("id").alias("team_id"), F.col("name").alias("team_name"))
    served = tables.service_periods.join(teams, "team_id").select(*columns)
    school = school_periods.withColumn("team_name", F.lit(SCHOOL_TEAM)).select(*columns)
    return served.unionByName(school).where(overlaps_days("start_time", "end_time", lo, hi))


def with_team(exposed: DataFrame, periods: DataFrame, start: int, end: int) -> DataFrame:
    """Adds the team whose period holds the instant one second before the exposure. The second is put
    on the periods, so that all instants lie inside the days of the job."""
    at = exposed.withColumn("_instant", instant_of("event_time"))
    periods = periods.withColumnRenamed("user_id", "u_user")
    days = (f"{day_to_date(start)} 00:00:00", f"{day_to_date(end)} 23:59:59")
    found = latest_covering(at, periods, "u_user", "_instant", "start_time", "end_time", ["team_name"], within=days)
    return found.withColumn("team_name", F.coalesce("team_name", F.lit(NO_TEAM))).drop(
        "_instant", "start_time"
    )


def _one_second_later(periods: DataFrame, last: Column) -> DataFrame:
    second = F.lit(timedelta(seconds=1))
    return periods.withColumns({"start_time": F.col("start_time") + second, "end_time": last})


def daily_exposures(tables: FunnelTables, start: int, end: int) -> DataFrame:
    """First exposures of every day with the team of a period that holds on that day;
    only one attribution of the school periods counts."""
    school = tables.school_periods.where(F.col("attribution") == SCHOOL_ATTRIBUTION)
    periods = _periods(tables, school, start, end)
    # The instant before may be on the day before, but the period must reach the exposure's own day:
    # one that ends in the last second of a day does not hold for exposures of the next.
    day_ends = F.date_trunc("day", "end_time") + F.lit(timedelta(days=1) - timedelta(microseconds=1))
    last = F.least(F.col("end_time") + F.lit(timedelta(seconds=1)), day_ends)
    exposed = first_exposures(tables.events, start, end, per_day=True)
    return with_team(exposed, _one_second_later(periods, last), start, end)


def monthly_exposures(tables: FunnelTables, start: int, end: int) -> DataFrame:
    """First exposures of the whole month with the team of any period that touches it."""
    periods = _periods(tables, tables.school_periods, start, end)
    last = F.col("end_time") + F.lit(timedelta(seconds=1))
    exposed = first_exposures(tables.events, start, end, per_day=False)
    return with_team(exposed, _one_second_later(periods, last), start, end)


def _days_covered(start: str, end: str, lo: int, hi: int) -> Column:
    """Days of ``[lo, hi]`` that the interval touches, as an int array."""
    first = F.greatest(F.to_date(start), F.lit(day_to_date(lo)))
    last = F.least(F.to_date(end), F.lit(day_to_date(hi)))
    return F.when(first <= last, F.transform(F.sequence(first, last), to_day_int))


# --- contacts -----------------------------------------------------------------

def _contacts(tables: FunnelTables, start: int, end: int) -> DataFrame:
    return tables.contacts.where(
        (F.col("user_id") != "")
        & (F.col("channel") == CONTACT_CHANNEL)
        & within_contact_window("created_at", start, end)
    ).withColumn("channel_id", F.col("channel_id").cast("string"))


def _pulled(tables: FunnelTables, start: int, end: int) -> DataFrame:
    return tables.clues.where(
        within_contact_window("created_at", start, end) & is_text("we_com_open_id")
    )


def contact_keys(tables: FunnelTables, start: int, end: int) -> tuple[DataFrame, DataFrame]:
    """Contacts per day, user, channel, worker and external id from one pass, and per (day, user,
    channel) whether the code was got and how many were added. Both are small next to the contacts."""
    on_days = F.explode(contact_days("created_at", start, end)).alias("day")
    touched = _contacts(tables, start, end).select(
        on_days, "user_id", "channel_id", "worker_id", "external_user_id", "created_at"
    )
    contacts = touched.groupBy("day", "user_id", "channel_id", "worker_id", "external_user_id").agg(
        F.max(to_day_int("created_at") == F.col("day")).alias("is_got")
    )
    added = F.count(F.when(is_text("external_user_id"), 1))
    entered = (
        contacts.groupBy("day", "user_id", "channel_id")
        .agg(F.max("is_got").alias("is_got"), added.alias("n_added"))
        .where("is_got")
        .drop("is_got")
    )
    return contacts, entered


def daily_contacts(tables: FunnelTables, start: int, end: int) -> DataFrame:
    """Got the code -> added the worker -> pulled into the pool, per day, with the
    orders of the pulled user. Columns: day, channel_id, CONTACT_COLUMNS, paid_*."""
    return _daily_contacts(tables, start, end, *contact_keys(tables, start, end)).drop("n_added")


def _daily_contacts(tables: FunnelTables, start: int, end: int, contacts: DataFrame, entered: DataFrame) -> DataFrame:
    entered = entered.select(
        F.col("day").alias("_day"), F.col("user_id").alias("get_wechat_user"), F.col("channel_id").alias("_channel"), "n_added"
    )
    # Who added comes from an inner join, which splits on both sides; who did not is known
    # from the count.
    same = (
        (F.col("day") == F.col("_day")) & (F.col("user_id") == F.col("get_wechat_user"))
        & (F.col("channel_id") == F.col("_channel"))
    )
    kept = ["_day", "_channel", "get_wechat_user", "n_added"]
    added = contacts.where(is_text("external_user_id")).join(shuffled(entered), same)
    added = added.select(*kept, F.col("user_id").alias("add_wechat_user"), "worker_id", "external_user_id")
    alone = entered.where("n_added = 0").select(*kept)
    reached = added.unionByName(alone, allowMissingColumns=True)

    on_days = F.explode(contact_days("created_at", start, end)).alias("_pull_day")
    pulled = _pulled(tables, start, end).select(
        on_days, F.col("user_id").alias("pull_wechat_user"), F.col("worker_id").alias("_worker"),
        "we_com_open_id", "info_uuid",
    )
    on = {
        "_day": "_pull_day", "add_wechat_user": "pull_wechat_user", "external_user_id": "we_com_open_id",
        "worker_id": "_worker",
    }
    parts = parts_of(pulled, list(on.values()))
    pulled = pulled.join(shuffled(parts), list(on.values()))
    reached = split_left_join(reached, pulled, on, parts, ["info_uuid"])
    paid = conversions(
        eligible_orders(tables.orders), "user_id", "pay_time", "amount", start, end, DAILY_WINDOWS
    ).withColumnsRenamed({"user_id": "pull_wechat_user", "day": "_day"})
    paid_columns = [c for c in paid.columns if c.startswith("paid_")]
    reached = reached.join(shuffled(paid), ["pull_wechat_user", "_day"], "left")
    return reached.select(
        F.col("_day").alias("day"), F.col("_channel").alias("channel_id"), *CONTACT_COLUMNS, *paid_columns, "n_added"
    )


def monthly_contacts(tables: FunnelTables, start: int, end: int) -> DataFrame:
    """Monthly contact rules: all stages meet on user and channel, and only the first
    pull of two clue sources counts."""
    touched = _contacts(tables, start, end)
    keys = ["user_id", "channel_id"]
    got = distinct_keys(touched.where(within_days("created_at", start, end)), keys)
    added = distinct_keys(touched.where(is_text("external_user_id")), keys)
    pulled = _pulled(tables, start, end).where(F.col("clue_source").isin(*CONTACT_CLUE_SOURCES))
    pulled = first_by(
        pulled.select(
            "user_id", F.col("qr_code_channel_id").cast("string").alias("channel_id"), "info_uuid", "created_at"
        ),
        keys, "created_at", ["info_uuid"],
    )
    orders = eligible_orders(tables.orders).where(within_days("pay_time", start, end))
    pulled = pulled.join(total_orders(orders, "user_id", "amount", "current_month"), "user_id", "left")
    paid_columns = ["paid_current_month_order_cnt", "paid_current_month_amount"]
    stages = [
        got.select(F.col("user_id").alias("get_wechat_user"), "channel_id"),
        added.select(F.col("user_id").alias("add_wechat_user"), F.col("channel_id").alias("_added")),
        pulled.select(
            F.col("user_id").alias("pull_wechat_user"), F.col("channel_id").alias("_pulled"), "info_uuid", *paid_columns
        ),
    ]
    joined = funnel_join(
        stages,
        [
            {"get_wechat_user": "add_wechat_user", "channel_id": "_added"},
            {"add_wechat_user": "pull_wechat_user", "_added": "_pulled"},
        ],
    )
    return joined.select("channel_id", *CONTACT_COLUMNS, *paid_columns)


# --- dimensions ---------------------------------------------------------------

def _grades(tables: FunnelTables) -> DataFrame:
    return tables.grades.groupBy(F.col("grade_name").alias("grade")).agg(
        F.max("stage_name").alias("stage_name")
    )


def daily_users(tables: FunnelTables, start: int, end: int) -> DataFrame:
    """Largest value of every attribute per user and day."""
    staged = scan_days(tables.users, start, end).join(_grades(tables), "grade", "left")
    return collapse_max(staged, ["u_user", "day"], [*USER_ATTRIBUTES, "stage_name"])


def monthly_users(tables: FunnelTables, start: int, end: int) -> DataFrame:
    """The user's latest row of the month."""
    latest = latest_by(scan_days(tables.users, start, end), "u_user", "day", USER_ATTRIBUTES)
    return latest.join(_grades(tables), "grade", "left").select("u_user", *USER_ATTRIBUTES, "stage_name")


def _live_channels(tables: FunnelTables) -> DataFrame:
    live = (F.col("type_name") != TEST_CHANNEL_TYPE) & F.col("deleted_at").isNull()
    return tables.channels.where(live).withColumn("qr_code_id", F.col("qr_code_id").cast("string"))


def daily_channels(tables: FunnelTables, start: int, end: int) -> DataFrame:
    """Last version of a channel that is valid on the day."""
    days = F.explode(_days_covered("effective_time", "invalid_time", start, end)).alias("day")
    valid = _live_channels(tables).where(overlaps_days("effective_time", "invalid_time", start, end))
    latest = latest_by(valid.select("*", days), ["qr_code_id", "day"], "effective_time", CHANNEL_ATTRIBUTES)
    return latest.select("qr_code_id", "day", *CHANNEL_ATTRIBUTES)


def monthly_channels(tables: FunnelTables, start: int, end: int) -> DataFrame:
    """Last version of a channel that is valid at some day of the period."""
    valid = _live_channels(tables).where(overlaps_days("effective_time", "invalid_time", start, end))
    return latest_by(valid, "qr_code_id", "effective_time", CHANNEL_ATTRIBUTES).select(
        "qr_code_id", *CHANNEL_ATTRIBUTES
    )


# --- funnels ------------------------------------------------------------------

def _with_payers(contacts: DataFrame, windows) -> DataFrame:
    for w in windows:
        paid_user = F.when(F.col(f"paid_{w}_order_cnt").isNotNull(), F.col("pull_wechat_user"))
        contacts = contacts.withColumn(f"paid_{w}_user", paid_user)
    return contacts


def _clicked(clicked: DataFrame, period: list[str]) -> tuple[DataFrame, dict[str, str]]:
    keys = [*period, "scene", "task_id", "operate_id"]
    renamed = clicked.select(
        F.col("u_user").alias("click_entrance_user"), *[F.col(c).alias(f"_click_{c}") for c in keys]
    )
    return renamed, {"u_user": "click_entrance_user", **{c: f"_click_{c}" for c in keys}}


def _finish(reached: DataFrame, channels: DataFrame, period: list[str]) -> DataFrame:
    channels = channels.withColumnRenamed("qr_code_id", "task_id")
    return enrich(reached, channels, ["task_id", *period]).withColumns(
        {
            "page_type": F.lit(PAGE_LABEL),
            "get_entrance_user": F.col("u_user"),
            "before_get_entrance_team_name": F.col("team_name"),
        }
    )


def daily_funnel(tables: FunnelTables, start: int, end: int | None = None) -> DataFrame:
    """DAILY_COLUMNS plus ``day``, for one day or for every day of ``[start, end]``.

    Exposures, clicks and users are one row per key and meet in plain left joins; the contacts, of which one
    user, channel and day may have very many, are dealt to parts by the number of added workers.
    """
    end = start if end is None else end
    exposed = daily_exposures(tables, start, end)
    known = exposed.join(shuffled(daily_users(tables, start, end)), ["u_user", "day"], "left")
    clicked, on = _clicked(distinct_keys(clicks(tables.events, start, end), ["day", *ENTRANCE]), ["day"])
    reached = funnel_join([known, clicked], [on])
    contacts, entered = contact_keys(tables, start, end)
    added_parts = F.greatest(F.ceil(F.col("n_added") / ROWS_PER_PART), F.lit(1)).cast("int")
    contacted = _with_payers(_daily_contacts(tables, start, end, contacts, entered), DAILY_WINDOWS)
    contacted = contacted.withColumn("_parts", added_parts).drop("n_added")
    names_ = {"day": "_contact_day", "user_id": "get_wechat_user", "channel_id": "_contact_channel"}
    parts = entered.withColumnsRenamed(names_).withColumn("_parts", added_parts).drop("n_added")
    contacted = contacted.withColumnsRenamed({"day": "_contact_day", "channel_id": "_contact_channel"})
    on = {"click_entrance_user": "get_wechat_user", "_click_task_id": "_contact_channel", "_click_day": "_contact_day"}
    reached = split_left_join(reached, contacted, on, parts, ["add_wechat_user", "info_uuid"])
    return _finish(reached, daily_channels(tables, start, end), ["day"]).select(*DAILY_COLUMNS, "day")


def monthly_funnel(tables: FunnelTables, month: int) -> DataFrame:
    """MONTHLY_COLUMNS for a yyyyMM month. Contacts are one row per user and channel here."""
    start, end = month_bounds(month)
    exposed = monthly_exposures(tables, start, end)
    known = exposed.join(monthly_users(tables, start, end), "u_user", "left")
    clicked, on = _clicked(distinct_keys(clicks(tables.events, start, end), ENTRANCE), [])
    contacted = _with_payers(monthly_contacts(tables, start, end), ["current_month"])
    contacted = contacted.withColumnRenamed("channel_id", "_contact_channel")
    reached = funnel_join(
        [known, clicked, contacted],
        [on, {"click_entrance_user": "get_wechat_user", "_click_task_id": "_contact_channel"}],
    )
    return _finish(reached, monthly_channels(tables, start, end), []).select(*MONTHLY_COLUMNS)

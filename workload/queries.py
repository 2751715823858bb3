"""Registered queries: every operator and plan over the given tables.

Queries read whole tables; dates and months are parameters of the jobs they stand
for. Amounts are rounded to cents so that the order of a floating sum cannot show.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.functions.columns import comma_items
from stagewise.functions.dates import month_bounds, overlaps_days, to_day_int, within_days
from stagewise.functions.text import clean_messages, event_type_of, parse_tolerant, tag_intent
from stagewise.operators import convert, intervals, joins, rank, rollup, timeline
from stagewise.plans import funnel, pool
from stagewise.session import apply_settings
from stagewise.sources import adhoc, scans
from stagewise.streaming.dedup import dedup_stream
from workload import inputs

MONTH = 202401
MONTH_DAYS = month_bounds(MONTH)
DAY = 20240115

REGISTRY = {}

# Whole numbers that may be NULL; engines hand them over in different types unless
# both sides say DOUBLE.
_ORDER_COUNTS = [f"paid_{w}_order_cnt" for w in funnel.DAILY_WINDOWS]
NULLABLE_NUMBERS = {
    "asof_dimension": ["o_orderkey"],
    "conversion_windows": _ORDER_COUNTS,
    "cond_min_max": ["first_payment"],
    "stage_funnel": ["click_user", "purchase_user"],
    "contact_funnel": _ORDER_COUNTS,
    "contact_funnel_month": ["paid_current_month_order_cnt"],
    "daily_funnel": _ORDER_COUNTS,
    "backfill_funnel": _ORDER_COUNTS,
    "monthly_funnel": ["paid_current_month_order_cnt"],
    "month_pool": ["province_code", "city_code", "area_code", "level", "first_deny_index", "regist_duration", "datepool_cnt"],
    "paid_pool": ["first_deny_index"],
    "first_pay_after": ["first_day"],
}


def query(fn):
    name = fn.__name__.removesuffix("_query")

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(apply_settings(spark, time_zone="UTC"), sf_dir)
        return df.withColumns({c: F.col(c).cast("double") for c in NULLABLE_NUMBERS.get(name, [])})

    REGISTRY[name] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("day", to_day_int("ts"))


def cents(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 2) for c in columns})


def monthly(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.year("ts") * 100 + F.month("ts"))


# --- scans --------------------------------------------------------------------

@query
def event_scan_pruned(spark, sf_dir):
    events = table(spark, sf_dir, "events").where(within_days("ts", 20240110, 20240116))
    kept = ["event_id", "user_id", "event_type", "value", "day"]
    return scans.scan_events(
        events.withColumn("day", to_day_int("ts")), 20240110, 20240116, ["view", "click"], columns=kept
    )


@query
def month_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where(within_days("o_orderdate", 19970301, 19970331))
    orders = scans.scan_month(orders.withColumn("day", to_day_int("o_orderdate")), 199703)
    to_date = F.sum(F.when(F.col("day") <= 19970315, F.col("o_totalprice")))
    return orders.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("month_orders"),
        F.round(F.sum("o_totalprice"), 2).alias("month_amount"),
        F.round(to_date, 2).alias("mid_month_amount"),
    )


@query
def month_to_date_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where(within_days("o_orderdate", 19970301, 19970315))
    orders = scans.scan_month_to_date(orders.withColumn("day", to_day_int("o_orderdate")), 19970315)
    return orders.select("o_orderkey", "o_custkey", "day")


@query
def eligible_orders(spark, sf_dir):
    orders = inputs.Inputs(spark, sf_dir).load("paid_orders")
    kept = scans.eligible_orders(orders).where(within_days("pay_time", *MONTH_DAYS))
    team = scans.eligible_team_orders(orders, *MONTH_DAYS).select("order_id", F.lit(1).alias("team"))
    return kept.join(team, "order_id", "left").select(
        "order_id", "user_id", "amount", F.coalesce("team", F.lit(0)).alias("counts_for_team")
    )


@query
def guarded_scan(spark, sf_dir):
    events = table(spark, sf_dir, "events").where(within_days("ts", 20240108, 20240114))
    return scans.guarded_scan(
        events.withColumn("day", to_day_int("ts")), 20240108, 20240114, ["click"],
        ["event_id", "user_id", "day"],
    )


@query
def adhoc_sql(spark, sf_dir):
    adhoc.register_tables(spark, {t: table(spark, sf_dir, t) for t in ("orders", "customer")})
    return adhoc.run_sql(
        spark,
        """with spend as (
             select o_custkey, count(*) as orders, round(sum(o_totalprice), 2) as amount
             from orders group by o_custkey)
           select c.c_mktsegment, count(s.o_custkey) as buyers, sum(s.orders) as orders,
                  round(sum(s.amount), 2) as amount
           from customer c left join spend s on c.c_custkey = s.o_custkey
           group by c.c_mktsegment;""",
    )


# --- ranks --------------------------------------------------------------------

@query
def first_event_by_key(spark, sf_dir):
    first = rank.first_by(events_by_day(spark, sf_dir), ["day", "user_id", "event_type"], "ts", ["event_id"])
    return first.select("day", "user_id", "event_type", "event_id", "value")


@query
def latest_event_by_key(spark, sf_dir):
    latest = rank.latest_by(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", ["event_id"])
    return latest.select("user_id", "event_type", "event_id", "value")


@query
def first_and_latest_snapshot(spark, sf_dir):
    events = monthly(table(spark, sf_dir, "events"))
    order, columns = ["ts", "event_id"], ["event_id", "event_type", "value"]
    return rank.first_and_latest_by(events, ["user_id", "month"], order, columns, columns)


@query
def latest_n_turns(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return rank.last_n_by(turns, "conv_id", "turn", 3, ["role", "text"])


@query
def latest_dozen_events(spark, sf_dir):
    latest = rank.last_n_by(table(spark, sf_dir, "events"), "user_id", "ts", 12, ["event_id"])
    return latest.select("user_id", "event_id", "event_type")


# --- entrances ----------------------------------------------------------------

def _frontend(spark, sf_dir):
    return inputs.Inputs(spark, sf_dir).load("frontend_events")


@query
def exposure_union(spark, sf_dir):
    first = funnel.first_exposures(_frontend(spark, sf_dir), *MONTH_DAYS, per_day=True)
    return first.select("day", *funnel.ENTRANCE, "event_time", "option")


@query
def click_union(spark, sf_dir):
    first = funnel.first_clicks(_frontend(spark, sf_dir), *MONTH_DAYS, per_day=False)
    return first.select(*funnel.ENTRANCE, "event_time")


@query
def period_union(spark, sf_dir):
    served = inputs.Inputs(spark, sf_dir).load("service_periods")
    school = inputs.Inputs(spark, sf_dir).load("school_periods")
    hour = F.date_format("start_time", "yyyy-MM-dd HH").alias("start_hour")
    return joins.union_distinct(
        served.select("user_id", F.col("team_id").cast("string").alias("team"), hour),
        school.select("user_id", F.col("attribution").alias("team"), hour),
    )


@query
def explode_list(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn(
        "names", F.array(F.concat(F.regexp_replace("p_name", " ", " , "), F.lit(",")))
    )
    items = parts.select("p_partkey", F.explode(comma_items("names")).alias("item"))
    return items.withColumn("item", F.trim("item")).where(F.col("item") != "")


# --- intervals ----------------------------------------------------------------

@query
def interval_at_event(spark, sf_dir):
    clicked = table(spark, sf_dir, "events").where(F.col("event_type") == "click")
    clicked = clicked.select("event_id", F.col("user_id").cast("string").alias("user_id"), "ts")
    periods = inputs.Inputs(spark, sf_dir).load("service_periods")
    found = intervals.latest_covering(
        clicked, periods, "user_id", "ts", "start_time", "end_time", ["team_id"]
    )
    return found.select("event_id", "user_id", F.coalesce("team_id", F.lit(-1)).alias("team_id"))


@query
def valid_on_date(spark, sf_dir):
    periods = inputs.Inputs(spark, sf_dir).load("service_periods")
    teams = inputs.Inputs(spark, sf_dir).load("teams").withColumnsRenamed({"id": "team_id", "name": "team"})
    valid = periods.where(overlaps_days("start_time", "end_time", DAY, DAY))
    return valid.join(teams, "team_id").groupBy("team").agg(F.count(F.lit(1)).alias("periods"))


@query
def overlaps_month(spark, sf_dir):
    channels = inputs.Inputs(spark, sf_dir).load("channels")
    kept = channels.where(overlaps_days("effective_time", "invalid_time", *MONTH_DAYS))
    return kept.select("qr_code_id", "scene_name", "type_name")


@query
def asof_dimension(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    versions = orders.withColumn("valid_until", F.col("o_orderdate") + F.expr("INTERVAL '120' DAY"))
    lo, hi = F.lit("1998-12-01 00:00:00"), F.lit("1998-12-31 00:00:00")
    latest = intervals.latest_valid(
        versions, "o_custkey", "o_orderdate", "valid_until", lo, hi, ["o_orderkey"]
    ).select("o_custkey", "o_orderkey", "o_orderpriority")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return joins.enrich(customers, latest, {"c_custkey": "o_custkey"})


# --- payments -----------------------------------------------------------------

def _dated(df):
    return df.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@query
def suffix_sum(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return _dated(timeline.suffix_sum(orders, "o_custkey", "o_orderdate", "o_totalprice"))


@query
def suffix_sum_without_ties(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return _dated(
        timeline.suffix_sum(orders, "o_custkey", "o_orderdate", "o_totalprice", dedupe_ties=True)
    )


@query
def pay_timeline(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return _dated(timeline.paid_timeline(orders, "o_custkey", "o_orderdate", "o_totalprice"))


@query
def paid_amount_by_user(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    after = timeline.suffix_sum(orders, "o_custkey", "o_orderdate", "o_totalprice")
    return after.groupBy("o_custkey").agg(F.max("amount_after").alias("amount"))


@query
def first_pay_after(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    joined_at = events.where(F.col("event_type") == "signup").groupBy("user_id").agg(
        F.min("ts").alias("first_signup"), F.max("ts").alias("last_signup")
    )
    paid = timeline.first_after(
        events.where(F.col("event_type") == "purchase"), joined_at, "user_id", "ts", "value",
        {"first": "first_signup", "last": "last_signup"},
    )
    return paid.select(
        "user_id", to_day_int("first_at").alias("first_day"), "first_amount", "last_amount"
    )


@query
def conversion_windows(spark, sf_dir):
    orders = scans.eligible_orders(inputs.Inputs(spark, sf_dir).load("paid_orders"))
    paid = convert.conversions(orders, "user_id", "pay_time", "amount", *MONTH_DAYS, funnel.DAILY_WINDOWS)
    return cents(paid, *[c for c in paid.columns if c.endswith("_amount")])


@query
def conversion_month(spark, sf_dir):
    orders = scans.eligible_orders(inputs.Inputs(spark, sf_dir).load("paid_orders"))
    month = orders.where(within_days("pay_time", *MONTH_DAYS))
    return cents(convert.total_orders(month, "user_id", "amount", "month"), "paid_month_amount")


# --- aggregates ---------------------------------------------------------------

@query
def user_rollup(spark, sf_dir):
    events = monthly(table(spark, sf_dir, "events"))
    rolled = rollup.rollup(
        events.withColumn("last_type", F.col("event_type")), ["user_id", "month"],
        {"event_id": "max", "last_type": "max", "ts": "min", "value": "sum"},
    )
    return cents(rolled.withColumn("ts", to_day_int("ts")), "value")


@query
def attribute_collapse(spark, sf_dir):
    users = inputs.Inputs(spark, sf_dir).load("activity")
    return rollup.collapse_max(users, "u_user", funnel.USER_ATTRIBUTES)


@query
def value_set_sorted(spark, sf_dir):
    denials = inputs.Inputs(spark, sf_dir).load("denials")
    positive = F.when(F.col("deny_index") > 0, F.col("deny_index"))
    sets = denials.groupBy("user_id", "day").agg(rollup.distinct_sorted(positive).alias("codes"))
    return sets.withColumn("codes", F.array_join(F.col("codes").cast("array<string>"), ","))


@query
def has_value(spark, sf_dir):
    events = events_by_day(spark, sf_dir)
    return events.groupBy("user_id", "day").agg(
        rollup.has_value("event_type", "purchase").alias("paid"),
        rollup.has_value("event_type", "signup").alias("joined"),
    )


@query
def cond_min_max(spark, sf_dir):
    paid = F.col("event_type") == "purchase"
    return events_by_day(spark, sf_dir).groupBy("user_id", "day").agg(
        rollup.max_when(paid, F.col("value")).alias("largest_payment"),
        rollup.min_when(paid, F.col("event_id")).alias("first_payment"),
        F.max(F.when(paid, 1).otherwise(0)).alias("has_paid"),
    )


@query
def distinct_keys(spark, sf_dir):
    return rollup.distinct_keys(events_by_day(spark, sf_dir), ["user_id", "day", "event_type"])


# --- joins --------------------------------------------------------------------

@query
def member_flags(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    flagged = joins.flag_member(customers, orders, "c_custkey", "has_order")
    return joins.flag_member(flagged, urgent, "c_custkey", "has_urgent_order")


@query
def dim_enrich(spark, sf_dir):
    spend = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("amount")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    customers = joins.enrich(customers, spend, {"c_custkey": "o_custkey"})
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    located = joins.enrich(customers, nations, "c_nationkey")
    located = joins.enrich(located, table(spark, sf_dir, "region"), {"n_regionkey": "r_regionkey"})
    in_credit = F.when(F.col("c_acctbal") > 0, F.col("n_name")).alias("nation_in_credit")
    return located.select("c_custkey", "n_name", "r_name", in_credit, "orders", "amount")


@query
def stage_funnel(spark, sf_dir):
    """View -> click -> purchase of a user on one day."""
    reached = rollup.distinct_keys(events_by_day(spark, sf_dir), ["user_id", "day", "event_type"])

    def stage(kind):
        of_kind = reached.where(F.col("event_type") == kind)
        return of_kind.select(F.col("user_id").alias(f"{kind}_user"), F.col("day").alias(f"{kind}_day"))

    kinds = ["view", "click", "purchase"]
    keys = [{f"{a}_{k}": f"{b}_{k}" for k in ("user", "day")} for a, b in zip(kinds, kinds[1:])]
    joined = joins.funnel_join([stage(kind) for kind in kinds], keys)
    return joined.select(F.col("view_day").alias("day"), "view_user", "click_user", "purchase_user")


# --- funnels and pools --------------------------------------------------------

def _funnel_output(df):
    return cents(df, *[c for c in df.columns if c.startswith("paid_") and c.endswith("_amount")])


@query
def contact_funnel(spark, sf_dir):
    tables = inputs.funnel_tables(spark, sf_dir, MONTH_DAYS)
    reached = funnel.daily_contacts(tables, *MONTH_DAYS)
    return _funnel_output(reached)


@query
def contact_funnel_month(spark, sf_dir):
    tables = inputs.funnel_tables(spark, sf_dir, MONTH_DAYS)
    return _funnel_output(funnel.monthly_contacts(tables, *MONTH_DAYS))


@query
def team_at_exposure(spark, sf_dir):
    tables = inputs.funnel_tables(spark, sf_dir, MONTH_DAYS)
    found = funnel.daily_exposures(tables, *MONTH_DAYS)
    return found.select("day", *funnel.ENTRANCE, F.col("team_name").alias("team"))


@query
def daily_users(spark, sf_dir):
    return funnel.daily_users(inputs.funnel_tables(spark, sf_dir, MONTH_DAYS), *MONTH_DAYS)


@query
def monthly_users(spark, sf_dir):
    return funnel.monthly_users(inputs.funnel_tables(spark, sf_dir, MONTH_DAYS), *MONTH_DAYS)


@query
def channel_versions(spark, sf_dir):
    return funnel.daily_channels(inputs.funnel_tables(spark, sf_dir, MONTH_DAYS), *MONTH_DAYS)


@query
def daily_funnel(spark, sf_dir):
    """The nightly run of one day."""
    tables = inputs.funnel_tables(spark, sf_dir, (DAY, DAY))
    return _funnel_output(funnel.daily_funnel(tables, DAY))


@query
def backfill_funnel(spark, sf_dir):
    """All days of the month in one job."""
    tables = inputs.funnel_tables(spark, sf_dir, MONTH_DAYS)
    return _funnel_output(funnel.daily_funnel(tables, *MONTH_DAYS))


@query
def monthly_funnel(spark, sf_dir):
    tables = inputs.funnel_tables(spark, sf_dir, MONTH_DAYS)
    return _funnel_output(funnel.monthly_funnel(tables, MONTH))


@query
def month_pool(spark, sf_dir):
    load = inputs.Inputs(spark, sf_dir).load
    users = pool.month_pool(load("pool_days"), load("denials"), load("allocations"), MONTH)
    codes = F.array_join(F.col("deny_index_reason_arr").cast("array<string>"), ",")
    return users.withColumn("deny_index_reason_arr", codes)


@query
def paid_pool(spark, sf_dir):
    users = pool.paid_pool(inputs.paid_pool_tables(spark, sf_dir), 20240127)
    return users.withColumn("active_first_date_month", to_day_int("active_first_date_month"))


# --- messages -----------------------------------------------------------------

def _messages(spark, sf_dir):
    """Conversation turns dressed as chat messages: mentions, commands, blanks, pictures."""
    turns = table(spark, sf_dir, "conversations")
    words = F.array(*[F.lit(w) for w in MESSAGE_WORDS])
    # A command is a message of its own after a turn, not in place of its text.
    said = turns.select("conv_id", "turn", "text", F.lit(False).alias("is_command"))
    command = F.element_at(words, ((F.col("conv_id") + F.col("turn")) % len(MESSAGE_WORDS) + 1).cast("int"))
    turns = said.unionByName(said.withColumns({"text": command, "is_command": F.lit(True)}))
    turns = turns.withColumn("message_type", F.lit("text"))
    # So are a message that mentions someone and says nothing, and a picture.
    mention = said.withColumns({"text": F.lit("@_user_9 "), "message_type": F.lit("text")})
    picture = said.withColumn("message_type", F.lit("image"))
    turns = turns.unionByName(mention).unionByName(picture)
    spoken = F.col("turn") % 6
    return turns.select(
        "conv_id",
        "turn",
        "is_command",
        "message_type",
        F.when(spoken == 0, F.concat(F.lit("@_user_1  "), "text"))
        .when(spoken == 1, F.concat(F.lit(" 直接跑： "), "text", F.lit(" @_user_22")))
        .when(spoken == 2, F.concat(F.lit(" @_user_7 "), "text", F.lit("  ")))
        .when(spoken == 3, F.concat(F.lit("帮我改 "), "text"))
        .otherwise(F.col("text"))
        .alias("text"),
    )


MESSAGE_WORDS = [" 确认 ", "取消", "重置", "help", "快速模式", "看sql", "OK", "直接出数", "需要改口径", "好"]


@query
def clean_messages_query(spark, sf_dir):
    return clean_messages(_messages(spark, sf_dir), "text", "message_type").drop("message_type")


@query
def tag_intent_query(spark, sf_dir):
    cleaned = clean_messages(_messages(spark, sf_dir), "text", "message_type")
    return tag_intent(cleaned, "text").select("conv_id", "turn", "is_command", "intent", "requirement")


@query
def tolerant_json(spark, sf_dir):
    """Event properties as the answers a text service gives: bare, fenced, in prose, broken,
    followed by more, with a key twice, with a value that is no number."""
    events = table(spark, sf_dir, "events")
    chosen = F.concat(F.lit('"sql": "select '), F.get_json_object("props", "$.k"), F.lit('"'))
    answer = F.concat(F.lit('{"understanding": "k", '), chosen, F.lit("}"))
    form = F.col("event_id") % 9
    text = (
        F.when(form == 0, answer)
        .when(form == 1, F.concat(F.lit("Here:\n```json\n"), answer, F.lit("\n```\nDone.")))
        .when(form == 2, F.concat(F.lit("The answer is "), answer, F.lit(" as asked")))
        .when(form == 3, F.concat(F.lit("```\n"), answer, F.lit("\n```")))
        .when(form == 4, F.concat(answer, F.lit(" "), answer))
        .when(form == 5, F.concat(F.lit('{"sql": "old", "understanding": "k", '), chosen, F.lit("}")))
        .when(form == 6, F.concat(F.lit('{"understanding": NaN, '), chosen, F.lit("}")))
        .when(form == 7, F.concat(answer, F.lit(', "more": '), answer))
        .otherwise(F.concat(F.lit("no { answer "), F.col("event_type")))
    )
    parsed = events.select("event_id", parse_tolerant(text).alias("answer"))
    return parsed.select("event_id", "answer.understanding", "answer.sql", "answer.filename")


@query
def event_type_prefix(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    key = F.concat_ws("_", "event_type", F.lit("PaySceneEntrance"))
    return events.groupBy(event_type_of(key).alias("kind"), "event_type").agg(F.count(F.lit(1)).alias("events"))


@query
def dedup_batch(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return dedup_stream(events.unionAll(events), "event_id").select("event_id", "user_id", "event_type", "value")

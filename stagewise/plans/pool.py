"""Monthly user pools: the active pool and the paid pool."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.functions.dates import day_int_to_date, month_bounds, month_of, overlaps_days, to_day_int
from stagewise.operators.rank import first_and_latest, first_by
from stagewise.operators.rollup import (
    distinct_keys,
    distinct_sorted,
    has_value,
    min_when,
    rollup_columns,
)
from stagewise.operators.timeline import first_after_of, per_instant, suffix_sum_of
from stagewise.sources.scans import eligible_team_orders, scan_days, scan_month

# Fixed value: the clue source that counts as the middle-school team.
MIDDLE_SCHOOL = "mid_school"

USER = "active_u_user"
# Output columns in the order of the contract.
LATEST_COLUMNS = [
    "grade", "mid_stage_name", "gender", "active_user_attribution", "attribution", "u_from",
    "regist_os", "city_class", "province", "province_code", "city", "city_code", "area",
    "area_code", "real_identity",
]
FIRST_COLUMNS = [
    "user_pay_status_statistics", "user_pay_status_business", "business_user_pay_status_statistics",
    "business_user_pay_status_business", "mid_active_type", "user_allocation", "phone_range", "level",
    "before_sum_amount",
]
ROLLED_UP = {
    "push_u_user": "max", "enter_datapool_u_user": "max", "regist_time": "max",
    "user_attribution": "max", "channel": "max", "regist_app_version": "max", "regist_type": "max",
    "regist_duration": "min", "push_cnt": "sum", "datepool_cnt": "sum", "all_user_clue_cnt": "max",
    "all_add_wechat_cnt": "max",
}
MONTH_POOL_COLUMNS = [
    USER, "push_u_user", "enter_datapool_u_user", "recieve_u_user", *LATEST_COLUMNS,
    *FIRST_COLUMNS[:-1], "regist_time", "user_attribution", "channel", "regist_app_version",
    "regist_type", "regist_duration", "first_deny_reason", "first_deny_index",
    "deny_index_reason_arr", "push_cnt", "datepool_cnt", "all_user_clue_cnt", "all_add_wechat_cnt",
    "before_sum_amount", "recieve_u_user_all",
]


def month_pool(pool_days: DataFrame, denials: DataFrame, allocations: DataFrame, month: int) -> DataFrame:
    """MONTH_POOL_COLUMNS for a yyyyMM month: rollup, first and last snapshot of the
    month, first denial, all denial codes and clue sources.

    Each of the three tables is read once and meets the others as one row per user.
    """
    daily = scan_month(pool_days, month)
    users = daily.groupBy(USER).agg(
        *rollup_columns(ROLLED_UP), *first_and_latest("day", FIRST_COLUMNS, LATEST_COLUMNS)
    )
    # A missing user id is one group of the rollup but has no snapshot to join.
    known = F.col(USER).isNotNull()
    users = users.select(
        USER,
        *ROLLED_UP,
        *[F.when(known, F.col("_latest")[c]).alias(c) for c in LATEST_COLUMNS],
        *[F.when(known, F.col("_first")[c]).alias(c) for c in FIRST_COLUMNS],
    )
    denied = (
        scan_month(denials, month)
        .groupBy(F.col("user_id").alias(USER))
        .agg(
            F.min(F.struct("created_at", "deny_index", "deny_reason")).alias("_first_denial"),
            distinct_sorted(F.when(F.col("deny_index") > 0, F.col("deny_index"))).alias("deny_index_reason_arr"),
        )
        .select(
            USER,
            F.coalesce(F.col("_first_denial.deny_reason"), F.lit("")).alias("first_deny_reason"),
            F.coalesce(F.col("_first_denial.deny_index"), F.lit(0)).alias("first_deny_index"),
            "deny_index_reason_arr",
        )
    )
    received = (
        scan_month(allocations, month)
        .groupBy(F.col("user_id").alias(USER))
        .agg(has_value("clue_source", MIDDLE_SCHOOL).alias("_middle_school"))
        .withColumn("recieve_u_user_all", F.col(USER))
    )
    joined = users.join(denied, USER, "left").join(received, USER, "left")
    joined = joined.withColumn(
        "recieve_u_user", F.when(F.col("_middle_school"), F.col("recieve_u_user_all"))
    )
    return joined.select(*MONTH_POOL_COLUMNS)


# Fixed values, as above.
PAY_STATUS_COLUMNS = [
    "grade_name_month", "stage_name_month", "user_pay_status_statistics_month",
    "user_pay_status_business_month", "business_user_pay_status_statistics_month",
    "business_user_pay_status_business_month",
]
PAID_POOL_COLUMNS = [
    "active_first_date_month", "user_sk", USER, *PAY_STATUS_COLUMNS, "is_tele_belong_first_month",
    "user_allocation_month", "push_u_user", "enter_datapool_u_user", "recieve_u_user",
    "recieve_u_user_all", "active_recieve_u_user_all", "first_deny_reason", "first_deny_index",
    "recieve_paid_u_user", "recieve_paid_amount", "recieve_all_paid_u_user",
    "recieve_all_paid_amount", "active_paid_u_user_all", "active_paid_amount_all",
]


@dataclass(frozen=True)
class PaidPoolTables:
    orders: DataFrame  # user_id, pay_time, amount, workplace_id, regiment_id, worker_id, in_salary
    pay_status: DataFrame  # user_sk, day, PAY_STATUS_COLUMNS
    activity: DataFrame  # user_sk, u_user, user_allocation, day
    clues: DataFrame  # user_id, user_sk, created_at, created_sk, clue_expire_time, clue_source
    pushes: DataFrame  # user_id, deny_reason, deny_index, created_at, day
    produced: DataFrame  # userid, day


def paid_pool(tables: PaidPoolTables, day: int) -> DataFrame:
    """PAID_POOL_COLUMNS of the month of ``day``, month to date: activity -> push ->
    pool -> receive -> paid after receiving."""
    start = month_bounds(month_of(day))[0]

    status = first_by(scan_days(tables.pay_status, start, day), "user_sk", "day", PAY_STATUS_COLUMNS)
    active = first_by(
        scan_days(tables.activity, start, day).select("user_sk", "u_user", "user_allocation", "day"),
        "user_sk", "day", ["u_user", "user_allocation"],
    )
    base = status.drop("day").join(active, "user_sk")

    # Whether a clue covers the first active day. A clue that begins after the job's day or
    # ends before its month cannot; the bounds stand on the bare columns. A user's clues become one
    # array of distinct day pairs, at most one per day of the past and day of the month.
    lasting = tables.clues.where(
        (F.col("created_sk") <= day) & overlaps_days("clue_expire_time", "clue_expire_time", start, 99991230)
    )
    spans = (
        lasting.select(
            "user_sk", "created_sk", F.least(to_day_int("clue_expire_time"), F.lit(day)).alias("_expires")
        )
        .groupBy("user_sk", "_expires")
        .agg(F.min("created_sk").alias("_from"))
        .groupBy("user_sk")
        .agg(F.collect_list(F.struct("_from", "_expires")).alias("_spans"))
    )
    covered = F.exists("_spans", lambda s: F.col("day").between(s["_from"], s["_expires"]))
    base = base.join(spans, "user_sk", "left").withColumn(
        "is_tele_belong_first_month", F.when(F.coalesce(covered, F.lit(False)), 1).otherwise(0)
    )

    # A user's denial row is also the proof of having been pushed.
    pushed = first_by(
        scan_days(tables.pushes, start, day).select("user_id", "deny_reason", "deny_index", "created_at"),
        "user_id", "created_at", ["deny_index", "deny_reason"],
    )
    pushed = pushed.select(F.col("user_id").alias("push_u_user"), "deny_reason", "deny_index")
    produced = distinct_keys(scan_days(tables.produced, start, day), "userid").select(
        F.col("userid").alias("enter_datapool_u_user")
    )
    pushed = pushed.join(produced, F.col("push_u_user") == F.col("enter_datapool_u_user"), "left")

    middle = F.col("clue_source") == MIDDLE_SCHOOL
    received = (
        scan_days(tables.clues, start, day, "created_sk")
        .groupBy("user_id")
        .agg(
            F.max(F.when(middle, 1).otherwise(0)).alias("is_mid_school"),
            min_when(middle, F.col("created_at")).alias("mid_recieve_time"),
            F.min("created_at").alias("recieve_time"),
        )
    )
    orders = eligible_team_orders(tables.orders, start, day)
    instants = per_instant(orders, "user_id", "pay_time", "amount")
    amounts = (
        suffix_sum_of(instants, "user_id", "pay_time")
        .groupBy("user_id")
        .agg(F.max("amount_after").alias("active_paid_amount_all"))
    )
    after = first_after_of(
        instants, received, "user_id", "pay_time", {"_mid": "mid_recieve_time", "_all": "recieve_time"}
    )
    received = received.withColumnRenamed("user_id", "active_recieve_u_user_all")
    paid = amounts.join(after, "user_id", "left").withColumnRenamed("user_id", "active_paid_u_user_all")

    user = F.col("u_user")
    joined = (
        base.join(pushed, user == F.col("push_u_user"), "left")
        .join(received, user == F.col("active_recieve_u_user_all"), "left")
        .join(paid, user == F.col("active_paid_u_user_all"), "left")
    )
    pooled = F.col("enter_datapool_u_user").isNotNull()
    by_middle = pooled & (F.col("is_mid_school") == 1)
    by_any = pooled & F.col("active_recieve_u_user_all").isNotNull()
    return joined.withColumns(
        {
            "active_first_date_month": day_int_to_date("day"),
            USER: user,
            "user_allocation_month": F.col("user_allocation"),
            "recieve_u_user": F.when(by_middle, F.col("active_recieve_u_user_all")),
            "recieve_u_user_all": F.when(by_any, F.col("active_recieve_u_user_all")),
            "first_deny_reason": F.when(~pooled, F.col("deny_reason")),
            "first_deny_index": F.when(~pooled, F.col("deny_index")),
            "recieve_paid_u_user": F.when(by_middle & F.col("_mid_amount").isNotNull(), F.col("active_paid_u_user_all")),
            "recieve_paid_amount": F.when(by_middle, F.col("_mid_amount")),
            "recieve_all_paid_u_user": F.when(by_any & F.col("_all_amount").isNotNull(), F.col("active_paid_u_user_all")),
            "recieve_all_paid_amount": F.when(by_any, F.col("_all_amount")),
        }
    ).select(*PAID_POOL_COLUMNS)

"""Lifecycle tables derived from the given tables.

Each table is one SELECT that both Spark and the checking engine can run; the few
words they spell differently are named in ``SPARK`` and ``CHECKER``. Values are
functions of the row itself, so every table grows with the data, and edge values
(NULL, blank, 'undefined', empty lists, unknown codes) are spread over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stagewise.operators.joins import shuffled
from stagewise.plans.funnel import FunnelTables
from stagewise.plans.pool import PaidPoolTables

SPARK = {"ts_ms": "unix_millis(CAST(ts AS TIMESTAMP))", "list": "array", "ntz": "TIMESTAMP_NTZ"}
CHECKER = {"ts_ms": "epoch_us(ts) // 1000", "list": "list_value", "ntz": "TIMESTAMP"}

DAY_OF_TS = "CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INT)"

# Events with their property number; {bounds} may add a range on ts.
_KEYED = """
  SELECT event_id, ts, user_id, event_type, value, CAST(user_id AS STRING) AS uid,
         CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k, {day_of_ts} AS day
  FROM {events} WHERE event_type IN ({kinds}) {bounds}
"""

TABLES: dict[str, tuple[str, str]] = {
    # name: (event types it reads, SELECT over them)
    "frontend_events": ("'view', 'click'", """
  SELECT CASE WHEN k = 97 THEN NULL WHEN k = 98 THEN '' ELSE uid END AS u_user,
         {ts_ms} AS event_time,
         CASE WHEN k % 9 = 0 THEN 'shop-baozang-hotEnter' WHEN k % 9 = 1 THEN NULL ELSE 'scene-main' END AS scene,
         concat('option-', CAST(k % 3 AS STRING)) AS option,
         CASE event_type WHEN 'view' THEN 'get' ELSE 'click' END AS event_type,
         CASE event_type WHEN 'view' THEN 'get_PaySceneEntrance' ELSE 'click_PaySceneEntrance' END AS event_key,
         CASE WHEN k % 17 = 0 THEN NULL
              WHEN k % 17 = 1 THEN {list}()
              WHEN k % 17 = 2 THEN {list}('')
              WHEN k % 17 = 3 THEN {list}('op0, op1,,')
              WHEN k % 9 = 0 THEN {list}('434754f3-c808-4c4c-b671-f0789db1d5d1,7f53a8d4-7c46-4d23-926f-709eaa24d6bb,op0')
              ELSE {list}('op0,op1', 'op2') END AS operate_ids,
         CASE WHEN k % 19 = 0 THEN NULL
              WHEN k % 19 = 1 THEN ''
              WHEN k % 9 = 0 AND k % 2 = 0 THEN '434754f3-c808-4c4c-b671-f0789db1d5d1'
              WHEN k % 9 = 0 THEN '7f53a8d4-7c46-4d23-926f-709eaa24d6bb'
              ELSE concat(' op', CAST(k % 2 AS STRING), ' ') END AS operate_id,
         CASE WHEN k % 23 = 0 THEN NULL WHEN k % 23 = 1 THEN '' WHEN k % 23 = 2 THEN 'undefined'
              ELSE CAST(316 + k % 2 AS STRING) END AS task_id,
         CASE WHEN k % 11 = 0 THEN 'web' WHEN k % 11 = 1 THEN NULL WHEN k % 4 = 0 THEN 'android'
              WHEN k % 4 = 1 THEN 'ios' WHEN k % 4 = 2 THEN 'harmony' ELSE 'weapp' END AS os,
         CASE WHEN k % 13 = 0 THEN 'OTHER' WHEN k % 2 = 0 THEN '引流' ELSE 'DRAINAGE' END AS page_type,
         CASE WHEN k % 29 = 0 THEN '99' WHEN k % 2 = 0 THEN '01' ELSE '127' END AS product_id,
         day
  FROM keyed"""),
    "contacts": ("'signup'", """
  SELECT CASE WHEN k = 97 THEN '' ELSE uid END AS user_id,
         CAST(316 + k % 2 AS STRING) AS channel_id,
         CASE WHEN k % 12 = 0 THEN '' WHEN k % 12 = 1 THEN NULL ELSE concat('ext', uid) END AS external_user_id,
         CAST(user_id % 7 AS INT) AS worker_id,
         CASE WHEN k % 10 = 0 THEN 1 ELSE 3 END AS channel,
         ts AS created_at
  FROM keyed"""),
    "clues": ("'error'", """
  SELECT uid AS user_id, user_id + 1000000 AS user_sk, CAST(user_id % 7 AS INT) AS worker_id,
         CASE WHEN k % 14 = 0 THEN '' ELSE concat('ext', uid) END AS we_com_open_id,
         concat('clue-', CAST(event_id AS STRING)) AS info_uuid, ts AS created_at, day AS created_sk,
         ts + INTERVAL '1' DAY * (k % 10) AS clue_expire_time,
         CASE k % 4 WHEN 0 THEN 'mid_school' WHEN 1 THEN 'WeCom' WHEN 2 THEN 'building_blocks_goods_wecom'
                    ELSE 'other' END AS clue_source,
         CAST(316 + k % 2 AS STRING) AS qr_code_channel_id
  FROM keyed"""),
    # Half-day payment times, so that some users pay twice at one instant.
    "paid_orders": ("'purchase'", """
  SELECT uid AS user_id, event_id AS order_id,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL '12' HOUR * (k % 2) AS pay_time, value AS amount,
         CASE k % 5 WHEN 0 THEN 4 WHEN 1 THEN 400 WHEN 2 THEN 702 WHEN 3 THEN 4 ELSE 9 END AS workplace_id,
         CASE WHEN k % 31 = 0 THEN 303 ELSE k % 29 END AS regiment_id,
         k % 37 AS worker_id, CASE WHEN k % 41 = 0 THEN 0 ELSE 1 END AS in_salary, k % 43 = 0 AS is_test
  FROM keyed"""),
    "service_periods": ("'signup'", """
  SELECT uid AS user_id, k % 30 AS team_id, ts - INTERVAL '1' HOUR * (k % 5) AS start_time,
         ts + INTERVAL '1' HOUR * (k % 72) AS end_time
  FROM keyed"""),
    "school_periods": ("'error'", """
  SELECT uid AS user_id, ts - INTERVAL '1' DAY AS start_time, ts + INTERVAL '1' HOUR * (k % 48) AS end_time,
         CASE WHEN k % 3 = 0 THEN 'a' ELSE 'b' END AS attribution
  FROM keyed"""),
    "denials": ("'error', 'signup'", """
  SELECT uid AS user_id, CASE WHEN k % 6 = 0 THEN NULL ELSE concat('reason-', CAST(k % 5 AS STRING)) END AS deny_reason,
         CASE WHEN k % 7 = 0 THEN NULL ELSE k % 4 END AS deny_index, ts AS created_at, day
  FROM keyed"""),
    "allocations": ("'signup'", """
  SELECT uid AS user_id, CASE k % 5 WHEN 0 THEN 'mid_school' WHEN 1 THEN NULL ELSE 'other' END AS clue_source, day
  FROM keyed"""),
    "produced": ("'view'", "SELECT uid AS userid, day FROM keyed"),
    # One row per user and day.
    "activity": ("'view', 'click', 'signup', 'purchase'", """
  SELECT k.user_id + 1000000 AS user_sk, CAST(k.user_id AS STRING) AS u_user, k.day,
         CASE WHEN k.top % 5 = 0 THEN 'NO GRADE' ELSE c.c_mktsegment END AS grade,
         CASE WHEN k.top % 2 = 0 THEN 'f' ELSE 'm' END AS gender, c.c_name AS regist_time,
         concat('from-', CAST(k.low % 4 AS STRING)) AS user_attribution,
         concat('active-', CAST(k.top % 4 AS STRING)) AS active_user_attribution,
         CASE WHEN k.low % 6 = 0 THEN NULL ELSE concat('class-', CAST(k.low % 6 AS STRING)) END AS city_class,
         r.r_name AS province, n.n_name AS city, concat('stat-', CAST(k.n % 3 AS STRING)) AS user_pay_status_statistics,
         concat('biz-', CAST(k.n % 2 AS STRING)) AS user_pay_status_business,
         concat('alloc-', CAST(k.low % 3 AS STRING)) AS user_allocation
  FROM (SELECT user_id, day, max(k) AS top, min(k) AS low, count(*) AS n FROM keyed GROUP BY user_id, day) k
  LEFT JOIN {customer} c ON k.user_id = c.c_custkey
  LEFT JOIN {nation} n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN {region} r ON n.n_regionkey = r.r_regionkey"""),
    "pay_status": ("'click', 'purchase'", """
  SELECT user_id + 1000000 AS user_sk, day, concat('g', CAST(max(k) % 6 AS STRING)) AS grade_name_month,
         concat('s', CAST(max(k) % 3 AS STRING)) AS stage_name_month,
         concat('ps', CAST(min(k) % 3 AS STRING)) AS user_pay_status_statistics_month,
         concat('pb', CAST(min(k) % 4 AS STRING)) AS user_pay_status_business_month,
         concat('bs', CAST(count(*) % 3 AS STRING)) AS business_user_pay_status_statistics_month,
         concat('bb', CAST(count(*) % 2 AS STRING)) AS business_user_pay_status_business_month
  FROM keyed GROUP BY user_id, day"""),
    "pool_days": ("'view', 'click', 'signup', 'purchase', 'error'", """
  SELECT CASE WHEN low = 0 AND n > 1 THEN NULL ELSE uid END AS active_u_user, day,
         CASE WHEN top % 3 = 0 THEN uid END AS push_u_user, CASE WHEN top % 4 = 0 THEN uid END AS enter_datapool_u_user,
         concat('g', CAST(top % 6 AS STRING)) AS grade, concat('s', CAST(top % 3 AS STRING)) AS mid_stage_name,
         CASE WHEN top % 2 = 0 THEN 'f' ELSE 'm' END AS gender, concat('aa', CAST(top % 4 AS STRING)) AS active_user_attribution,
         CASE WHEN top % 7 = 0 THEN NULL ELSE concat('at', CAST(top % 7 AS STRING)) END AS attribution,
         concat('uf', CAST(low % 3 AS STRING)) AS u_from, concat('os', CAST(low % 4 AS STRING)) AS regist_os,
         concat('cc', CAST(low % 5 AS STRING)) AS city_class, concat('p', CAST(low % 6 AS STRING)) AS province,
         low % 6 AS province_code, concat('c', CAST(low % 9 AS STRING)) AS city, low % 9 AS city_code,
         concat('ar', CAST(low % 11 AS STRING)) AS area, low % 11 AS area_code,
         concat('ri', CAST(top % 2 AS STRING)) AS real_identity,
         concat('ps', CAST(n % 3 AS STRING)) AS user_pay_status_statistics, concat('pb', CAST(n % 2 AS STRING)) AS user_pay_status_business,
         concat('bs', CAST(top % 3 AS STRING)) AS business_user_pay_status_statistics,
         concat('bb', CAST(top % 2 AS STRING)) AS business_user_pay_status_business,
         concat('mt', CAST(low % 2 AS STRING)) AS mid_active_type, concat('ua', CAST(low % 3 AS STRING)) AS user_allocation,
         concat('ph', CAST(top % 10 AS STRING)) AS phone_range, low % 4 AS level, total AS before_sum_amount,
         concat('rt', CAST(10 + low AS STRING)) AS regist_time, concat('un', CAST(top % 5 AS STRING)) AS user_attribution,
         concat('ch', CAST(top % 8 AS STRING)) AS channel, concat('v', CAST(top % 12 AS STRING)) AS regist_app_version,
         concat('ty', CAST(top % 2 AS STRING)) AS regist_type, low AS regist_duration, n AS push_cnt,
         CASE WHEN top % 2 = 0 THEN n END AS datepool_cnt, top AS all_user_clue_cnt, low AS all_add_wechat_cnt
  FROM (SELECT user_id, uid, day, max(k) AS top, min(k) AS low, count(*) AS n, round(sum(value), 2) AS total
        FROM keyed GROUP BY user_id, uid, day) d"""),
}

PLAIN_TABLES = {
    "teams": "SELECT n_nationkey AS id, n_name AS name FROM {nation}",
    "grades": "SELECT DISTINCT c_mktsegment AS grade_name, concat('stage ', lower(c_mktsegment)) AS stage_name FROM {customer}",
    "channels": """
  SELECT CAST(315 + s_suppkey % 5 AS STRING) AS qr_code_id, s_name AS scene_name,
         concat('level ', CAST(s_suppkey % 3 AS STRING)) AS clue_level_name, concat('door ', s_name) AS resource_entrance_name,
         CASE WHEN s_suppkey % 7 = 0 THEN '测试类型' WHEN s_suppkey % 11 = 0 THEN NULL
              ELSE concat('type ', CAST(s_nationkey AS STRING)) END AS type_name,
         {ntz} '2023-12-20 08:00:00' + INTERVAL '1' DAY * (s_suppkey % 40) AS effective_time,
         {ntz} '2023-12-20 08:00:00' + INTERVAL '1' DAY * (s_suppkey % 40 + s_suppkey % 19) AS invalid_time,
         CASE WHEN s_suppkey % 13 = 0 THEN {ntz} '2023-12-25 00:00:00' END AS deleted_at
  FROM {supplier}""",
}

GIVEN = ("region", "nation", "customer", "supplier", "events")
GROWING = ("customer",)  # given tables that TABLES join and that grow with the data


def table_sql(name: str, words: dict[str, str], bounds: str = "") -> str:
    if name in PLAIN_TABLES:
        return PLAIN_TABLES[name].format_map(words)
    kinds, select = TABLES[name]
    keyed = _KEYED.replace("{day_of_ts}", DAY_OF_TS).replace("{kinds}", kinds).replace("{bounds}", bounds)
    return f"WITH keyed AS ({keyed.format_map(words)}) {select.format_map(words)}"


def checker_tables(*names: str) -> str:
    """Derived tables as a WITH list (without the word WITH)."""
    words = {**CHECKER, **{t: t for t in GIVEN}}
    return ",\n".join(f"{name} AS ({table_sql(name, words)})" for name in names)


class _Words(dict):
    """Spark's words; a given table becomes a view over its files when it is first named. Joins shuffle those in ``growing``."""

    def __init__(self, spark: SparkSession, sf_dir: str, growing: tuple[str, ...] = ()):
        super().__init__(SPARK)
        self.spark, self.sf_dir, self.growing = spark, sf_dir, growing

    def __missing__(self, table: str) -> str:
        if table not in GIVEN:
            raise KeyError(table)
        given = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
        if table in self.growing:
            self[table], given = f"growing_{table}", shuffled(given)
        else:
            self[table] = f"given_{table}"
        given.createOrReplaceTempView(self[table])
        return self[table]


class Inputs:
    """Derived tables as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        # A hint passes through an aggregate: a small table made of a growing one must not carry it.
        self.spark, self.words, self.plain = spark, _Words(spark, sf_dir, GROWING), _Words(spark, sf_dir)

    def load(self, name: str, days: tuple[int, int] | None = None) -> DataFrame:
        """``days`` bounds the time column of the files, as a day partition would."""
        bounds = ""
        if days is not None:
            lo, hi = (f"{str(d)[:4]}-{str(d)[4:6]}-{str(d)[6:]}" for d in days)
            bounds = f"AND ts >= '{lo} 00:00:00' AND ts <= '{hi} 23:59:59.999999'"
        return self.spark.sql(table_sql(name, self.plain if name in PLAIN_TABLES else self.words, bounds))


def funnel_tables(spark: SparkSession, sf_dir: str, days: tuple[int, int]) -> FunnelTables:
    load = Inputs(spark, sf_dir).load
    return FunnelTables(
        events=load("frontend_events", days),
        contacts=load("contacts"),
        clues=load("clues"),
        service_periods=load("service_periods"),
        teams=load("teams"),
        school_periods=load("school_periods"),
        users=load("activity", days),
        grades=load("grades"),
        orders=load("paid_orders"),
        channels=load("channels"),
    )


def paid_pool_tables(spark: SparkSession, sf_dir: str) -> PaidPoolTables:
    load = Inputs(spark, sf_dir).load
    return PaidPoolTables(
        orders=load("paid_orders"),
        pay_status=load("pay_status"),
        activity=load("activity"),
        clues=load("clues"),
        pushes=load("denials"),
        produced=load("produced"),
    )

"""SQL twins of the registered queries, for the checking engine.

They say what a query means in the most literal way, without any of the rewrites
the Spark side makes: a self-join for the reverse cumulative sum, one join per
conversion window, one pass per day for the daily funnel.
"""

from __future__ import annotations

from workload.inputs import DAY_OF_TS, checker_tables
from workload.queries import DAY, MESSAGE_WORDS, MONTH_DAYS, NULLABLE_NUMBERS

FIRST_DAY, LAST_DAY = MONTH_DAYS


def _date(day: int) -> str:
    text = str(day)
    return f"DATE '{text[:4]}-{text[4:6]}-{text[6:]}'"


def _day(expression: str) -> str:
    return DAY_OF_TS.replace("(ts)", f"({expression})")


def _with(tables: list[str], sql: str) -> str:
    """``sql`` after the derived input tables; it may open with more CTEs."""
    return f"WITH {checker_tables(*tables)}{sql}"


# Fixed values, as in stagewise.plans.funnel.
_SHOP = """CASE {0}
  WHEN '434754f3-c808-4c4c-b671-f0789db1d5d1' THEN '317' WHEN 'a975d5a8-fd34-461b-9cfb-6720d5655c09' THEN '317'
  WHEN '7f53a8d4-7c46-4d23-926f-709eaa24d6bb' THEN '316' WHEN 'e908068c-7f74-4fca-9aa6-a7b8c995dbef' THEN '316'
  WHEN '92ce6aa4-9932-4edf-a8cf-cbe4854b3ada' THEN '315' WHEN '4ae78fed-9a98-4b7f-ac20-b10c8894cc38' THEN '315' END"""

# Entrances shown and clicked; {lo} and {hi} bound the days.
_ENTRANCES = f"""
usable AS (
  SELECT * FROM frontend_events
  WHERE product_id IN ('01', '127') AND os IN ('android', 'harmony', 'ios', 'weapp') AND length(u_user) > 0
    AND day BETWEEN {{lo}} AND {{hi}}),
shown AS (
  SELECT day, u_user, event_time, scene, option, task_id, trim(item) AS operate_id
  FROM (SELECT *, unnest(string_split(coalesce(operate_ids[1], ''), ',')) AS item FROM usable
        WHERE event_key = 'get_PaySceneEntrance' AND event_type = 'get' AND page_type IN ('引流', 'DRAINAGE')
          AND task_id NOT IN ('', 'undefined'))
  UNION
  SELECT day, u_user, event_time, scene, option, {_SHOP.format('item')}, item
  FROM (SELECT *, unnest(string_split(operate_ids[1], ',')) AS item FROM usable
        WHERE event_key = 'get_PaySceneEntrance' AND event_type = 'get' AND scene = 'shop-baozang-hotEnter')
  WHERE {_SHOP.format('item')} IS NOT NULL),
clicked AS (
  SELECT day, u_user, event_time, scene, option, task_id, trim(operate_id) AS operate_id
  FROM usable
  WHERE event_key = 'click_PaySceneEntrance' AND event_type = 'click' AND page_type IN ('引流', 'DRAINAGE')
    AND task_id <> ''
  UNION
  SELECT day, u_user, event_time, scene, option, {_SHOP.format('operate_id')}, operate_id
  FROM usable
  WHERE event_key = 'click_PaySceneEntrance' AND event_type = 'click' AND scene = 'shop-baozang-hotEnter'
    AND {_SHOP.format('operate_id')} IS NOT NULL)"""


def _firsts(keys: str) -> str:
    ranked = f"row_number() OVER (PARTITION BY {keys} ORDER BY event_time, option) = 1"
    return f"""
first_shown AS (SELECT * FROM shown WHERE operate_id <> '' QUALIFY {ranked}),
first_clicked AS (SELECT * FROM clicked QUALIFY {ranked})"""


_ORDERS = """
good_orders AS (SELECT * FROM paid_orders WHERE NOT is_test AND in_salary = 1 AND worker_id <> 0)"""

_PERIODS = """
all_periods AS (
  SELECT p.user_id, t.name AS team, p.start_time, p.end_time, TRUE AS by_day
  FROM service_periods p JOIN teams t ON p.team_id = t.id
  UNION
  SELECT user_id, '入校', start_time, end_time, attribution = 'b' FROM school_periods)"""

# Output columns in the order of the contract.
_USER_COLUMNS = [
    "grade", "gender", "regist_time", "user_attribution", "active_user_attribution", "city_class",
    "province", "city", "user_pay_status_statistics", "user_pay_status_business",
]
_CHANNEL_COLUMNS = ["scene_name", "clue_level_name", "resource_entrance_name", "type_name"]


def _list(columns, prefix="", suffix=""):
    return ", ".join(f"{prefix}{c}{suffix}" for c in columns)


_TIE = _list(_USER_COLUMNS, suffix=" NULLS FIRST")


# --- day by day ----------------------------------------------------------------

def _daily_parts(lo: int, hi: int) -> str:
    def window(name: str, until: str) -> str:
        return f"""
paid_{name} AS (
  SELECT d.day, o.user_id, count(*) AS cnt, sum(o.amount) AS amount
  FROM days d JOIN good_orders o ON CAST(o.pay_time AS DATE) BETWEEN d.date AND {until}
  GROUP BY d.day, o.user_id)"""

    windows = ",".join(
        [
            window("7d", "d.date + 7"),
            window("14d", "d.date + 14"),
            window("current_month", "last_day(d.date)"),
        ]
    )
    return f"""
days AS (
  SELECT CAST(d AS DATE) AS date, CAST(strftime(d, '%Y%m%d') AS INT) AS day
  FROM (SELECT unnest(generate_series({_date(lo)}, {_date(hi)}, INTERVAL 1 DAY)) AS d)),
{_ORDERS},{windows},
touches AS (
  SELECT d.day, d.date, c.* FROM days d JOIN contacts c
    ON c.created_at >= d.date AND c.created_at <= d.date + INTERVAL '25' HOUR
  WHERE c.channel = 3 AND c.user_id <> ''),
got AS (SELECT DISTINCT day, user_id, channel_id FROM touches WHERE CAST(created_at AS DATE) = date),
added AS (SELECT DISTINCT day, user_id, worker_id, external_user_id, channel_id FROM touches
          WHERE length(external_user_id) > 0),
pulled AS (
  SELECT d.day, c.* FROM days d JOIN clues c
    ON c.created_at >= d.date AND c.created_at <= d.date + INTERVAL '25' HOUR
  WHERE length(c.we_com_open_id) > 0),
reached AS (
  SELECT g.day, g.channel_id, g.user_id AS get_wechat_user, a.user_id AS add_wechat_user,
         p.user_id AS pull_wechat_user, p.info_uuid
  FROM got g
  LEFT JOIN added a ON g.day = a.day AND g.user_id = a.user_id AND g.channel_id = a.channel_id
  LEFT JOIN pulled p ON a.day = p.day AND a.user_id = p.user_id AND a.worker_id = p.worker_id
    AND a.external_user_id = p.we_com_open_id),
day_users AS (
  SELECT u.u_user, u.day, {", ".join(f"max(u.{c}) AS {c}" for c in _USER_COLUMNS)}, max(g.stage_name) AS stage_name
  FROM activity u LEFT JOIN grades g ON u.grade = g.grade_name
  WHERE u.day BETWEEN {lo} AND {hi} GROUP BY u.u_user, u.day),
day_channels AS (
  SELECT d.day, c.qr_code_id, {_list(_CHANNEL_COLUMNS, "c.")}
  FROM days d JOIN channels c ON d.date BETWEEN CAST(c.effective_time AS DATE) AND CAST(c.invalid_time AS DATE)
  WHERE c.type_name <> '测试类型' AND c.deleted_at IS NULL
  QUALIFY row_number() OVER (PARTITION BY d.day, c.qr_code_id
                             ORDER BY c.effective_time DESC, {_list(_CHANNEL_COLUMNS, "c.")}) = 1)"""


_PAID_BY_WINDOW = "".join(
    f"""
       w{i}.user_id AS paid_{w}_user, w{i}.cnt AS paid_{w}_order_cnt, round(w{i}.amount, 2) AS paid_{w}_amount,"""
    for i, w in enumerate(["7d", "14d", "current_month"])
)
_JOIN_WINDOWS = "".join(
    f"""
  LEFT JOIN paid_{w} w{i} ON r.pull_wechat_user = w{i}.user_id AND r.day = w{i}.day"""
    for i, w in enumerate(["7d", "14d", "current_month"])
)
_FUNNEL_TABLES = [
    "frontend_events", "contacts", "clues", "paid_orders", "service_periods", "school_periods",
    "teams", "activity", "grades", "channels",
]


def _daily_funnel(lo: int, hi: int, select: str) -> str:
    return _with(
        _FUNNEL_TABLES,
        f""",
{_ENTRANCES.format(lo=lo, hi=hi)},{_firsts("day, u_user, operate_id, scene, task_id")},{_PERIODS},{_daily_parts(lo, hi)},
teamed AS (
  SELECT s.*, coalesce(p.team, '无服务期') AS team
  FROM first_shown s JOIN days d USING (day)
  LEFT JOIN all_periods p ON s.u_user = p.user_id AND p.by_day
    AND d.date BETWEEN CAST(p.start_time AS DATE) AND CAST(p.end_time AS DATE)
    AND make_timestamp(s.event_time * 1000) - INTERVAL '1' SECOND BETWEEN p.start_time AND p.end_time
  QUALIFY row_number() OVER (PARTITION BY s.day, s.u_user, s.operate_id, s.scene, s.task_id
                             ORDER BY p.start_time DESC, p.team DESC) = 1),
funnel AS (
  SELECT s.day, s.scene, s.option, s.operate_id, '引流' AS page_type, s.task_id, s.u_user AS get_entrance_user,
       c.u_user AS click_entrance_user, r.get_wechat_user, r.add_wechat_user, r.pull_wechat_user, r.info_uuid,
       {_list(_USER_COLUMNS, "u.")},{_PAID_BY_WINDOW}
       s.event_time, s.team AS before_get_entrance_team_name, {_list(_CHANNEL_COLUMNS, "h.")}, u.stage_name
  FROM teamed s
  LEFT JOIN first_clicked c ON s.day = c.day AND s.u_user = c.u_user AND s.scene = c.scene
    AND s.task_id = c.task_id AND s.operate_id = c.operate_id
  LEFT JOIN reached r ON c.day = r.day AND c.u_user = r.get_wechat_user AND c.task_id = r.channel_id
  LEFT JOIN day_users u ON s.u_user = u.u_user AND s.day = u.day{_JOIN_WINDOWS}
  LEFT JOIN day_channels h ON s.task_id = h.qr_code_id AND s.day = h.day)
{select}""",
    )


# --- whole month ---------------------------------------------------------------

_MONTHLY_PARTS = f"""{_ORDERS},
touches AS (
  SELECT * FROM contacts
  WHERE channel = 3 AND user_id <> '' AND created_at >= {_date(FIRST_DAY)}
    AND created_at <= {_date(LAST_DAY)} + INTERVAL '25' HOUR),
got AS (SELECT DISTINCT user_id, channel_id FROM touches WHERE strftime(created_at, '%Y%m') = '202401'),
added AS (SELECT DISTINCT user_id, channel_id FROM touches WHERE length(external_user_id) > 0),
pulled AS (
  SELECT user_id, qr_code_channel_id, info_uuid FROM clues
  WHERE created_at >= {_date(FIRST_DAY)} AND created_at <= {_date(LAST_DAY)} + INTERVAL '25' HOUR
    AND length(we_com_open_id) > 0 AND clue_source IN ('WeCom', 'building_blocks_goods_wecom')
  QUALIFY row_number() OVER (PARTITION BY user_id, qr_code_channel_id ORDER BY created_at, info_uuid) = 1),
reached AS (
  SELECT g.channel_id, g.user_id AS get_wechat_user, a.user_id AS add_wechat_user,
         p.user_id AS pull_wechat_user, p.info_uuid
  FROM got g LEFT JOIN added a ON g.user_id = a.user_id AND g.channel_id = a.channel_id
  LEFT JOIN pulled p ON a.user_id = p.user_id AND a.channel_id = p.qr_code_channel_id),
month_paid AS (
  SELECT user_id, count(*) AS cnt, sum(amount) AS amount FROM good_orders
  WHERE CAST(pay_time AS DATE) BETWEEN {_date(FIRST_DAY)} AND {_date(LAST_DAY)} GROUP BY user_id)"""

_MONTH_USERS = f"""
month_users AS (
  SELECT u.u_user, {_list(_USER_COLUMNS, "u.")}, g.stage_name
  FROM activity u LEFT JOIN grades g ON u.grade = g.grade_name
  WHERE u.day BETWEEN {FIRST_DAY} AND {LAST_DAY}
  QUALIFY row_number() OVER (PARTITION BY u.u_user ORDER BY u.day DESC, {_list(_USER_COLUMNS, "u.", " NULLS FIRST")}) = 1)"""

_MONTHLY_FUNNEL = _with(
    _FUNNEL_TABLES,
    f""",
{_ENTRANCES.format(lo=FIRST_DAY, hi=LAST_DAY)},{_firsts("u_user, operate_id, scene, task_id")},{_PERIODS},
{_MONTHLY_PARTS},{_MONTH_USERS},
month_channels AS (
  SELECT * FROM channels
  WHERE type_name <> '测试类型' AND deleted_at IS NULL
    AND CAST(effective_time AS DATE) <= {_date(LAST_DAY)} AND CAST(invalid_time AS DATE) >= {_date(FIRST_DAY)}
  QUALIFY row_number() OVER (PARTITION BY qr_code_id ORDER BY effective_time DESC, {_list(_CHANNEL_COLUMNS)}) = 1),
teamed AS (
  SELECT s.*, coalesce(p.team, '无服务期') AS team
  FROM first_shown s
  LEFT JOIN all_periods p ON s.u_user = p.user_id
    AND CAST(p.start_time AS DATE) <= {_date(LAST_DAY)} AND CAST(p.end_time AS DATE) >= {_date(FIRST_DAY)}
    AND make_timestamp(s.event_time * 1000) - INTERVAL '1' SECOND BETWEEN p.start_time AND p.end_time
  QUALIFY row_number() OVER (PARTITION BY s.u_user, s.operate_id, s.scene, s.task_id
                             ORDER BY p.start_time DESC, p.team DESC) = 1)
SELECT s.scene, s.option, s.operate_id, '引流' AS page_type, s.task_id, s.u_user AS get_entrance_user,
       c.u_user AS click_entrance_user, r.get_wechat_user, r.add_wechat_user, r.pull_wechat_user, r.info_uuid,
       {_list(_USER_COLUMNS, "u.")},
       o.user_id AS paid_current_month_user, o.cnt AS paid_current_month_order_cnt,
       round(o.amount, 2) AS paid_current_month_amount,
       s.event_time, s.team AS before_get_entrance_team_name, {_list(_CHANNEL_COLUMNS, "h.")}, u.stage_name
FROM teamed s
LEFT JOIN first_clicked c ON s.u_user = c.u_user AND s.scene = c.scene AND s.task_id = c.task_id
  AND s.operate_id = c.operate_id
LEFT JOIN reached r ON c.u_user = r.get_wechat_user AND c.task_id = r.channel_id
LEFT JOIN month_users u ON s.u_user = u.u_user
LEFT JOIN month_paid o ON r.pull_wechat_user = o.user_id
LEFT JOIN month_channels h ON s.task_id = h.qr_code_id""",
)

# --- pools -----------------------------------------------------------------------

# Output columns in the order of the contract.
_LATEST = [
    "grade", "mid_stage_name", "gender", "active_user_attribution", "attribution", "u_from",
    "regist_os", "city_class", "province", "province_code", "city", "city_code", "area",
    "area_code", "real_identity",
]
_FIRST = [
    "user_pay_status_statistics", "user_pay_status_business", "business_user_pay_status_statistics",
    "business_user_pay_status_business", "mid_active_type", "user_allocation", "phone_range", "level",
    "before_sum_amount",
]
_ROLLED = {
    "push_u_user": "max", "enter_datapool_u_user": "max", "regist_time": "max", "user_attribution": "max",
    "channel": "max", "regist_app_version": "max", "regist_type": "max", "regist_duration": "min",
    "push_cnt": "sum", "datepool_cnt": "sum", "all_user_clue_cnt": "max", "all_add_wechat_cnt": "max",
}

_MONTH_POOL = _with(
    ["pool_days", "denials", "allocations"],
    f""",
in_month AS (SELECT * FROM pool_days WHERE day // 100 = 202401),
totals AS (SELECT active_u_user, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" if fn == "sum" else f"{fn}({c}) AS {c}" for c, fn in _ROLLED.items())} FROM in_month GROUP BY ALL),
last_row AS (SELECT * FROM in_month QUALIFY row_number() OVER (PARTITION BY active_u_user ORDER BY day DESC) = 1),
first_row AS (SELECT * FROM in_month QUALIFY row_number() OVER (PARTITION BY active_u_user ORDER BY day) = 1),
first_denial AS (
  SELECT user_id, coalesce(deny_reason, '') AS reason, coalesce(deny_index, 0) AS idx FROM denials
  WHERE day // 100 = 202401
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY created_at) = 1),
codes AS (
  SELECT user_id, array_to_string(list_sort(list(DISTINCT deny_index)), ',') AS arr FROM denials
  WHERE day // 100 = 202401 AND deny_index > 0 GROUP BY user_id),
sources AS (
  SELECT user_id, count(*) FILTER (WHERE clue_source = 'mid_school') AS mid FROM allocations
  WHERE day // 100 = 202401 GROUP BY user_id)
SELECT t.*, {_list(_LATEST, "l.")}, {_list(_FIRST, "f.")},
       CASE WHEN s.mid > 0 THEN s.user_id END AS recieve_u_user, s.user_id AS recieve_u_user_all,
       d.reason AS first_deny_reason, d.idx AS first_deny_index, c.arr AS deny_index_reason_arr
FROM totals t
LEFT JOIN last_row l ON t.active_u_user = l.active_u_user
LEFT JOIN first_row f ON t.active_u_user = f.active_u_user
LEFT JOIN first_denial d ON t.active_u_user = d.user_id
LEFT JOIN codes c ON t.active_u_user = c.user_id
LEFT JOIN sources s ON t.active_u_user = s.user_id""",
)

# Output columns in the order of the contract.
_STATUS = [
    "grade_name_month", "stage_name_month", "user_pay_status_statistics_month",
    "user_pay_status_business_month", "business_user_pay_status_statistics_month",
    "business_user_pay_status_business_month",
]
_PAID_UNTIL = 20240127

_PAID_POOL = _with(
    ["paid_orders", "pay_status", "activity", "clues", "denials", "produced"],
    f""",
span AS (SELECT {FIRST_DAY} AS lo, {_PAID_UNTIL} AS hi),
team_orders AS (
  SELECT user_id, pay_time, amount FROM paid_orders, span
  WHERE workplace_id IN (4, 400, 702) AND regiment_id NOT IN (0, 303, 546) AND worker_id <> 0 AND in_salary = 1
    AND CAST(strftime(pay_time, '%Y%m%d') AS INT) BETWEEN lo AND hi),
entries AS (
  SELECT a.user_id, a.pay_time, round(sum(b.amount), 2) AS after
  FROM team_orders a JOIN team_orders b ON a.user_id = b.user_id AND a.pay_time <= b.pay_time
  GROUP BY a.user_id, a.pay_time),
spent AS (SELECT user_id, max(after) AS amount FROM entries GROUP BY user_id),
status AS (SELECT * FROM pay_status, span WHERE day BETWEEN lo AND hi
           QUALIFY row_number() OVER (PARTITION BY user_sk ORDER BY day) = 1),
active AS (SELECT * FROM activity, span WHERE day BETWEEN lo AND hi
           QUALIFY row_number() OVER (PARTITION BY user_sk ORDER BY day) = 1),
pushes AS (SELECT * FROM denials, span WHERE day BETWEEN lo AND hi
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY created_at) = 1),
pooled AS (SELECT DISTINCT userid FROM produced, span WHERE day BETWEEN lo AND hi),
received AS (
  SELECT user_id, bool_or(clue_source = 'mid_school') AS mid, min(created_at) AS any_at,
         min(created_at) FILTER (WHERE clue_source = 'mid_school') AS mid_at
  FROM clues, span WHERE created_sk BETWEEN lo AND hi GROUP BY user_id),
people AS (
  SELECT a.day AS active_first_date_month, a.user_sk, a.u_user AS active_u_user,
         {_list(_STATUS, "s.")}, a.user_allocation AS user_allocation_month,
         CASE WHEN EXISTS (SELECT 1 FROM clues c WHERE c.user_sk = a.user_sk
                           AND a.day BETWEEN c.created_sk AND CAST(strftime(c.clue_expire_time, '%Y%m%d') AS INT))
              THEN 1 ELSE 0 END AS is_tele_belong_first_month,
         p.user_id AS push_u_user, q.userid AS enter_datapool_u_user, p.deny_reason, p.deny_index,
         r.user_id AS receiver, r.mid, r.mid_at, r.any_at, o.user_id AS payer, o.amount AS active_paid_amount_all
  FROM status s JOIN active a ON s.user_sk = a.user_sk
  LEFT JOIN pushes p ON a.u_user = p.user_id
  LEFT JOIN pooled q ON p.user_id = q.userid
  LEFT JOIN received r ON a.u_user = r.user_id
  LEFT JOIN spent o ON a.u_user = o.user_id),
valued AS (
  SELECT *, enter_datapool_u_user IS NOT NULL AND receiver IS NOT NULL AS got_any,
         enter_datapool_u_user IS NOT NULL AND coalesce(mid, FALSE) AS got_mid,
         (SELECT arg_min(e.after, e.pay_time) FROM entries e WHERE e.user_id = payer AND e.pay_time > mid_at) AS mid_amount,
         (SELECT arg_min(e.after, e.pay_time) FROM entries e WHERE e.user_id = payer AND e.pay_time > any_at) AS any_amount
  FROM people)
SELECT active_first_date_month, user_sk, active_u_user, {_list(_STATUS)}, is_tele_belong_first_month,
       user_allocation_month, push_u_user, enter_datapool_u_user,
       CASE WHEN got_mid THEN receiver END AS recieve_u_user, CASE WHEN got_any THEN receiver END AS recieve_u_user_all,
       receiver AS active_recieve_u_user_all,
       CASE WHEN enter_datapool_u_user IS NULL THEN deny_reason END AS first_deny_reason,
       CASE WHEN enter_datapool_u_user IS NULL THEN deny_index END AS first_deny_index,
       CASE WHEN got_mid AND mid_amount IS NOT NULL THEN payer END AS recieve_paid_u_user,
       CASE WHEN got_mid THEN mid_amount END AS recieve_paid_amount,
       CASE WHEN got_any AND any_amount IS NOT NULL THEN payer END AS recieve_all_paid_u_user,
       CASE WHEN got_any THEN any_amount END AS recieve_all_paid_amount,
       payer AS active_paid_u_user_all, active_paid_amount_all
FROM valued""",
)

# --- messages ----------------------------------------------------------------------

_WORDS = ", ".join(f"'{w}'" for w in MESSAGE_WORDS)
_MESSAGES = rf"""
said AS (
  SELECT conv_id, turn, FALSE AS is_command, 'text' AS message_type, text FROM conversations
  UNION ALL
  SELECT conv_id, turn, TRUE, 'text', list_extract([{_WORDS}], (conv_id + turn) % {len(MESSAGE_WORDS)} + 1) FROM conversations
  UNION ALL
  SELECT conv_id, turn, FALSE, 'text', '@_user_9 ' FROM conversations
  UNION ALL
  SELECT conv_id, turn, FALSE, 'image', text FROM conversations),
raw AS (
  SELECT conv_id, turn, is_command, CASE turn % 6
           WHEN 0 THEN '@_user_1  ' || text
           WHEN 1 THEN ' 直接跑： ' || text || ' @_user_22'
           WHEN 2 THEN ' @_user_7 ' || text || '  '
           WHEN 3 THEN '帮我改 ' || text
           ELSE text END AS text
  FROM said WHERE message_type = 'text'),
messages AS (
  SELECT conv_id, turn, is_command, regexp_replace(regexp_replace(text, '@_user_\d+\s*', '', 'g'), '^\s+|\s+$', '', 'g') AS text
  FROM raw WHERE regexp_matches(regexp_replace(text, '@_user_\d+\s*', '', 'g'), '\S'))"""

# Fixed values, as in stagewise.functions.text.
_INTENTS = """CASE
  WHEN text IN ('重置', '重新开始', '清空', '新查询', '重新查询', 'reset') THEN 'reset'
  WHEN text IN ('帮助', 'help', '用法', '使用说明') THEN 'help'
  WHEN text IN ('快速模式', '不需要确认', '不用确认', '不需要sql', '不用sql', '跳过sql', '直接出数模式', '快速出数') THEN 'fast_mode_on'
  WHEN text IN ('审查模式', '需要确认', '看sql', '要确认sql', '恢复确认') THEN 'fast_mode_off'
  WHEN text IN ('确认', '执行', '跑', 'ok', 'OK', '可以', '没问题', '对', 'yes', 'Yes', '好') THEN 'confirm'
  WHEN text IN ('取消', '算了', '不用了', '放弃') THEN 'cancel'
  WHEN regexp_matches(text, '^(修改|改一下|帮我改|调整|需要改)') THEN 'modify'
  WHEN regexp_matches(text, '^(直接跑|直接执行|直接出数|跳过确认)') THEN 'fast_query'
  ELSE 'query' END"""

_SUFFIX = """
after AS (
  SELECT a.o_custkey, a.o_orderdate, {value} AS amount_after
  FROM {rows} a JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderdate >= a.o_orderdate
  GROUP BY a.o_custkey, a.o_orderdate)"""
_DATED = "SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, amount_after FROM after"
_SUFFIX_TIES = _SUFFIX.format(value="round(sum(b.o_totalprice), 2)", rows="orders")
_SUFFIX_CLEAN = _SUFFIX.format(
    value="round(sum(b.o_totalprice), 2)", rows="(SELECT DISTINCT o_custkey, o_orderdate FROM orders)"
)


def _pay_after(name: str, instant: str) -> str:
    return f"""
  (SELECT {instant}(ts) FROM events s WHERE s.event_type = 'signup' AND s.user_id = u.user_id) AS {name}"""


ORACLE_SQL: dict[str, str] = {
    "event_scan_pruned": f"""
SELECT event_id, user_id, event_type, value, {DAY_OF_TS} AS day FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16' AND event_type IN ('view', 'click')""",
    "month_scan": f"""
SELECT o_orderpriority, count(*) AS month_orders, round(sum(o_totalprice), 2) AS month_amount,
       round(sum(o_totalprice) FILTER (WHERE day(o_orderdate) <= 15), 2) AS mid_month_amount
FROM orders WHERE {_day('o_orderdate')} // 100 = 199703 GROUP BY o_orderpriority""",
    "month_to_date_scan": f"""
SELECT o_orderkey, o_custkey, {_day('o_orderdate')} AS day FROM orders
WHERE {_day('o_orderdate')} BETWEEN 19970301 AND 19970315""",
    "eligible_orders": _with(["paid_orders"], f"""
SELECT order_id, user_id, amount,
       CASE WHEN workplace_id IN (4, 400, 702) AND regiment_id NOT IN (0, 303, 546) THEN 1 ELSE 0 END AS counts_for_team
FROM paid_orders
WHERE is_test = FALSE AND in_salary = 1 AND worker_id <> 0
  AND CAST(pay_time AS DATE) BETWEEN {_date(FIRST_DAY)} AND {_date(LAST_DAY)}"""),
    "guarded_scan": f"""
SELECT event_id, user_id, {DAY_OF_TS} AS day FROM events
WHERE event_type = 'click' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'""",
    "adhoc_sql": """
SELECT c.c_mktsegment, count(s.o_custkey) AS buyers, CAST(sum(s.n) AS BIGINT) AS orders, round(sum(s.amount), 2) AS amount
FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS amount
                           FROM orders GROUP BY o_custkey) s ON c.c_custkey = s.o_custkey
GROUP BY c.c_mktsegment""",
    "first_event_by_key": f"""
SELECT {DAY_OF_TS} AS day, user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id, event_type ORDER BY ts, event_id) = 1""",
    "latest_event_by_key": """
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1""",
    "first_and_latest_snapshot": """
WITH ranked AS (
  SELECT *, year(ts) * 100 + month(ts) AS month,
         row_number() OVER (PARTITION BY user_id, year(ts), month(ts) ORDER BY ts, event_id) AS up,
         row_number() OVER (PARTITION BY user_id, year(ts), month(ts) ORDER BY ts DESC, event_id DESC) AS down
  FROM events)
SELECT f.user_id, CAST(f.month AS INT) AS month, f.event_id AS first_event_id, f.event_type AS first_event_type,
       f.value AS first_value, l.event_id AS latest_event_id, l.event_type AS latest_event_type, l.value AS latest_value
FROM ranked f JOIN ranked l ON f.user_id = l.user_id AND f.month = l.month WHERE f.up = 1 AND l.down = 1""",
    "latest_n_turns": """
SELECT * FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role, text) <= 3""",
    "latest_dozen_events": """
SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) <= 12""",
    "exposure_union": _with(["frontend_events"], f""",
{_ENTRANCES.format(lo=FIRST_DAY, hi=LAST_DAY)},{_firsts("day, u_user, operate_id, scene, task_id")}
SELECT day, u_user, scene, task_id, operate_id, event_time, option FROM first_shown"""),
    "click_union": _with(["frontend_events"], f""",
{_ENTRANCES.format(lo=FIRST_DAY, hi=LAST_DAY)},{_firsts("u_user, operate_id, scene, task_id")}
SELECT u_user, scene, task_id, operate_id, event_time FROM first_clicked"""),
    "period_union": _with(["service_periods", "school_periods"], """
SELECT user_id, CAST(team_id AS STRING) AS team, strftime(start_time, '%Y-%m-%d %H') AS start_hour FROM service_periods
UNION
SELECT user_id, attribution, strftime(start_time, '%Y-%m-%d %H') FROM school_periods"""),
    "explode_list": """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS item FROM part""",
    "interval_at_event": _with(["service_periods"], """
SELECT e.event_id, CAST(e.user_id AS STRING) AS user_id, coalesce(p.team_id, -1) AS team_id
FROM events e LEFT JOIN service_periods p ON CAST(e.user_id AS STRING) = p.user_id AND e.ts BETWEEN p.start_time AND p.end_time
WHERE e.event_type = 'click'
QUALIFY row_number() OVER (PARTITION BY e.event_id ORDER BY p.start_time DESC, p.team_id DESC) = 1"""),
    "valid_on_date": _with(["service_periods", "teams"], f"""
SELECT t.name AS team, count(*) AS periods FROM service_periods p JOIN teams t ON p.team_id = t.id
WHERE {_date(DAY)} BETWEEN CAST(p.start_time AS DATE) AND CAST(p.end_time AS DATE) GROUP BY t.name"""),
    "overlaps_month": _with(["channels"], f"""
SELECT qr_code_id, scene_name, type_name FROM channels
WHERE NOT (CAST(effective_time AS DATE) > {_date(LAST_DAY)} OR CAST(invalid_time AS DATE) < {_date(FIRST_DAY)})"""),
    "asof_dimension": """
WITH latest AS (
  SELECT * FROM orders
  WHERE o_orderdate <= DATE '1998-12-31' AND o_orderdate + INTERVAL '120' DAY >= DATE '1998-12-01'
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1)
SELECT c.c_custkey, c.c_mktsegment, l.o_orderkey, l.o_orderpriority
FROM customer c LEFT JOIN latest l ON c.c_custkey = l.o_custkey""",
    "suffix_sum": f"WITH {_SUFFIX_TIES} {_DATED}",
    "suffix_sum_without_ties": f"WITH {_SUFFIX_CLEAN} {_DATED}",
    "pay_timeline": f"""
WITH {_SUFFIX_TIES}
SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, amount_after,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS position
FROM after""",
    "paid_amount_by_user": f"WITH {_SUFFIX_TIES} SELECT o_custkey, max(amount_after) AS amount FROM after GROUP BY o_custkey",
    "first_pay_after": f"""
WITH paid AS (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase'),
entries AS (
  SELECT a.user_id, a.ts, round(sum(b.value), 2) AS after
  FROM paid a JOIN paid b ON a.user_id = b.user_id AND b.ts >= a.ts GROUP BY a.user_id, a.ts),
users AS (SELECT DISTINCT user_id FROM paid SEMI JOIN (SELECT user_id FROM events WHERE event_type = 'signup') USING (user_id)),
dated AS (SELECT u.user_id,{_pay_after('first_signup', 'min')},{_pay_after('last_signup', 'max')} FROM users u)
SELECT d.user_id,
       (SELECT {_day('min(e.ts)')} FROM entries e WHERE e.user_id = d.user_id AND e.ts > first_signup) AS first_day,
       (SELECT arg_min(after, e.ts) FROM entries e WHERE e.user_id = d.user_id AND e.ts > first_signup) AS first_amount,
       (SELECT arg_min(after, e.ts) FROM entries e WHERE e.user_id = d.user_id AND e.ts > last_signup) AS last_amount
FROM dated d""",
    "conversion_windows": _with(["paid_orders", "contacts", "clues", "activity", "grades", "channels"], f""",
{_daily_parts(FIRST_DAY, LAST_DAY)}
SELECT user_id, day, a.cnt AS paid_7d_order_cnt, round(a.amount, 2) AS paid_7d_amount, b.cnt AS paid_14d_order_cnt,
       round(b.amount, 2) AS paid_14d_amount, c.cnt AS paid_current_month_order_cnt,
       round(c.amount, 2) AS paid_current_month_amount
FROM paid_7d a FULL JOIN paid_14d b USING (user_id, day) FULL JOIN paid_current_month c USING (user_id, day)"""),
    "conversion_month": _with(["paid_orders"], f""",
{_ORDERS}
SELECT user_id, count(*) AS paid_month_order_cnt, round(sum(amount), 2) AS paid_month_amount FROM good_orders
WHERE CAST(pay_time AS DATE) BETWEEN {_date(FIRST_DAY)} AND {_date(LAST_DAY)} GROUP BY user_id"""),
    "user_rollup": f"""
SELECT user_id, CAST(year(ts) * 100 + month(ts) AS INT) AS month, max(event_id) AS event_id, max(event_type) AS last_type,
       {_day('min(ts)')} AS ts, round(sum(value), 2) AS value
FROM events GROUP BY user_id, year(ts) * 100 + month(ts)""",
    "attribute_collapse": _with(["activity"], f"""
SELECT u_user, {", ".join(f"max({c}) AS {c}" for c in _USER_COLUMNS)} FROM activity GROUP BY u_user"""),
    "value_set_sorted": _with(["denials"], """
SELECT user_id, day, array_to_string(list_sort(list(DISTINCT deny_index) FILTER (WHERE deny_index > 0)), ',') AS codes
FROM denials GROUP BY user_id, day"""),
    "has_value": f"""
SELECT user_id, {DAY_OF_TS} AS day, list_contains(list(event_type), 'purchase') AS paid,
       list_contains(list(event_type), 'signup') AS joined FROM events GROUP BY ALL""",
    "cond_min_max": f"""
SELECT user_id, {DAY_OF_TS} AS day, max(value) FILTER (WHERE event_type = 'purchase') AS largest_payment,
       min(event_id) FILTER (WHERE event_type = 'purchase') AS first_payment,
       CAST(bool_or(event_type = 'purchase') AS INT) AS has_paid
FROM events GROUP BY ALL""",
    "distinct_keys": f"SELECT DISTINCT user_id, {DAY_OF_TS} AS day, event_type FROM events",
    "member_flags": """
SELECT c_custkey, c_mktsegment,
       CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 1 ELSE 0 END AS has_order,
       CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') THEN 1 ELSE 0 END AS has_urgent_order
FROM customer""",
    "dim_enrich": """
SELECT c.c_custkey, n.n_name, r.r_name, CASE WHEN c.c_acctbal > 0 THEN n.n_name END AS nation_in_credit, s.orders, s.amount
FROM customer c
LEFT JOIN (SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY 1) s
  ON c.c_custkey = s.o_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "stage_funnel": f"""
WITH did AS (SELECT DISTINCT user_id, {DAY_OF_TS} AS day, event_type FROM events)
SELECT v.day, v.user_id AS view_user, c.user_id AS click_user, p.user_id AS purchase_user
FROM did v
LEFT JOIN did c ON c.event_type = 'click' AND v.user_id = c.user_id AND v.day = c.day
LEFT JOIN did p ON p.event_type = 'purchase' AND c.user_id = p.user_id AND c.day = p.day
WHERE v.event_type = 'view'""",
    "contact_funnel": _with(["paid_orders", "contacts", "clues", "activity", "grades", "channels"], f""",
{_daily_parts(FIRST_DAY, LAST_DAY)}
SELECT r.day, r.channel_id, r.get_wechat_user, r.add_wechat_user, r.pull_wechat_user, r.info_uuid,
       {", ".join(f"w{i}.cnt AS paid_{w}_order_cnt, round(w{i}.amount, 2) AS paid_{w}_amount"
                  for i, w in enumerate(["7d", "14d", "current_month"]))}
FROM reached r{_JOIN_WINDOWS}"""),
    "contact_funnel_month": _with(["paid_orders", "contacts", "clues"], f""",
{_MONTHLY_PARTS}
SELECT r.*, o.cnt AS paid_current_month_order_cnt, round(o.amount, 2) AS paid_current_month_amount
FROM reached r LEFT JOIN month_paid o ON r.pull_wechat_user = o.user_id"""),
    "team_at_exposure": _daily_funnel(
        FIRST_DAY, LAST_DAY,
        "SELECT day, u_user, scene, task_id, operate_id, team FROM teamed",
    ),
    "daily_users": _with(["paid_orders", "contacts", "clues", "activity", "grades", "channels"], f""",
{_daily_parts(FIRST_DAY, LAST_DAY)}
SELECT * FROM day_users"""),
    "monthly_users": _with(["activity", "grades"], f""",
{_MONTH_USERS}
SELECT * FROM month_users"""),
    "channel_versions": _with(["paid_orders", "contacts", "clues", "activity", "grades", "channels"], f""",
{_daily_parts(FIRST_DAY, LAST_DAY)}
SELECT * FROM day_channels"""),
    "daily_funnel": _daily_funnel(DAY, DAY, "SELECT * FROM funnel"),
    "backfill_funnel": _daily_funnel(FIRST_DAY, LAST_DAY, "SELECT * FROM funnel"),
    "monthly_funnel": _MONTHLY_FUNNEL,
    "month_pool": _MONTH_POOL,
    "paid_pool": _PAID_POOL,
    "clean_messages": f"WITH {_MESSAGES} SELECT * FROM messages",
    "tag_intent": f"""
WITH {_MESSAGES}
SELECT conv_id, turn, is_command, {_INTENTS} AS intent,
       CASE WHEN {_INTENTS} = 'fast_query'
            THEN regexp_replace(text, '^(直接跑|直接执行|直接出数|跳过确认)[：: ]*', '') END AS requirement
FROM messages""",
    # The first candidate that is one valid JSON value counts; of a key named twice, the last.
    "tolerant_json": r"""
WITH part AS (
  SELECT event_id, event_type, concat('"sql": "select ', regexp_extract(props, '[0-9]+'), '"') AS chosen FROM events),
answer AS (SELECT *, concat('{"understanding": "k", ', chosen, '}') AS whole FROM part),
said AS (
  SELECT event_id, CASE event_id % 9
      WHEN 0 THEN whole
      WHEN 1 THEN concat('Here:', chr(10), '```json', chr(10), whole, chr(10), '```', chr(10), 'Done.')
      WHEN 2 THEN concat('The answer is ', whole, ' as asked')
      WHEN 3 THEN concat('```', chr(10), whole, chr(10), '```')
      WHEN 4 THEN concat(whole, ' ', whole)
      WHEN 5 THEN concat('{"sql": "old", "understanding": "k", ', chosen, '}')
      WHEN 6 THEN concat('{"understanding": NaN, ', chosen, '}')
      WHEN 7 THEN concat(whole, ', "more": ', whole)
      ELSE concat('no { answer ', event_type) END AS text FROM answer),
tried AS (
  SELECT event_id, list_filter(
      [text, regexp_extract(text, '(?s)```(?:json)?\s*\n?(.*?)\n?```', 1), regexp_extract(text, '(?s)\{.*\}', 0)],
      lambda x: x <> '' AND json_valid(replace(x, 'NaN', '"NaN"')))[1] AS found FROM said)
SELECT event_id,
       CASE WHEN found IS NULL THEN 'AI 返回格式异常，请重试'
            ELSE regexp_extract(found, '(?s).*"understanding": "?([^",}]*)', 1) END AS understanding,
       CASE WHEN found IS NULL THEN '' ELSE regexp_extract(found, '(?s).*"sql": "([^"]*)"', 1) END AS sql,
       CAST(NULL AS STRING) AS filename
FROM tried""",
    "event_type_prefix": """
SELECT CASE WHEN event_type IN ('click', 'dev', 'get', 'enter', 'popup') THEN event_type ELSE 'other' END AS kind,
       event_type, count(*) AS events FROM events GROUP BY ALL""",
    "dedup_batch": "SELECT event_id, user_id, event_type, value FROM events",
}

for _name, _columns in NULLABLE_NUMBERS.items():
    _casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _columns)
    ORACLE_SQL[_name] = f"SELECT * REPLACE ({_casts}) FROM ({ORACLE_SQL[_name]})"

"""The same results in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

from checks.queries import (
    ALL_DAYS,
    BAN_ABOVE,
    BIG_ALLOWANCE,
    FILTERS,
    LEVELS,
    SEED,
    SOME_DAYS,
    TASK,
    TWO_DAYS,
)
from shoptrail import fixed_values as fixed


def _actions(task: dict) -> str:
    return f"""
e AS (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
        (hour(ts) * 3600 + minute(ts) * 60 + second(ts)) // 24 AS s
      FROM events
      WHERE CAST(ts AS DATE) BETWEEN DATE '{task["startDate"]}' AND DATE '{task["endDate"]}'),
a AS (SELECT strftime(ts, '%Y-%m-%d') AS date, user_id,
        user_id || '_' || strftime(ts, '%Y%m%d') AS session_id,
        event_id % 10 AS page_id,
        date_trunc('day', ts) + to_hours(user_id % 23) + to_seconds(s) AS t,
        CASE WHEN event_type = 'view' THEN 'kw' || (k % 10) END AS search_keyword,
        CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_category_id,
        CASE WHEN event_type = 'click' THEN event_id % 100 ELSE -1 END AS click_product_id,
        CASE WHEN event_type = 'purchase' THEN k || ',' || ((k + 1) % 100) END AS order_category_ids,
        CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS VARCHAR) END AS order_product_ids,
        CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
        CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS VARCHAR) END AS pay_product_ids,
        user_id % 25 AS city_id, event_id
      FROM e)"""


def _sessions(task: dict) -> str:
    return f"""{_actions(task)},
r AS (SELECT session_id, arg_min(user_id, (t, event_id)) AS user_id, min(t) AS t0, max(t) AS t1,
        count(*) AS step_length,
        CAST(floor(epoch(max(t)) - epoch(min(t))) AS BIGINT) AS visit_length,
        coalesce(string_agg(DISTINCT search_keyword, ',' ORDER BY search_keyword), '') AS search_keywords,
        coalesce(array_to_string(list_sort(list(DISTINCT click_category_id)
          FILTER (click_category_id <> -1)), ','), '') AS click_category_ids,
        coalesce(list(DISTINCT search_keyword) FILTER (search_keyword IS NOT NULL), []) AS kws,
        coalesce(list(DISTINCT click_category_id) FILTER (click_category_id <> -1), []) AS cats
      FROM a GROUP BY session_id),
u AS (SELECT c_custkey AS user_id, CAST(c_custkey % 60 AS INTEGER) AS age, c_mktsegment AS professional,
        'city' || c_nationkey AS city,
        CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
      FROM customer),
full_s AS (SELECT r.*, u.age, u.professional, u.city, u.sex FROM r JOIN u USING (user_id)),
kept AS (SELECT * FROM full_s WHERE {_condition(task)})"""


def _texts(values: str) -> str:
    return ", ".join(f"'{v}'" for v in values.split(","))


def _condition(task: dict) -> str:
    parts = ["TRUE"]
    if "startAge" in task:
        parts.append(f"age BETWEEN {task['startAge']} AND {task['endAge']}")
    if "professionals" in task:
        parts.append(f"professional IN ({_texts(task['professionals'])})")
    if "cities" in task:
        parts.append(f"city IN ({_texts(task['cities'])})")
    if "sex" in task:
        parts.append(f"sex = '{task['sex']}'")
    if "keywords" in task:
        parts.append(f"list_has_any(kws, [{_texts(task['keywords'])}])")
    if "categoryIds" in task:
        parts.append(f"list_has_any(cats, [{task['categoryIds']}])")
    return " AND ".join(parts)


_TIME = "'%Y-%m-%d %H:%M:%S'"


def _session_rows(task: dict) -> str:
    return f"""WITH {_sessions(task)}
SELECT session_id, user_id, strftime(t0, {_TIME}) AS start_time, strftime(t1, {_TIME}) AS end_time,
  visit_length, step_length, search_keywords, click_category_ids, age, professional, city, sex
FROM kept"""


_VISITS = [
    ("visit_length_1s_3s", "BETWEEN 1 AND 3", "BETWEEN 1 AND 3"),
    ("visit_length_4s_6s", "BETWEEN 5 AND 6", "BETWEEN 4 AND 6"),
    ("visit_length_7s_9s", "BETWEEN 8 AND 9", "BETWEEN 7 AND 9"),
    ("visit_length_10s_30s", "BETWEEN 11 AND 30", "BETWEEN 10 AND 30"),
    ("visit_length_30s_60s", "BETWEEN 31 AND 60", "BETWEEN 31 AND 60"),
    ("visit_length_1m_3m", "BETWEEN 61 AND 180", "BETWEEN 61 AND 180"),
    ("visit_length_3m_10m", "BETWEEN 181 AND 600", "BETWEEN 181 AND 600"),
    ("visit_length_10m_30m", "BETWEEN 601 AND 1800", "BETWEEN 601 AND 1800"),
    ("visit_length_30m", "> 1800", "> 1800"),
]
_STEPS = [
    ("step_length_1_3", "BETWEEN 2 AND 3", "BETWEEN 1 AND 3"),
    ("step_length_4_6", "BETWEEN 5 AND 6", "BETWEEN 4 AND 6"),
    ("step_length_7_9", "BETWEEN 8 AND 9", "BETWEEN 7 AND 9"),
    ("step_length_10_30", "BETWEEN 11 AND 30", "BETWEEN 10 AND 30"),
    ("step_length_30_60", "BETWEEN 31 AND 60", "BETWEEN 31 AND 60"),
    ("step_length_60", "> 60", "> 60"),
]


def _bucket_counts(closed: bool) -> list[tuple[str, str]]:
    """Bucket name and its count; ratios round half up in whole numbers."""
    buckets = [("visit_length", b) for b in _VISITS] + [("step_length", b) for b in _STEPS]
    return [(name, f"count(*) FILTER ({column} {(b if closed else a)})") for column, (name, a, b) in buckets]


def _ratio(count: str, total: str) -> str:
    return f"((200 * {count} + {total}) // (2 * {total})) / 100.0"


def _ratios(closed: bool) -> str:
    total = "greatest(count(*), 1)"
    columns = ", ".join(f"{_ratio(count, total)} AS {name}_ratio" for name, count in _bucket_counts(closed))
    return f"WITH {_sessions(ALL_DAYS)} SELECT '{TASK}' AS taskid, count(*) AS session_count, {columns} FROM kept"


def _long() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS bucket, {count} AS sessions, {_ratio(count, 'greatest(count(*), 1)')} AS ratio FROM kept"
        for name, count in _bucket_counts(False)
    )
    return f"WITH {_sessions(ALL_DAYS)} {rows}"


def _quota(task: dict, allowance: int) -> str:
    return f"""{_sessions(task)},
hours AS (SELECT strftime(t0, '%Y-%m-%d') AS date, strftime(t0, '%H') AS hour, count(*) AS session_count
          FROM kept GROUP BY ALL),
days AS (SELECT date, sum(session_count) AS day_count FROM hours GROUP BY date),
quota AS (SELECT date, hour, session_count,
            least(CAST(floor(CAST(session_count AS DOUBLE) / CAST(day_count AS DOUBLE)
              * ({allowance} // (SELECT count(*) FROM days))) AS BIGINT), session_count) AS quota
          FROM hours JOIN days USING (date)),
drawn AS (SELECT kept.*, row_number() OVER (
            PARTITION BY strftime(t0, '%Y-%m-%d'), strftime(t0, '%H')
            ORDER BY md5(session_id || '|{SEED}'), session_id) AS draw
          FROM kept),
sample AS (SELECT drawn.* FROM drawn JOIN quota
             ON quota.date = strftime(t0, '%Y-%m-%d') AND quota.hour = strftime(t0, '%H')
           WHERE draw <= quota)"""


def _sample(task: dict, allowance: int) -> str:
    return f"""WITH {_quota(task, allowance)}
SELECT '{TASK}' AS taskid, session_id AS sessionid, strftime(t0, {_TIME}) AS "startTime",
  search_keywords AS "searchKeywords", click_category_ids AS "clickCategoryIds" FROM sample"""


def _categories(extra: str = "") -> str:
    return f"""WITH {_sessions(ALL_DAYS)},
ka AS (SELECT a.* FROM a WHERE session_id IN (SELECT session_id FROM kept)),
clicks AS (SELECT click_category_id AS categoryid, count(*) AS n FROM ka WHERE click_category_id <> -1 GROUP BY 1),
orders_ AS (SELECT CAST(c AS BIGINT) AS categoryid, count(*) AS n
            FROM (SELECT unnest(string_split(order_category_ids, ',')) AS c FROM ka) GROUP BY 1),
pays AS (SELECT CAST(c AS BIGINT) AS categoryid, count(*) AS n
         FROM (SELECT unnest(string_split(pay_category_ids, ',')) AS c FROM ka) GROUP BY 1),
ids AS (SELECT categoryid FROM clicks UNION SELECT categoryid FROM orders_ UNION SELECT categoryid FROM pays),
counts AS (SELECT categoryid, coalesce(clicks.n, 0) AS "clickCount", coalesce(orders_.n, 0) AS "orderCount",
             coalesce(pays.n, 0) AS "payCount"
           FROM ids LEFT JOIN clicks USING (categoryid) LEFT JOIN orders_ USING (categoryid)
             LEFT JOIN pays USING (categoryid)),
top AS (SELECT * FROM counts
        ORDER BY "clickCount" DESC, "orderCount" DESC, "payCount" DESC, categoryid LIMIT 10){extra}"""


_TOP_SESSIONS = """,
per_session AS (SELECT click_category_id AS categoryid, session_id AS sessionid, count(*) AS "clickCount"
                FROM ka WHERE click_category_id IN (SELECT categoryid FROM top) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY categoryid ORDER BY "clickCount" DESC, sessionid) AS n
           FROM per_session)"""


def _session_job() -> str:
    """Rows as texts; the order of columns in a text is that of their names, capitals first."""
    task = ALL_DAYS | FILTERS["age"] | FILTERS["sex"]
    quota = _quota(task, BIG_ALLOWANCE).replace(f"|{SEED}'", f"|{TASK}'")
    categories = _categories(_TOP_SESSIONS).split("AS (", 1)[1]
    tail = categories[categories.index("ka AS (") :]
    ratios = {f"{name}_ratio": f"CAST({_ratio(count, 'greatest(count(*), 1)')} AS VARCHAR)" for name, count in _bucket_counts(False)}
    ratios |= {"session_count": "CAST(count(*) AS VARCHAR)", "taskid": f"'{TASK}'"}
    tables = [
        ("session_stat_ratio_0911", [ratios[name] for name in sorted(ratios)], "kept"),
        ("session_extract_0911", ["click_category_ids", "search_keywords", "session_id", f"strftime(t0, {_TIME})", f"'{TASK}'"], "sample"),
        ("session_top10_0912", ["categoryid", '"clickCount"', '"orderCount"', '"payCount"', f"'{TASK}'"], "top"),
        ("session_top10session_0912", ["categoryid", '"clickCount"', "sessionid", f"'{TASK}'"], "ranked WHERE n <= 10"),
    ]
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS result_table, concat_ws('|', {', '.join(values)}) AS row FROM {source}" for name, values, source in tables
    )
    return f"WITH {quota}, {tail} {rows}"


_PAIRS = f"""WITH {_actions(ALL_DAYS)},
m AS (SELECT page_id, lead(page_id) OVER (PARTITION BY session_id ORDER BY t, event_id) AS next_page_id FROM a)"""

_PAIR_COUNTS = f"""{_PAIRS}
SELECT page_id AS from_page, next_page_id AS to_page, count(*) AS moves
FROM m WHERE next_page_id IS NOT NULL GROUP BY ALL"""

_FLOW = f"""{_PAIRS},
flow AS (SELECT CAST(i AS BIGINT) AS step, i AS f, i + 1 AS t FROM range(1, 7) x(i)),
c AS (SELECT step, f || '_' || t AS pair, count(m.page_id) AS moves
      FROM flow LEFT JOIN m ON m.page_id = f AND m.next_page_id = t GROUP BY ALL),
b AS (SELECT *, coalesce(lag(moves) OVER (ORDER BY step),
        (SELECT count(*) FROM m WHERE page_id = 1)) AS base FROM c),
rates AS (SELECT step, pair, moves, base,
            CASE WHEN base <> 0 THEN CAST(moves AS DOUBLE) / base END AS rate FROM b)"""

_GAPS = f"""WITH {_actions(ALL_DAYS)},
g AS (SELECT *, lag(t) OVER (PARTITION BY session_id ORDER BY t, event_id) AS p FROM a)
SELECT session_id, event_id, page_id, strftime(t, {_TIME}) AS action_time,
  strftime(p, {_TIME}) AS previous_time, CAST(epoch(t) - epoch(p) AS BIGINT) AS gap_seconds,
  p < t AS previous_is_before, p > t AS previous_is_after, strftime(t, '%Y%m%d') AS day_key,
  strftime(t, '%Y-%m-%d') AS day, strftime(t, '%Y%m%d%H%M') AS minute_key, strftime(t, '%H') AS hour
FROM g"""

_AREA = f"""WITH {_actions(ALL_DAYS)},
city AS (SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
         FROM nation JOIN region ON n_regionkey = r_regionkey),
ac AS (SELECT area, click_product_id AS pid, count(*) AS click_count,
         string_agg(DISTINCT city_id || ':' || city_name, ',' ORDER BY city_id || ':' || city_name) AS city_infos
       FROM a JOIN city USING (city_id) WHERE click_product_id <> -1 GROUP BY ALL),
ap AS (SELECT area, pid, click_count, city_infos, p_name AS product_name,
         CASE WHEN p_partkey % 2 = 0 THEN 'Self' ELSE 'Thrid Party' END AS product_status
       FROM ac JOIN part ON pid = p_partkey)"""

_LEVEL = " ".join(f"WHEN '{area}' THEN '{level}'" for area, level in LEVELS.items())

_ADS = """WITH l AS (
SELECT ts,
  replace(r_name, ' ', '_') AS province, n_name AS city, user_id AS userid,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 20 AS adid
FROM events JOIN nation ON n_nationkey = user_id % 25 JOIN region ON n_regionkey = r_regionkey
WHERE event_type IN ('click', 'view')),
uc AS (SELECT strftime(ts, '%Y%m%d') AS date, userid, adid, count(*) AS "clickCount" FROM l GROUP BY ALL),
ct AS (SELECT strftime(ts, '%Y%m%d') AS date, province, city, adid, count(*) AS "clickCount"
       FROM l GROUP BY ALL),
pt AS (SELECT date, province, adid, CAST(sum("clickCount") AS BIGINT) AS "clickCount" FROM ct GROUP BY ALL),
p3 AS (SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY "clickCount" DESC, adid) AS n FROM pt),
pm AS (SELECT date_trunc('minute', ts) AS mt, adid, count(*) AS c FROM l GROUP BY ALL)"""

_BANNED = f'SELECT DISTINCT userid FROM uc WHERE "clickCount" > {BAN_ABOVE}'
_USER_COUNTS = f"{_ADS} SELECT * FROM uc"
_CITY_TOTALS = f"{_ADS} SELECT * FROM ct"
_TOP3 = f'{_ADS} SELECT date, province, adid, "clickCount" FROM p3 WHERE n <= 3'
_AT = "strftime(mt, '%Y%m%d') AS date, strftime(mt, '%H') AS hour, strftime(mt, '%M') AS minute"
_TREND = f'{_ADS} SELECT {_AT}, adid, c AS "clickCount" FROM pm'


_REPLAYED = f"""{_ADS},
r AS (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events),
p AS (SELECT strftime(ts, '%Y%m%d') AS date, userid, adid, least(2, 3 * (epoch_us(ts) - low) // (high - low + 1)) AS piece
      FROM l, r),
b1 AS (SELECT DISTINCT userid FROM (SELECT userid FROM p WHERE piece = 0 GROUP BY date, userid, adid HAVING count(*) > {BAN_ABOVE})),
p2 AS (SELECT * FROM p WHERE piece = 0 OR (piece = 1 AND userid NOT IN (FROM b1))),
b2 AS (FROM b1 UNION SELECT userid FROM (SELECT userid FROM p2 GROUP BY date, userid, adid HAVING count(*) > {BAN_ABOVE})),
counted AS (FROM p2 UNION ALL SELECT * FROM p WHERE piece = 2 AND userid NOT IN (FROM b2))
SELECT date, userid, adid, count(*) AS "clickCount" FROM counted GROUP BY ALL"""

_CITIES = ", ".join(f"({n}, '{city}', '{area}')" for n, city, area in fixed.CITY_AREAS)
_BUILTIN = " ".join(f"WHEN '{area}' THEN '{level}'" for area, level in fixed.AREA_LEVELS.items())


_KEPT_ACTIONS = f"""WITH {_sessions(ALL_DAYS | FILTERS["age"] | FILTERS["sex"] | FILTERS["keyword"])}
SELECT session_id, event_id, page_id, click_product_id, order_product_ids, pay_product_ids
FROM a WHERE session_id IN (SELECT session_id FROM kept)"""
# Where the watermark of the state queries stands at the end: an hour before the last click.
_PASSED = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM l)"


def all_oracles() -> dict[str, str]:
    found = {
        "visit_actions_in_dates": f"""WITH {_actions(SOME_DAYS)}
SELECT date, user_id, session_id, page_id, strftime(t, {_TIME}) AS action_time, search_keyword, click_category_id,
  click_product_id, order_category_ids, order_product_ids, pay_category_ids, pay_product_ids, city_id, event_id
FROM a""",
        "product_clicks": f"""WITH {_actions(ALL_DAYS)}
SELECT city_id, click_product_id, count(*) AS clicks FROM a WHERE click_product_id <> -1 GROUP BY ALL""",
        "session_rollup": _session_rows(ALL_DAYS),
        "session_filtered": _session_rows(ALL_DAYS | {k: v for f in FILTERS.values() for k, v in f.items()}),
        "session_length_ratios": _ratios(False),
        "session_length_ratios_closed": _ratios(True),
        "session_length_buckets_long": _long(),
        "session_counters": _long(),
        "session_rollup_bucketed": _session_rows(ALL_DAYS),
        "kept_actions_bucketed": _KEPT_ACTIONS,
        "page_pairs_bucketed": _PAIR_COUNTS,
        "actions_of_default_dates": """SELECT CAST(date_diff('day', CAST(ts AS DATE), last) AS INTEGER) AS days_ago, count(*) AS actions
FROM events, (SELECT max(CAST(ts AS DATE)) AS last FROM events) WHERE CAST(ts AS DATE) >= last - 1 GROUP BY 1""",
        "session_hourly_counts": f"""WITH {_quota(ALL_DAYS, BIG_ALLOWANCE)} SELECT * FROM hours""",
        "session_sample_quota": f"""WITH {_quota(ALL_DAYS, BIG_ALLOWANCE)} SELECT * FROM quota""",
        "session_sample": _sample(ALL_DAYS, BIG_ALLOWANCE),
        "session_sample_two_days": _sample(TWO_DAYS, 100),
        "session_sample_detail": f"""WITH {_quota(ALL_DAYS, BIG_ALLOWANCE)}
SELECT '{TASK}' AS taskid, user_id AS userid, session_id AS sessionid, page_id AS pageid,
  strftime(t, {_TIME}) AS "actionTime", search_keyword AS "searchKeyword",
  click_category_id AS "clickCategoryId", click_product_id AS "clickProductId",
  order_category_ids AS "orderCategoryIds", order_product_ids AS "orderProductIds",
  pay_category_ids AS "payCategoryIds", pay_product_ids AS "payProductIds"
FROM a WHERE session_id IN (SELECT session_id FROM sample)""",
        "kept_actions": _KEPT_ACTIONS,
        "session_category_counts": f"""WITH {_sessions(ALL_DAYS)},
ids AS (SELECT session_id, click_category_id AS categoryid, 1 AS c, 0 AS o, 0 AS p FROM a WHERE click_category_id <> -1
  UNION ALL SELECT session_id, CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT), 0, 1, 0 FROM a
  UNION ALL SELECT session_id, CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT), 0, 0, 1 FROM a)
SELECT session_id, categoryid, CAST(sum(c) AS BIGINT) AS "clickCount", CAST(sum(o) AS BIGINT) AS "orderCount",
  CAST(sum(p) AS BIGINT) AS "payCount"
FROM ids WHERE session_id IN (SELECT session_id FROM kept) GROUP BY session_id, categoryid""",
        "category_clicks": f'{_categories()} SELECT categoryid, n AS "clickCount" FROM clicks',
        "category_orders": f'{_categories()} SELECT categoryid, n AS "orderCount" FROM orders_',
        "category_pays": f'{_categories()} SELECT categoryid, n AS "payCount" FROM pays',
        "category_full_counts": f"{_categories()} SELECT * FROM counts",
        "category_top10": f"{_categories()} SELECT '{TASK}' AS taskid, * FROM top",
        "category_top10_sessions": f"""{_categories(_TOP_SESSIONS)}
SELECT '{TASK}' AS taskid, categoryid, sessionid, "clickCount" FROM ranked WHERE n <= 10""",
        "session_job": _session_job(),
        "session_job_random_task": f"""SELECT result_table, true AS one_uuid, count(*) AS result_rows
FROM ({_session_job()}) WHERE result_table <> '{fixed.RESULT_TABLES["session_sample"]}' GROUP BY 1""",
        "page_pairs": _PAIR_COUNTS,
        "page_pairs_cut_sessions": _PAIR_COUNTS,
        "page_flow_rates": f"{_FLOW} SELECT * FROM rates",
        "page_flow_rate_string": f"""{_FLOW}
SELECT '{TASK}' AS taskid, string_agg(pair || '=' || coalesce(CAST(rate AS VARCHAR), 'null'), '|' ORDER BY step)
  AS "convertRate" FROM rates""",
        "action_gaps": _GAPS,
        "area_product_clicks": f"{_AREA} SELECT * FROM ac",
        "area_products": f"{_AREA} SELECT * FROM ap",
        "area_products_sql": f"{_AREA} SELECT * FROM ap",
        "area_top3_products": f"""{_AREA}
SELECT '{TASK}' AS taskid, area, CASE area {_LEVEL} ELSE 'D_Level' END AS "areaLevel", pid AS productid,
  city_infos AS "cityInfos", click_count AS "clickCount", product_name AS "productName",
  product_status AS "productStatus"
FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, pid) AS n FROM ap) WHERE n <= 3""",
        "area_top3_builtin_cities": _AREA.replace("FROM nation JOIN region ON n_regionkey = r_regionkey", "FROM n_r")
        .replace("city AS (", f"n_r AS (SELECT * FROM (VALUES {_CITIES}) v(n_nationkey, n_name, r_name)),\ncity AS (")
        + f"""
SELECT '{TASK}' AS taskid, area, CASE area {_BUILTIN} ELSE '{fixed.OTHER_AREA_LEVEL}' END AS "areaLevel",
  pid AS productid, city_infos AS "cityInfos", click_count AS "clickCount", product_name AS "productName",
  product_status AS "productStatus"
FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, pid) AS n FROM ap) WHERE n <= 3""",
        "order_lists_trimmed": f"""WITH {_actions(ALL_DAYS)}
SELECT order_category_ids AS category_ids, count(*) AS orders FROM a WHERE order_category_ids IS NOT NULL GROUP BY 1""",
        "ad_clicks": f"""{_ADS}
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts, province, city, userid, adid FROM l""",
        "ad_user_daily_counts": _USER_COUNTS,
        "ad_blacklist": f"{_ADS} {_BANNED}",
        "ad_clicks_allowed": f"{_ADS} SELECT * FROM uc WHERE userid NOT IN ({_BANNED})",
        "ad_city_totals": _CITY_TOTALS,
        "ad_province_totals": f"{_ADS} SELECT * FROM pt",
        "ad_province_top3": _TOP3,
        "ad_minute_trend": _TREND,
        "ad_last_hour": f"""{_ADS}
SELECT {_AT.replace("mt,", "x.mt,")}, x.adid, CAST(sum(y.c) AS BIGINT) AS "clickCount"
FROM pm x JOIN pm y ON x.adid = y.adid AND y.mt BETWEEN x.mt - INTERVAL 59 MINUTE AND x.mt
GROUP BY x.mt, x.adid""",
        "ad_stream_city_totals": _CITY_TOTALS,
        "ad_stream_top3": _TOP3,
        "ad_stream_trend": _TREND,
        "ad_stream_sliding_hour": f"""{_ADS},
w AS (SELECT mt - to_minutes(i) AS w0, adid, c FROM pm, range(0, 60) x(i))
SELECT strftime(w0, {_TIME}) AS "windowStart", strftime(w0 + INTERVAL 60 MINUTE, {_TIME}) AS "windowEnd", adid,
  CAST(sum(c) AS BIGINT) AS "clickCount" FROM w GROUP BY w0, adid""",
        "ad_state_totals": _CITY_TOTALS,
        "ad_state_totals_after_failure": _CITY_TOTALS,
        "ad_state_totals_stopped": _CITY_TOTALS,
        "ad_state_minutes": f"{_TREND} WHERE mt + INTERVAL 1 MINUTE <= {_PASSED}",
        "ad_state_sliding_hour": f"""{_ADS},
w AS (SELECT unnest(generate_series(mt - INTERVAL 59 MINUTE, mt, INTERVAL 1 MINUTE)) AS start, adid, c FROM pm)
SELECT strftime(start, {_TIME}) AS "windowStart", strftime(start + INTERVAL 1 HOUR, {_TIME}) AS "windowEnd", adid,
  CAST(sum(c) AS BIGINT) AS "clickCount"
FROM w WHERE start + INTERVAL 1 HOUR <= {_PASSED} GROUP BY start, adid""",
        "ad_state_bans": f"{_ADS} {_BANNED}",
        "sink_row_files": f"""{_ADS}
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts, province, city, userid, adid FROM l""",
        "ad_stream_allowed": _REPLAYED,
        "sink_restart": _CITY_TOTALS,
        "ad_stream_user_counts": _USER_COUNTS,
        "ad_stream_blacklist": f"{_ADS} {_BANNED}",
        "ad_stream_job_top3": _TOP3,
        "sink_managed_overwrite": """SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
  CAST(c_custkey % 60 AS INTEGER) AS age, c_mktsegment AS professional, 'city' || c_nationkey AS city,
  CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex FROM customer""",
        "sink_additive_upsert": _CITY_TOTALS,
        "sink_replacing_upsert": _CITY_TOTALS,
        "sink_replace_group": _TOP3,
        "sink_insert_if_absent": f"{_ADS} SELECT DISTINCT userid FROM l",
    }
    for name, task in FILTERS.items():
        found[f"session_filter_{name}"] = _session_rows(ALL_DAYS | task)
    return found

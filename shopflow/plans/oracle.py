"""DuckDB SQL for every catalogue query, on the raw test tables.

Each statement first rebuilds the domain views of FIXTURES.md section 2 as CTEs (the same
column expressions as ``sources/fixtures.py``), then states the question in plain SQL. Column
names and types are aligned with the Spark results (BIGINT counts, DOUBLE rates, VARCHAR text).
"""

from __future__ import annotations

from shopflow.operators.areas import OTHER_LABEL

# ---------------------------------------------------------------- shared views (CTE bodies)
UVA = """
uva AS (
  SELECT event_id,
         strftime(ts, '%Y-%m-%d') AS date,
         CAST(user_id AS BIGINT) AS user_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
         CAST(k % 7 + 1 AS BIGINT) AS page_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 6 AS VARCHAR) END AS search_keyword,
         CAST(CASE WHEN event_type = 'click' THEN k % 20 + 1 ELSE -1 END AS BIGINT) AS click_category_id,
         CAST(CASE WHEN event_type = 'click' THEN event_id % 100 + 1 ELSE -1 END AS BIGINT) AS click_product_id,
         CASE WHEN event_type = 'purchase' THEN CAST(k % 20 + 1 AS VARCHAR) || ',' || CAST((k + 7) % 20 + 1 AS VARCHAR) END AS order_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k % 100 + 1 AS VARCHAR) || ',' || CAST((k + 13) % 100 + 1 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k % 20 + 1 AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k % 100 + 1 AS VARCHAR) END AS pay_product_ids,
         CAST(user_id % 25 AS BIGINT) AS city_id
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
),
users AS (
  SELECT CAST(c_custkey AS BIGINT) AS user_id, c_name AS username, c_name AS name,
         CAST(10 + c_custkey % 50 AS INTEGER) AS age, c_mktsegment AS professional,
         CASE WHEN c_custkey % 5 < 3 THEN 'M' ELSE 'F' END AS gender
  FROM customer
),
products AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name AS product_name, p_type AS extend_info FROM part
),
cities AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

# Actions of known users (the reference's inner join with user_info, no request filter).
ACTIONS = """,
actions AS (SELECT * FROM uva WHERE user_id IN (SELECT user_id FROM users)),
timed AS (SELECT *, strptime(action_time, '%Y-%m-%d %H:%M:%S') AS act_ts FROM actions)"""

ADS = """,
adslog AS (
  SELECT epoch_ms(epoch_us(e.ts) // 1000) AS ts, replace(c.area, ' ', '-') AS area, c.city_name AS city,
         CAST(e.user_id AS VARCHAR) AS user_id,
         CAST(CAST(json_extract(e.props, '$.k') AS BIGINT) % 5 + 1 AS VARCHAR) AS ads_id,
         e.event_id AS seq
  FROM events e JOIN cities c ON e.user_id % 25 = c.city_id
),
adsday AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM adslog)"""


def _with(*parts: str) -> str:
    return "WITH " + "".join(parts).strip().lstrip(",") + "\n"


# ---------------------------------------------------------------- areas
AREA_CLICKS = """,
area_clicks AS (
  SELECT a.click_product_id, c.city_name, c.area
  FROM uva a JOIN cities c ON a.city_id = c.city_id WHERE a.click_product_id > 0
),
per_city AS (
  SELECT area, click_product_id, city_name, CAST(count(*) AS BIGINT) AS c
  FROM area_clicks GROUP BY area, click_product_id, city_name
),
rated AS (
  SELECT *, CAST(floor(CAST(c AS DOUBLE) / CAST(total AS DOUBLE) * 1000.0 + 0.5) / 10.0 AS DOUBLE) AS rate
  FROM (SELECT *, sum(c) OVER (PARTITION BY area, click_product_id) AS total,
               count(*) OVER (PARTITION BY area, click_product_id) AS n_cities FROM per_city)
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY area, click_product_id ORDER BY rate DESC, city_name) AS pos
  FROM rated
),
remarks AS (
  SELECT area, click_product_id, CAST(max(total) AS BIGINT) AS clickcount,
         string_agg(city_name || ':' || CAST(rate AS VARCHAR) || '%', ',' ORDER BY pos) FILTER (WHERE pos <= 2)
         || CASE WHEN max(n_cities) > 2 THEN ',' || '{other}' || ':' || CAST(CAST(floor(
              (CAST(100.0 AS DOUBLE) - max(rate) FILTER (WHERE pos = 1) - max(rate) FILTER (WHERE pos = 2))
              * 10.0 + 0.5) / 10.0 AS DOUBLE) AS VARCHAR) || '%' ELSE '' END AS city_remark
  FROM ordered GROUP BY area, click_product_id
)""".replace("{other}", OTHER_LABEL)

SQL: dict[str, str] = {}

SQL["area_product_clicks"] = _with(UVA, AREA_CLICKS) + """
SELECT area, click_product_id, CAST(count(*) AS BIGINT) AS clickcount
FROM area_clicks GROUP BY area, click_product_id"""

SQL["area_city_remark"] = _with(UVA, AREA_CLICKS) + """
SELECT area, click_product_id, city_remark FROM remarks"""

SQL["area_city_remark_sql"] = SQL["area_city_remark"]

SQL["area_top3_products"] = _with(UVA, AREA_CLICKS) + """
SELECT r.area, p.product_name, r.clickcount, r.rk, r.city_remark
FROM (SELECT *, CAST(rank() OVER (PARTITION BY area ORDER BY clickcount DESC) AS BIGINT) AS rk FROM remarks) r
JOIN products p ON p.product_id = r.click_product_id
WHERE r.rk <= 3"""

SQL["area_top3_products_sql"] = SQL["area_top3_products"]

# ---------------------------------------------------------------- request filter
SQL["filtered_actions"] = _with(UVA) + """
SELECT date, user_id, session_id, page_id, action_time, search_keyword, click_category_id,
       click_product_id, order_category_ids, order_product_ids, pay_category_ids,
       pay_product_ids, city_id
FROM uva
WHERE date >= '2024-01-05' AND date <= '2024-01-20'
  AND user_id IN (SELECT user_id FROM users WHERE age >= 20 AND age <= 45 AND gender = 'M')"""

# ---------------------------------------------------------------- sessions
SESSIONS = """,
sessions AS (
  SELECT session_id, CAST(date_diff('second', min(act_ts), max(act_ts)) AS BIGINT) AS visit_length,
         CAST(count(*) AS BIGINT) AS step_length, min(act_ts) AS start_ts
  FROM timed GROUP BY session_id
),
hours AS (
  SELECT strftime(start_ts, '%Y-%m-%d %H') AS day_hour, CAST(count(*) AS BIGINT) AS n_sessions
  FROM sessions GROUP BY 1
),
quota AS (
  SELECT day_hour, n_sessions,
         CAST(least(floor(CAST(n_sessions AS DOUBLE) / CAST((SELECT sum(n_sessions) FROM hours) AS DOUBLE)
                          * 1000.0), n_sessions) AS BIGINT) AS quota
  FROM hours
),
counts AS (
  SELECT CAST(count_if(visit_length <= 10) AS BIGINT) AS visit_length_le_10s,
         CAST(count_if(visit_length > 10) AS BIGINT) AS visit_length_gt_10s,
         CAST(count_if(step_length <= 5) AS BIGINT) AS step_length_le_5,
         CAST(count_if(step_length > 5) AS BIGINT) AS step_length_gt_5,
         CAST(count(*) AS BIGINT) AS session_count
  FROM sessions
)"""

SQL["session_info"] = _with(UVA, ACTIONS) + """
SELECT session_id,
       CAST(date_diff('second', min(act_ts), max(act_ts)) AS BIGINT) AS visit_length,
       CAST(count(*) AS BIGINT) AS step_length,
       strftime(min(act_ts), '%Y-%m-%d %H:%M:%S') AS start_time,
       coalesce(string_agg(search_keyword, ',' ORDER BY act_ts, event_id), '') AS search_keywords,
       coalesce(string_agg(CASE WHEN click_product_id > 0 THEN CAST(click_product_id AS VARCHAR) END,
                           ',' ORDER BY act_ts, event_id), '') AS click_product_ids,
       coalesce(string_agg(order_product_ids, ',' ORDER BY act_ts, event_id), '') AS order_product_ids,
       coalesce(string_agg(pay_product_ids, ',' ORDER BY act_ts, event_id), '') AS pay_product_ids
FROM timed GROUP BY session_id"""

SQL["session_items"] = _with(UVA, ACTIONS) + """
SELECT session_id, list, value,
       CAST(row_number() OVER (PARTITION BY session_id, list ORDER BY act_ts, event_id) AS BIGINT) AS position
FROM (
  SELECT session_id, act_ts, event_id, 'search_keywords' AS list, search_keyword AS value FROM timed
  UNION ALL
  SELECT session_id, act_ts, event_id, 'click_product_ids',
         CASE WHEN click_product_id > 0 THEN CAST(click_product_id AS VARCHAR) END FROM timed
  UNION ALL
  SELECT session_id, act_ts, event_id, 'order_product_ids', order_product_ids FROM timed
  UNION ALL
  SELECT session_id, act_ts, event_id, 'pay_product_ids', pay_product_ids FROM timed
) WHERE value IS NOT NULL"""

SQL["session_counts"] = _with(UVA, ACTIONS, SESSIONS) + "SELECT * FROM counts"


def _ratio(name: str) -> str:
    return (f"coalesce(CAST(floor(CAST({name} AS DOUBLE) / CAST(nullif(session_count, 0) AS DOUBLE)"
            f" * 10000.0 + 0.5) / 100.0 AS DOUBLE), CAST(0.0 AS DOUBLE)) AS {name}_ratio")


SQL["session_ratio_stats"] = _with(UVA, ACTIONS, SESSIONS) + f"""
SELECT 'task-1' AS task_id,
       '{{"city": null, "endAge": null, "endDate": null, "gender": null, "professionals": null, "startAge": null, "startDate": null, "targetPageFlow": null}}' AS conditions,
       session_count,
       {_ratio('visit_length_le_10s')}, {_ratio('visit_length_gt_10s')},
       {_ratio('step_length_le_5')}, {_ratio('step_length_gt_5')}
FROM counts"""

SQL["session_hour_quota"] = _with(UVA, ACTIONS, SESSIONS) + "SELECT * FROM quota"

SQL["session_sample"] = _with(UVA, ACTIONS, SESSIONS) + """
SELECT session_id, day_hour FROM (
  SELECT s.session_id, q.day_hour, q.quota,
         row_number() OVER (PARTITION BY q.day_hour ORDER BY md5(s.session_id || '42'), s.session_id) AS rn
  FROM sessions s JOIN quota q ON strftime(s.start_ts, '%Y-%m-%d %H') = q.day_hour
) WHERE rn <= quota"""

# ---------------------------------------------------------------- categories
CATS = """,
cat AS (
  SELECT CAST(click_category_id AS VARCHAR) AS category_id, 'click' AS kind
  FROM actions WHERE click_category_id > 0
  UNION ALL
  SELECT trim(t) AS category_id, 'order' AS kind
  FROM (SELECT unnest(string_split(order_category_ids, ',')) AS t FROM actions
        WHERE coalesce(click_category_id, 0) <= 0 AND order_category_ids IS NOT NULL)
  WHERE trim(t) <> ''
  UNION ALL
  SELECT trim(t) AS category_id, 'pay' AS kind
  FROM (SELECT unnest(string_split(pay_category_ids, ',')) AS t FROM actions
        WHERE coalesce(click_category_id, 0) <= 0 AND order_category_ids IS NULL
          AND pay_category_ids IS NOT NULL)
  WHERE trim(t) <> ''
),
catcounts AS (
  SELECT category_id,
         CAST(count_if(kind = 'click') AS BIGINT) AS click_count,
         CAST(count_if(kind = 'order') AS BIGINT) AS order_count,
         CAST(count_if(kind = 'pay') AS BIGINT) AS pay_count
  FROM cat GROUP BY category_id
),
top10 AS (
  SELECT * FROM catcounts
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10
),
csc AS (
  SELECT CAST(click_category_id AS VARCHAR) AS category_id, session_id, CAST(count(*) AS BIGINT) AS click_count
  FROM actions WHERE click_category_id > 0 GROUP BY 1, 2
)"""

SQL["category_action_counts"] = _with(UVA, ACTIONS, CATS) + """
SELECT category_id, kind, CAST(count(*) AS BIGINT) AS n FROM cat GROUP BY category_id, kind"""

SQL["category_counts"] = _with(UVA, ACTIONS, CATS) + "SELECT * FROM catcounts"

SQL["category_top10"] = _with(UVA, ACTIONS, CATS) + "SELECT * FROM top10"

SQL["category_session_clicks"] = _with(UVA, ACTIONS, CATS) + "SELECT * FROM csc"

SQL["top_sessions_per_category"] = _with(UVA, ACTIONS, CATS) + """
SELECT * FROM (
  SELECT category_id, session_id, click_count,
         CAST(row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS BIGINT) AS rn
  FROM csc WHERE category_id IN (SELECT category_id FROM top10)
) WHERE rn <= 10"""

# ---------------------------------------------------------------- page flow
def _funnel(pages: list[int]) -> str:
    """Visits of the flow's pages but the last, every consecutive hop, the flow's hops."""
    visit_pages = ", ".join(str(p) for p in pages[:-1])
    jumps = ", ".join(f"'{a}_{b}'" for a, b in zip(pages[:-1], pages[1:]))
    return f""",
visits AS (
  SELECT page_id, CAST(count(*) AS BIGINT) AS n FROM actions
  WHERE page_id IN ({visit_pages}) GROUP BY page_id
),
hops AS (
  SELECT page_id AS from_page,
         lead(page_id) OVER (PARTITION BY session_id ORDER BY act_ts, event_id) AS to_page
  FROM timed
),
jumps AS (
  SELECT page_jump, from_page, CAST(count(*) AS BIGINT) AS n FROM (
    SELECT CAST(from_page AS VARCHAR) || '_' || CAST(to_page AS VARCHAR) AS page_jump, from_page
    FROM hops WHERE to_page IS NOT NULL)
  WHERE page_jump IN ({jumps})
  GROUP BY page_jump, from_page
)"""


FUNNEL = _funnel([1, 2, 3, 4, 5, 6, 7])

SQL["page_visit_counts"] = _with(UVA, ACTIONS, FUNNEL) + "SELECT page_id, n FROM visits"

SQL["page_jump_counts"] = _with(UVA, ACTIONS, FUNNEL) + "SELECT page_jump, n FROM jumps"

SQL["page_convert_rate"] = _with(UVA, ACTIONS, FUNNEL) + """
SELECT j.page_jump,
       CAST(floor(CAST(j.n AS DOUBLE) / CAST(v.n AS DOUBLE) * 1000.0 + 0.5) / 10.0 AS DOUBLE) AS rate
FROM jumps j JOIN visits v ON v.page_id = j.from_page"""

# ---------------------------------------------------------------- ad clicks
ADS_AGG = """,
acd AS (SELECT day, area, city, ads_id, CAST(count(*) AS BIGINT) AS n FROM adsday GROUP BY ALL),
ad AS (SELECT day, area, ads_id, CAST(sum(n) AS BIGINT) AS n FROM acd GROUP BY ALL),
top3 AS (
  SELECT * FROM (
    SELECT day, area, ads_id, n,
           CAST(row_number() OVER (PARTITION BY day, area ORDER BY n DESC, ads_id) AS BIGINT) AS rn
    FROM ad) WHERE rn <= 3
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY day, user_id, ads_id ORDER BY ts, seq) AS rn FROM adsday
),
cut AS (
  SELECT user_id, ts AS cts, seq AS cseq FROM (
    SELECT user_id, ts, seq, row_number() OVER (PARTITION BY user_id ORDER BY ts, seq) AS r
    FROM numbered WHERE rn = 3) WHERE r = 1
),
lh AS (
  SELECT ads_id, date_trunc('minute', ts) AS m, CAST(count(*) AS BIGINT) AS n FROM adslog
  WHERE ts >= date_trunc('minute', (SELECT max(ts) FROM adslog)) - INTERVAL 59 MINUTE
  GROUP BY 1, 2
)"""

SQL["ads_log_parsed"] = _with(UVA, ADS) + """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts, area, city, user_id, ads_id FROM adslog"""

SQL["ads_area_city_daily"] = _with(UVA, ADS, ADS_AGG) + "SELECT * FROM acd"

SQL["ads_area_daily"] = _with(UVA, ADS, ADS_AGG) + "SELECT * FROM ad"

SQL["ads_area_top3"] = _with(UVA, ADS, ADS_AGG) + "SELECT * FROM top3"

SQL["ads_area_top3_json"] = _with(UVA, ADS, ADS_AGG) + """
SELECT 'area_top3_ads:' || day AS date_key, area,
       '[' || string_agg('{"' || ads_id || '":' || CAST(n AS VARCHAR) || '}', ',' ORDER BY rn) || ']' AS top3_json
FROM top3 GROUP BY day, area"""

SQL["ads_user_daily"] = _with(UVA, ADS, ADS_AGG) + """
SELECT day, user_id, ads_id, CAST(count(*) AS BIGINT) AS n FROM adsday GROUP BY ALL"""

SQL["ads_blacklist"] = _with(UVA, ADS, ADS_AGG) + "SELECT user_id FROM cut"

SQL["ads_kept_events"] = _with(UVA, ADS, ADS_AGG) + """
SELECT strftime(l.ts, '%Y-%m-%d %H:%M:%S.%g') AS ts, l.area, l.city, l.user_id, l.ads_id
FROM adslog l LEFT JOIN cut c ON l.user_id = c.user_id
WHERE c.cts IS NULL OR l.ts < c.cts OR (l.ts = c.cts AND l.seq <= c.cseq)"""

SQL["ads_last_hour"] = _with(UVA, ADS, ADS_AGG) + """
SELECT ads_id, strftime(m, '%Y-%m-%d %H:%M') AS minute, n FROM lh"""

SQL["ads_last_hour_json"] = _with(UVA, ADS, ADS_AGG) + """
SELECT ads_id,
       '[' || string_agg('{"' || strftime(m, '%H:%M') || '":' || CAST(n AS VARCHAR) || '}', ',' ORDER BY m) || ']' AS series_json
FROM lh GROUP BY ads_id"""

SQL["ads_sliding_counts"] = _with(UVA, ADS) + """
SELECT strftime(epoch_ms(p - j * 600000), '%Y-%m-%d %H:%M:%S') AS window_start, ads_id,
       CAST(count(*) AS BIGINT) AS n
FROM (SELECT unnest(range(0, 6)) AS j, (epoch_ms(ts) // 600000) * 600000 AS p, ads_id FROM adslog)
GROUP BY 1, 2"""

# Streaming forms end in the same results as the batch forms.
SQL["ads_area_city_daily_stream"] = SQL["ads_area_city_daily"]
SQL["ads_area_top3_stream"] = SQL["ads_area_top3"]
SQL["ads_blacklist_stream"] = SQL["ads_blacklist"]
SQL["ads_last_hour_stream"] = SQL["ads_last_hour"]
SQL["ads_kept_events_stream"] = SQL["ads_kept_events"]

# ---------------------------------------------------------------- request options
FILTERED_ACTIONS = """,
actions AS (
  SELECT * FROM uva
  WHERE date >= '2024-01-05' AND date <= '2024-01-20'
    AND user_id IN (SELECT user_id FROM users WHERE age >= 20 AND age <= 45 AND gender = 'M')
),
timed AS (SELECT *, strptime(action_time, '%Y-%m-%d %H:%M:%S') AS act_ts FROM actions)"""

SQL["session_ratio_stats_filtered"] = _with(UVA, FILTERED_ACTIONS, SESSIONS) + f"""
SELECT 'task-1' AS task_id,
       '{{"city": null, "endAge": "45", "endDate": "2024-01-20", "gender": "M", "professionals": null, "startAge": "20", "startDate": "2024-01-05", "targetPageFlow": null}}' AS conditions,
       session_count,
       {_ratio('visit_length_le_10s')}, {_ratio('visit_length_gt_10s')},
       {_ratio('step_length_le_5')}, {_ratio('step_length_gt_5')}
FROM counts"""

SQL["page_convert_rate_zero"] = _with(UVA, ACTIONS, _funnel([1, 3, 5, 9])) + """
SELECT w.page_jump,
       coalesce(CASE WHEN v.n > 0 THEN CAST(floor(CAST(j.n AS DOUBLE) / CAST(v.n AS DOUBLE) * 1000.0 + 0.5) / 10.0 AS DOUBLE) END,
                CAST(0.0 AS DOUBLE)) AS rate
FROM (VALUES ('1_3', 1), ('3_5', 3), ('5_9', 5)) AS w(page_jump, from_page)
LEFT JOIN jumps j ON j.page_jump = w.page_jump
LEFT JOIN visits v ON v.page_id = w.from_page"""

SQL["category_bottom10"] = _with(UVA, ACTIONS, CATS) + """
SELECT * FROM catcounts
ORDER BY click_count, order_count, pay_count, category_id LIMIT 10"""
SQL["ads_area_top3_json_stream"] = SQL["ads_area_top3_json"]

# ---------------------------------------------------------------- request text, rejects, repeated hops, maps
SQL["session_ratio_stats_request"] = _with(UVA, FILTERED_ACTIONS.replace("""date >= '2024-01-05' AND date <= '2024-01-20'
    AND user_id IN (SELECT user_id FROM users WHERE age >= 20 AND age <= 45 AND gender = 'M')""", """city_id = 7
    AND user_id IN (SELECT user_id FROM users WHERE professional = 'BUILDING')"""), SESSIONS) + f"""
SELECT 'task-1' AS task_id,
       '{{"city": "7", "endAge": null, "endDate": null, "gender": null, "professionals": "BUILDING", "startAge": null, "startDate": null, "targetPageFlow": null}}' AS conditions,
       session_count,
       {_ratio('visit_length_le_10s')}, {_ratio('visit_length_gt_10s')},
       {_ratio('step_length_le_5')}, {_ratio('step_length_gt_5')}
FROM counts"""

SQL["page_convert_rate_repeat"] = _with(UVA, ACTIONS, _funnel([1, 2, 1, 2])) + """
SELECT w.page_jump,
       coalesce(CASE WHEN v.n > 0 THEN CAST(floor(CAST(j.n AS DOUBLE) / CAST(v.n AS DOUBLE) * 1000.0 + 0.5) / 10.0 AS DOUBLE) END,
                CAST(0.0 AS DOUBLE)) AS rate
FROM (VALUES ('1_2', 1), ('2_1', 2)) AS w(page_jump, from_page)
LEFT JOIN jumps j ON j.page_jump = w.page_jump
LEFT JOIN visits v ON v.page_id = w.from_page"""

SQL["ads_log_rejects"] = _with(UVA, ADS) + """
SELECT CASE WHEN seq % 97 = 0 THEN concat_ws(' ', epoch_ms(ts), area, city, user_id)
            ELSE 'x' || concat_ws(' ', epoch_ms(ts), area, city, user_id, ads_id) END AS value,
       CASE WHEN seq % 97 = 0 THEN 'fewer than 5 fields' ELSE 'time is not a number' END AS reason,
       CAST(seq AS BIGINT) AS seq
FROM adslog WHERE seq % 97 = 0 OR seq % 89 = 0"""

SQL["ads_area_top3_map"] = f"""
SELECT date_key, string_agg(area || '=' || top3_json, ';' ORDER BY area) AS areas
FROM ({SQL["ads_area_top3_json"]}) GROUP BY date_key"""

SQL["ads_area_city_daily_kept"] = _with(UVA, ADS, ADS_AGG) + """
SELECT l.day, l.area, l.city, l.ads_id, CAST(count(*) AS BIGINT) AS n
FROM adsday l LEFT JOIN cut c ON l.user_id = c.user_id
WHERE c.cts IS NULL OR l.ts < c.cts OR (l.ts = c.cts AND l.seq <= c.cseq)
GROUP BY ALL"""

SQL["ads_sliding_counts_stream"] = SQL["ads_sliding_counts"]
SQL["ads_sliding_fine_stream"] = _with(UVA, ADS) + """
SELECT ads_id, CAST(count(*) AS BIGINT) AS windows, CAST(sum(n) AS BIGINT) AS clicks, max(n) AS most
FROM (SELECT (epoch_ms(ts) // 60000) - j AS w, ads_id, CAST(count(*) AS BIGINT) AS n
      FROM adslog, range(0, 60) AS r(j) GROUP BY 1, 2)
GROUP BY 1"""
SQL["ads_blacklist_replay"] = SQL["ads_blacklist"]
SQL["ads_area_city_daily_replay"] = SQL["ads_area_city_daily"]
SQL["ads_last_hour_replay"] = SQL["ads_last_hour"]

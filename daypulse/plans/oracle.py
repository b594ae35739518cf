"""DuckDB statements equivalent to each registered query (the correctness oracle).

Tables are the pre-registered views of the test data.  Epoch milliseconds use
``epoch_us(ts) // 1000`` (Spark's ``unix_millis`` truncates; DuckDB's
``epoch_ms`` rounds).  Money is summed as DECIMAL(18,2) and exposed as DOUBLE,
like the Spark side.
"""

from __future__ import annotations

from daypulse.functions.scalar import AGE_BAND_LABELS
from daypulse.plans.catalog import (
    DEEP_PAGE, INDEX_KEYWORDS, SEARCH_DATE, SEARCH_KEYWORD, SEARCH_LEVEL, SEARCH_PAGE, SEARCH_SIZE)

# --- shared CTEs ------------------------------------------------------------

_SL = """sl AS (
  SELECT e.event_id, CAST(e.user_id AS VARCHAR) AS mid, CAST(e.user_id AS VARCHAR) AS uid,
         e.event_type AS ch, json_extract_string(e.props, '$.k') AS vc,
         epoch_us(e.ts) // 1000 AS ts,
         strftime(e.ts, '%Y-%m-%d') AS dt, strftime(e.ts, '%H') AS hr, strftime(e.ts, '%M') AS mi
  FROM events e WHERE e.event_type = 'view')"""

_FIRST = """first_seen AS (
  SELECT mid, dt, hr, mi, ts, event_id FROM sl
  QUALIFY row_number() OVER (PARTITION BY mid, dt ORDER BY ts, event_id) = 1)"""

_DAU_HOUR = """dau_hour AS (SELECT dt, hr, count(*) AS dau FROM first_seen GROUP BY dt, hr)"""

_PURCHASE = """p AS (
  SELECT e.event_id, CAST(e.value AS DECIMAL(18,2)) AS amount,
         strftime(e.ts, '%Y-%m-%d') AS dt, strftime(e.ts, '%H') AS hr
  FROM events e WHERE e.event_type = 'purchase')"""

_SPINE = """spine AS (
  SELECT d.dt, lpad(CAST(t.i AS VARCHAR), 2, '0') AS hr
  FROM (SELECT DISTINCT dt FROM {src}) d, range(24) t(i))"""

_NEXT_DAY = "strftime(CAST({c} AS DATE) + 1, '%Y-%m-%d')"


def _compare(src: str, value: str, zero: str) -> str:
    return f"""{_SPINE.format(src=src)}
SELECT s.dt, s.hr, coalesce(t.{value}, {zero}) AS today, coalesce(y.{value}, {zero}) AS yesterday
FROM spine s
LEFT JOIN {src} t ON t.dt = s.dt AND t.hr = s.hr
LEFT JOIN {src} y ON {_NEXT_DAY.format(c='y.dt')} = s.dt AND y.hr = s.hr"""


_DAU_COMPARE = f"""WITH {_SL}, {_FIRST}, {_DAU_HOUR},
{_compare('dau_hour', 'dau', '0')}"""

_AMOUNT_HOUR = f"""{_PURCHASE},
amount_hour AS (SELECT dt, hr, CAST(sum(amount) AS DOUBLE) AS order_amount FROM p GROUP BY dt, hr)"""

_AMOUNT_COMPARE = f"""WITH {_AMOUNT_HOUR},
{_compare('amount_hour', 'order_amount', '0.0')}"""


def _series(metric_id: str, compare: str) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{metric_id}' AS id, dt, '{s}' AS series, hr, CAST({s} AS DOUBLE) AS value
FROM ({compare})""" for s in ("yesterday", "today"))

_RAW = """raw AS (
  SELECT e.event_id, e.event_type, CAST(e.user_id AS VARCHAR) AS mid,
         CAST(c.c_nationkey AS VARCHAR) AS ar, json_extract_string(e.props, '$.k') AS vc,
         epoch_us(e.ts) // 1000 AS ts, strftime(e.ts, '%Y-%m-%d') AS dt,
         strftime(e.ts, '%H') AS hr, strftime(e.ts, '%M') AS mi
  FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id)"""

_CARDS = f"""{_SL}, {_PURCHASE},
dau AS (SELECT dt, count(DISTINCT mid) AS v FROM sl GROUP BY dt),
nm AS (SELECT dt, count(*) AS v FROM (SELECT mid, min(dt) AS dt FROM sl GROUP BY mid) GROUP BY dt),
amt AS (SELECT dt, CAST(sum(amount) AS DOUBLE) AS v FROM p GROUP BY dt),
days AS (SELECT dt FROM dau UNION SELECT dt FROM nm UNION SELECT dt FROM amt),
cards AS (
  SELECT d.dt, 1 AS ord, 'dau' AS id, '新增日活' AS name, coalesce(CAST(x.v AS DOUBLE), 0.0) AS value
  FROM days d LEFT JOIN dau x USING (dt)
  UNION ALL
  SELECT d.dt, 2, 'new_mid', '新增设备', coalesce(CAST(x.v AS DOUBLE), 0.0)
  FROM days d LEFT JOIN nm x USING (dt)
  UNION ALL
  SELECT d.dt, 3, 'order_amount', '新增交易额', coalesce(CAST(x.v AS DOUBLE), 0.0)
  FROM days d LEFT JOIN amt x USING (dt))"""

_WIDE = """wide AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_linenumber AS VARCHAR) AS order_detail_id,
         l.l_orderkey AS order_id, o.o_custkey AS user_id, l.l_partkey AS sku_id,
         c.c_mktsegment AS user_gender, p.p_size AS user_age,
         CAST(least(10, greatest(1, ceil(c.c_acctbal / 1000))) AS INTEGER) AS user_level,
         p.p_retailprice AS sku_price, p.p_name AS sku_name, p.p_brand AS sku_tm_id,
         strftime(o.o_orderdate, '%Y-%m-%d') AS dt
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN part p ON p.p_partkey = l.l_partkey
  {where})"""

_PAGE_ORDER = ("dt, order_id, order_detail_id, sku_id, user_id, user_gender, user_age, user_level, "
               "sku_price, sku_name, sku_tm_id")

_FULL = (f"WHERE lower(p.p_name) LIKE '%{SEARCH_KEYWORD}%' "
         f"AND strftime(o.o_orderdate, '%Y-%m-%d') = '{SEARCH_DATE}' "
         f"AND least(10, greatest(1, ceil(c.c_acctbal / 1000))) = {SEARCH_LEVEL}")

_STATS = f"""named AS (
  SELECT 'total' AS stat, 'total' AS name FROM wide
  UNION ALL SELECT 'category', user_gender FROM wide
  UNION ALL SELECT 'age', CASE WHEN user_age < 20 THEN '{AGE_BAND_LABELS[0]}' WHEN user_age <= 30 THEN '{AGE_BAND_LABELS[1]}'
                               WHEN user_age IS NOT NULL THEN '{AGE_BAND_LABELS[2]}' END FROM wide),
stats AS (
  SELECT stat, name, value,
         CAST(value AS DOUBLE) / CAST(sum(value) OVER (PARTITION BY stat) AS DOUBLE) AS pct
  FROM (SELECT stat, name, count(*) AS value FROM named GROUP BY ALL))"""

_REGION = """region_sales AS (
  SELECT n.n_name AS name, coalesce(x.n, 0) AS value,
         CAST(coalesce(x.amt, 0) AS DOUBLE) AS amount
  FROM nation n LEFT JOIN (
    SELECT c.c_nationkey, count(*) AS n, sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS amt
    FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY c.c_nationkey
  ) x ON x.c_nationkey = n.n_nationkey)"""

_KW = f"WHERE contains(lower(p.p_name), '{SEARCH_KEYWORD}')"

ORACLE: dict[str, str] = {
    "route_logs": """
SELECT CAST(event_id % 4 AS INTEGER) AS partition, event_id AS "offset",
       CASE event_type WHEN 'view' THEN 'start' WHEN 'error' THEN 'reject' ELSE 'event' END AS route
FROM events""",
    "parse_logs": f"""WITH {_RAW}
SELECT event_id AS "offset", mid, mid AS uid, ar, event_type AS ch, vc, ts
FROM raw WHERE event_type = 'view'""",
    "time_parts": """
SELECT event_id, epoch_us(ts) // 1000 AS ts, strftime(ts, '%Y-%m-%d') AS dt,
       strftime(ts, '%H') AS hr, strftime(ts, '%M') AS mi
FROM events""",
    "partition_keys": f"""WITH {_SL}
SELECT dt, 'dau:' || dt AS set_key, 'dau_info_' || replace(dt, '-', '') AS table_name,
       'dau_info_' || replace(dt, '-', '') || '_query' AS query_alias
FROM (SELECT DISTINCT dt FROM sl)""",
    "read_table": "SELECT * FROM nation",
    "dau_first_seen": f"WITH {_SL}, {_FIRST}\nSELECT * FROM first_seen",
    "dau_detail": f"""WITH {_RAW}
SELECT mid, mid AS uid, ar, event_type AS ch, vc, dt, hr, mi, ts FROM raw
WHERE event_type = 'view'
QUALIFY row_number() OVER (PARTITION BY mid, dt ORDER BY ts, event_id) = 1""",
    "dau_anti_backfill": f"""WITH {_SL},
cand AS (SELECT * FROM sl WHERE event_id % 2 = 1),
seen AS (SELECT DISTINCT mid, dt FROM sl WHERE event_id % 2 = 0),
f AS (SELECT mid, dt, hr, mi, ts, event_id FROM cand
      QUALIFY row_number() OVER (PARTITION BY mid, dt ORDER BY ts, event_id) = 1)
SELECT f.* FROM f WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.mid = f.mid AND s.dt = f.dt)""",
    "dedup_stats": f"""WITH {_SL}
SELECT dt, count(*) AS input_rows, count(DISTINCT mid) AS kept_rows,
       count(*) - count(DISTINCT mid) AS dropped_rows
FROM sl GROUP BY dt""",
    "dau_total": f"WITH {_SL}\nSELECT dt, count(DISTINCT mid) AS dau FROM sl GROUP BY dt",
    "dau_hour": f"WITH {_SL}, {_FIRST}, {_DAU_HOUR}\nSELECT * FROM dau_hour",
    "dau_hour_compare": _DAU_COMPARE,
    "hour_series": f"{_series('dau', _DAU_COMPARE)}\nUNION ALL\n{_series('order_amount', _AMOUNT_COMPARE)}",
    "metric_series": _series("order_amount", _AMOUNT_COMPARE),
    "order_amount_hour_json": f"""WITH cmp AS ({_AMOUNT_COMPARE})
SELECT dt, CAST(to_json({{'yesterday': map_from_entries(list((hr, CAST(yesterday AS DECIMAL(18,2))) ORDER BY hr)),
                         'today': map_from_entries(list((hr, CAST(today AS DECIMAL(18,2))) ORDER BY hr))}})
                AS VARCHAR) AS json
FROM cmp GROUP BY dt""",
    "arrival_classes": f"""WITH {_SL},
a AS (SELECT dt, epoch_ms(ts) AS t,
             epoch_ms(ts - CASE WHEN event_id % 7 = 0 THEN event_id % 11 - 5 ELSE 0 END * 86400000) AS broker
      FROM sl),
b AS (SELECT dt, date_diff('day', CAST(broker AS DATE), CAST(t AS DATE)) AS ahead FROM a)
SELECT dt, CASE WHEN ahead > 1 THEN 'future' WHEN ahead < -2 THEN 'late' ELSE 'in_time' END AS arrival,
       count(*) AS "rows"
FROM b GROUP BY ALL""",
    "dau_hour_json": f"""WITH cmp AS ({_DAU_COMPARE})
SELECT dt, CAST(to_json({{'yesterday': map_from_entries(list((hr, yesterday) ORDER BY hr)),
                         'today': map_from_entries(list((hr, today) ORDER BY hr))}}) AS VARCHAR) AS json
FROM cmp GROUP BY dt""",
    "order_amount_total": f"""WITH {_PURCHASE}
SELECT dt, CAST(sum(amount) AS DOUBLE) AS order_amount FROM p GROUP BY dt""",
    "order_amount_hour": f"WITH {_AMOUNT_HOUR}\nSELECT * FROM amount_hour",
    "order_amount_hour_compare": f"""WITH {_AMOUNT_HOUR},
{_compare('amount_hour', 'order_amount', '0.0')}""",
    "new_devices": f"""WITH {_SL}
SELECT dt, count(*) AS new_mid FROM (SELECT mid, min(dt) AS dt FROM sl GROUP BY mid) GROUP BY dt""",
    "new_users": """
SELECT dt, count(*) AS new_users FROM (
  SELECT CAST(user_id AS VARCHAR) AS uid, min(strftime(ts, '%Y-%m-%d')) AS dt
  FROM events WHERE event_type = 'signup' GROUP BY uid) GROUP BY dt""",
    "launch_count": f"WITH {_SL}\nSELECT dt, count(*) AS launches FROM sl GROUP BY dt",
    "hourly_active": f"WITH {_SL}\nSELECT dt, hr, count(DISTINCT mid) AS active FROM sl GROUP BY dt, hr",
    "launches_hourly": f"WITH {_SL}\nSELECT dt, hr, count(*) AS launches FROM sl GROUP BY dt, hr",
    "activity_rate": f"""WITH {_SL},
d AS (SELECT dt, count(DISTINCT mid) AS dau FROM sl GROUP BY dt),
n AS (SELECT dt, count(*) AS new FROM (SELECT mid, min(dt) AS dt FROM sl GROUP BY mid) GROUP BY dt),
k AS (SELECT d.dt, d.dau,
             CAST(sum(coalesce(n.new, 0)) OVER (ORDER BY d.dt ROWS BETWEEN UNBOUNDED PRECEDING
                                                AND CURRENT ROW) AS BIGINT) AS known
      FROM d LEFT JOIN n USING (dt))
SELECT dt, dau, known, CAST(dau AS DOUBLE) / CAST(known AS DOUBLE) AS activity FROM k""",
    "dau_cumulative": f"""WITH {_SL}, {_FIRST}, {_DAU_HOUR}, {_SPINE.format(src='dau_hour')}
SELECT s.dt, s.hr, coalesce(h.dau, 0) AS dau,
       CAST(sum(coalesce(h.dau, 0)) OVER (PARTITION BY s.dt ORDER BY s.hr
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_dau
FROM spine s LEFT JOIN dau_hour h ON h.dt = s.dt AND h.hr = s.hr""",
    "day_over_day": f"""WITH {_SL},
d AS (SELECT dt, count(DISTINCT mid) AS n FROM sl GROUP BY dt),
j AS (SELECT t.dt, t.n AS today, coalesce(y.n, 0) AS yesterday
      FROM d t LEFT JOIN d y ON {_NEXT_DAY.format(c='y.dt')} = t.dt)
SELECT dt, today, yesterday,
       CASE WHEN yesterday = 0 THEN NULL
            ELSE (CAST(today AS DOUBLE) - CAST(yesterday AS DOUBLE)) / CAST(yesterday AS DOUBLE) END AS rate
FROM j""",
    "realtime_total": f"WITH {_CARDS}\nSELECT * FROM cards",
    "totals_json": f"""WITH {_CARDS}
SELECT dt, '[' || string_agg('{{"id":"' || id || '","name":"' || name || '","value":' ||
         CASE WHEN id = 'order_amount' THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
              ELSE CAST(CAST(value AS BIGINT) AS VARCHAR) END || '}}', ',' ORDER BY ord) || ']' AS json
FROM cards GROUP BY dt""",
    "latest_offsets": """WITH prog AS (
  SELECT 'app_start' AS topic, 'dau_group' AS grp, CAST(event_id % 4 AS INTEGER) AS partition,
         event_id // 1000 AS batch_id, max(event_id) + 1 AS until_offset
  FROM events GROUP BY 3, 4)
SELECT topic, grp, partition, max(batch_id) AS batch_id,
       arg_max(until_offset, batch_id) AS until_offset
FROM prog GROUP BY topic, grp, partition""",
    "upsert_latest": """
SELECT user_id AS key, event_id // 1000 AS batch_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id // 1000 DESC, event_id DESC) = 1""",
    "sale_detail_wide": f"WITH {_WIDE.format(where='')}\nSELECT * FROM wide",
    "sale_detail_page": f"""WITH {_WIDE.format(where=_KW)}
SELECT * FROM wide
ORDER BY dt, order_id, order_detail_id, sku_id, user_id, user_gender, user_age, user_level,
         sku_price, sku_name, sku_tm_id
LIMIT {SEARCH_SIZE} OFFSET {(SEARCH_PAGE - 1) * SEARCH_SIZE}""",
    "sale_detail_total": f"WITH {_WIDE.format(where=_KW)}\nSELECT count(*) AS total FROM wide",
    "sale_detail_search_page": f"""WITH {_WIDE.format(where=_FULL)}
SELECT * FROM wide ORDER BY {_PAGE_ORDER} LIMIT {SEARCH_SIZE}""",
    "sale_detail_shares": f"""WITH {_WIDE.format(where=_KW)}, {_STATS}
SELECT * FROM stats""",
    "sale_detail_json": f"""WITH {_WIDE.format(where=_FULL)}, {_STATS},
page AS (SELECT {_PAGE_ORDER} FROM wide ORDER BY ALL LIMIT {SEARCH_SIZE}),
opts AS (SELECT stat, list({{'name': name, 'value': value, 'percent': round(pct * 100, 1)}}
                           ORDER BY name) AS o FROM stats GROUP BY stat)
SELECT CAST(to_json({{
  'total': (SELECT count(*) FROM wide),
  'stat': [{{'title': 'age', 'options': coalesce((SELECT o FROM opts WHERE stat = 'age'), [])}},
           {{'title': 'category', 'options': coalesce((SELECT o FROM opts WHERE stat = 'category'), [])}}],
  'detail': coalesce((SELECT list(page ORDER BY {_PAGE_ORDER}) FROM page), [])}}) AS VARCHAR) AS json""",
    "category_share": f"""WITH {_WIDE.format(where='')},
g AS (SELECT user_gender AS name, count(*) AS value FROM wide GROUP BY 1)
SELECT name, value, CAST(value AS DOUBLE) / CAST(sum(value) OVER () AS DOUBLE) AS pct FROM g""",
    "age_share": f"""WITH {_WIDE.format(where='')},
g AS (SELECT CASE WHEN user_age < 20 THEN '{AGE_BAND_LABELS[0]}' WHEN user_age <= 30 THEN '{AGE_BAND_LABELS[1]}'
                  WHEN user_age IS NOT NULL THEN '{AGE_BAND_LABELS[2]}' END AS name,
             count(*) AS value FROM wide GROUP BY 1)
SELECT name, value, CAST(value AS DOUBLE) / CAST(sum(value) OVER () AS DOUBLE) AS pct FROM g""",
    "region_sales": f"WITH {_REGION}\nSELECT * FROM region_sales",
    "region_bins": f"""WITH {_REGION}
SELECT name, value, CAST(greatest(0, least(floor(value / 100), 5)) AS INTEGER) AS bin FROM region_sales""",
    "sales_by_name": """
SELECT p.p_name AS name, CAST(sum(l.l_quantity) AS BIGINT) AS num
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY p.p_name""",
    "array_terms": """
SELECT term, count(*) AS doc_count
FROM (SELECT unnest(list_distinct(string_split(p_name, ' '))) AS term FROM part)
GROUP BY term ORDER BY doc_count DESC, term ASC LIMIT 10""",
    "resume_offsets": """WITH rows AS (
  SELECT event_id, event_id // 2500 AS epoch, (event_id % 2500) // 1000 AS batch_id FROM events
  UNION ALL
  SELECT event_id, event_id // 2500 + 1, 0 FROM events WHERE event_id % 2500 >= 2000),
prog AS (
  SELECT CAST(event_id % 4 AS INTEGER) AS partition, epoch, batch_id, max(event_id) + 1 AS until_offset
  FROM rows GROUP BY 1, 2, 3)
SELECT 'app_start' AS topic, 'dau_group' AS grp, partition, epoch, batch_id, until_offset FROM prog
QUALIFY row_number() OVER (PARTITION BY partition ORDER BY epoch DESC, batch_id DESC) = 1""",
    "offset_gaps": """WITH a AS (
  SELECT CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS o,
         CASE WHEN event_id % 211 = 0 THEN 2 ELSE 1 END AS times
  FROM events WHERE event_id % 97 <> 13 AND event_id NOT BETWEEN 500 AND 519),
g AS (SELECT partition, o, lag(o) OVER (PARTITION BY partition ORDER BY o) AS p FROM a)
SELECT partition, 'missing' AS kind, p + 1 AS first, o - 1 AS last, o - p - 1 AS n FROM g WHERE o - p > 1
UNION ALL
SELECT partition, 'repeated', o, o, CAST(times AS BIGINT) FROM a WHERE times > 1""",
    "dau_hour_folded": f"WITH {_SL}, {_FIRST}, {_DAU_HOUR}\nSELECT dt, hr, dau FROM dau_hour",
    "active_windows": f"""WITH {_SL}, d AS (SELECT DISTINCT dt, CAST(dt AS DATE) AS day, mid FROM sl),
days AS (SELECT DISTINCT dt, day FROM d)
SELECT days.dt, count(DISTINCT CASE WHEN d.day = days.day THEN mid END) AS active_1d,
       count(DISTINCT CASE WHEN d.day > days.day - 7 THEN mid END) AS active_7d, count(DISTINCT mid) AS active_30d
FROM days JOIN d ON d.day <= days.day AND d.day > days.day - 30 GROUP BY days.dt""",
    "active_by_shift": f"""WITH {_SL}
SELECT dt, CAST(CAST(hr AS INTEGER) // 8 AS INTEGER) AS shift, count(DISTINCT mid) AS devices FROM sl GROUP BY 1, 2""",
    "keyword_matches": f"""SELECT k.keyword, p_partkey AS sku_id, p_name AS sku_name
FROM part, (SELECT unnest({list(INDEX_KEYWORDS)!r}) AS keyword) k
WHERE contains(lower(p_name), lower(k.keyword))""",
    "sale_detail_deep_page": f"""WITH {_WIDE.format(where='')}
SELECT * FROM wide ORDER BY {_PAGE_ORDER} LIMIT {SEARCH_SIZE} OFFSET {(DEEP_PAGE - 1) * SEARCH_SIZE}""",
}

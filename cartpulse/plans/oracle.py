"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Tables ``events orders lineitem customer part nation ...`` are views over the
same parquet files. Column names equal the Spark queries' names.
"""

from __future__ import annotations

HOUR_US = 3_600_000_000
ALERT_SIZE_US = 6 * HOUR_US   # 6-hour windows
ALERT_SLIDE_US = HOUR_US      # sliding by 1 hour

STARTUP = """startup AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid, event_type AS type, ts,
         CAST(ts AS DATE) AS log_date, strftime(ts, '%H') AS log_hour
  FROM events)"""

DAU = STARTUP + """,
dau AS (
  SELECT mid, log_date, event_id, uid, type, ts, log_hour FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, log_date ORDER BY ts, event_id) AS rn FROM startup)
  WHERE rn = 1)"""

CROSS_BATCH = STARTUP + """,
b AS (SELECT *, epoch_us(ts) // 3600000000 AS batch_id FROM startup),
f AS (
  SELECT mid, log_date, batch_id, event_id, uid, type, ts, log_hour FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, log_date, batch_id ORDER BY ts, event_id) AS rn FROM b)
  WHERE rn = 1),
kept AS (
  SELECT * FROM f WHERE NOT EXISTS (
    SELECT 1 FROM f s WHERE s.mid = f.mid AND s.log_date = f.log_date AND s.batch_id < f.batch_id))"""

HOURLY_ORDERS = """hourly AS (
  SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, value AS total_amount,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time, CAST(ts AS DATE) AS create_date,
         strftime(ts, '%H') AS create_hour
  FROM events WHERE event_type = 'purchase')"""

GMV_HOURS = HOURLY_ORDERS + """,
gh AS (
  SELECT create_date, create_hour, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS order_amount
  FROM hourly GROUP BY create_date, create_hour)"""

EVENT_BASE = """ev AS (
  SELECT event_id, CAST(user_id // 5 AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
         CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'view' THEN 'clickItem' ELSE event_type END AS evid,
         json_extract_string(props, '$.k') AS itemid,
         date_trunc('day', ts) + to_microseconds((user_id // 5 % 24) * 3600000000
           + (epoch_us(ts) - epoch_us(date_trunc('day', ts))) // 144) AS ts
  FROM events)"""

def event_log_sql(size_us: int, slide_us: int) -> str:
    """CTEs ev / win / alerts / alert_ev for sliding windows of ``size_us`` every ``slide_us``."""
    return EVENT_BASE + f""",
win AS (
  SELECT ev.*, unnest(range((epoch_us(ts) - {size_us}) // {slide_us} + 1,
                            epoch_us(ts) // {slide_us} + 1)) AS k
  FROM ev),
alerts AS (
  SELECT mid, k,
         make_timestamp(k * {slide_us}) AS window_start,
         make_timestamp(k * {slide_us} + {size_us}) AS window_end,
         count(DISTINCT uid) FILTER (WHERE evid = 'coupon') AS n_uids,
         array_to_string(list_sort(list(DISTINCT uid) FILTER (WHERE evid = 'coupon' AND uid IS NOT NULL)), ',') AS uids,
         array_to_string(list_sort(list(DISTINCT itemid) FILTER (WHERE evid = 'coupon' AND itemid IS NOT NULL)), ',') AS item_ids
  FROM win WHERE evid IN ('coupon', 'clickItem')
  GROUP BY mid, k
  HAVING count(DISTINCT uid) FILTER (WHERE evid = 'coupon') >= 3 AND NOT bool_or(evid = 'clickItem')),
alert_ev AS (
  SELECT a.mid, a.k, count(*) AS n_events, string_agg(w.evid, ',' ORDER BY w.ts, w.event_id) AS events
  FROM alerts a JOIN win w ON a.mid = w.mid AND a.k = w.k
  GROUP BY a.mid, a.k)"""


def alert_documents_sql(log: str, bucket_us: int) -> str:
    """One document per device and ``bucket_us`` of window end; the newest window wins."""
    return f"""WITH {log},
docs AS (
  SELECT a.mid || ':' || CAST(epoch_us(a.window_end) // {bucket_us} AS VARCHAR) AS alert_id, a.mid,
         a.window_end AS ts, a.window_start, a.uids, a.item_ids, e.events
  FROM alerts a LEFT JOIN alert_ev e ON a.mid = e.mid AND a.k = e.k)
SELECT alert_id, mid, ts, window_start, uids, item_ids, events FROM (
  SELECT *, row_number() OVER (PARTITION BY alert_id ORDER BY ts DESC) AS rn FROM docs) WHERE rn = 1"""


EVENT_LOG = event_log_sql(ALERT_SIZE_US, ALERT_SLIDE_US)

SALE = """sale AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_detail_id,
         l_orderkey AS order_id, o_custkey AS user_id, l_partkey AS sku_id, c_mktsegment AS user_segment,
         p_size AS user_age, p_retailprice AS sku_price, p_name AS sku_name, p_brand AS sku_tm_id,
         l_quantity AS sku_num, l_extendedprice AS order_price, n_name AS province, CAST(o_orderdate AS DATE) AS dt
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN nation ON c_nationkey = n_nationkey)"""

SEARCH = SALE + """,
found AS (SELECT * FROM sale WHERE contains(lower(sku_name), 'ring'))"""


def _hours_sql(cte: str, src: str, day: str, hour: str, value: str, zero: str) -> str:
    return f"""WITH {cte},
hv AS (SELECT {day} AS day, {hour} AS hour, {value} AS v FROM {src}),
spine AS (SELECT d.day, lpad(CAST(h.h AS VARCHAR), 2, '0') AS hour
          FROM (SELECT DISTINCT day FROM hv) d, range(24) h(h))
SELECT s.day, s.hour, COALESCE(t.v, {zero}) AS today, COALESCE(y.v, {zero}) AS yesterday
FROM spine s
LEFT JOIN hv t ON t.day = s.day AND t.hour = s.hour
LEFT JOIN hv y ON y.day + 1 = s.day AND y.hour = s.hour"""


ORACLE_SQL: dict[str, str] = {
    "event_date_hour": f"WITH {STARTUP} SELECT event_id, mid, uid, type, ts, log_date, log_hour FROM startup",
    "order_date_hour": f"WITH {HOURLY_ORDERS} SELECT * FROM hourly",
    "parse_startup": f"WITH {STARTUP} SELECT mid, uid, type, epoch_us(ts) // 1000 AS ts, log_date, log_hour, "
                     "CAST(NULL AS VARCHAR) AS _corrupt_record FROM startup",
    "parse_events": f"WITH {EVENT_BASE} "
                    "SELECT mid, uid, evid, itemid, epoch_us(ts) // 1000 AS ts, CAST(ts AS DATE) AS log_date, "
                    "strftime(ts, '%H') AS log_hour, CAST(NULL AS VARCHAR) AS _corrupt_record FROM ev",
    "parse_orders": """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
  o_orderstatus AS order_status, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total_amount,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time, CAST(o_orderdate AS DATE) AS create_date,
  strftime(o_orderdate, '%H') AS create_hour, CAST(NULL AS VARCHAR) AS _corrupt_record
FROM orders""",
    "cdc_order_inserts": """SELECT CAST(json_object('id', CAST(o_orderkey AS VARCHAR), 'user_id', CAST(o_custkey AS VARCHAR),
  'order_status', o_orderstatus, 'total_amount', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR),
  'create_time', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')) AS VARCHAR) AS value
FROM orders""",
    "dau_first": f"WITH {DAU} SELECT * FROM dau",
    "dau_cross_batch": f"WITH {CROSS_BATCH} SELECT * FROM kept",
    "dau_total": f"WITH {DAU} SELECT log_date, count(*) AS dau FROM dau GROUP BY log_date",
    "dau_hours": f"WITH {DAU} SELECT log_date, log_hour, count(*) AS dau FROM dau GROUP BY log_date, log_hour",
    "dedup_counts": f"""WITH {CROSS_BATCH},
n_in AS (SELECT batch_id, count(*) AS n_before FROM b GROUP BY batch_id),
n_out AS (SELECT batch_id, count(*) AS n_after FROM kept GROUP BY batch_id)
SELECT n_in.batch_id, n_before, COALESCE(n_after, 0) AS n_after FROM n_in LEFT JOIN n_out USING (batch_id)""",
    "new_devices": f"""WITH {DAU}
SELECT log_date, count(*) AS new_mid FROM (SELECT mid, min(log_date) AS log_date FROM dau GROUP BY mid)
GROUP BY log_date""",
    "gmv_total": """SELECT CAST(o_orderdate AS DATE) AS create_date,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_amount
FROM orders GROUP BY 1""",
    "gmv_hours": f"WITH {GMV_HOURS} SELECT * FROM gh",
    "hours_map": f"""WITH {DAU},
h AS (SELECT log_date, log_hour, count(*) AS n FROM dau GROUP BY log_date, log_hour)
SELECT log_date AS day, '{{' || string_agg('"' || log_hour || '":' || CAST(n AS VARCHAR), ',' ORDER BY log_hour) || '}}' AS hours
FROM h GROUP BY log_date""",
    "realtime_total": f"""WITH {DAU}, {HOURLY_ORDERS},
d AS (SELECT log_date AS day, count(*) AS dau FROM dau GROUP BY 1),
nm AS (SELECT log_date AS day, count(*) AS new_mid
       FROM (SELECT mid, min(log_date) AS log_date FROM dau GROUP BY mid) GROUP BY 1),
g AS (SELECT create_date AS day, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS amt
      FROM hourly GROUP BY 1),
dd AS (SELECT day FROM d UNION SELECT day FROM g WHERE day IS NOT NULL)
SELECT dd.day, 'dau' AS id, '新增日活' AS name, CAST(COALESCE(d.dau, 0) AS DOUBLE) AS value FROM dd LEFT JOIN d USING (day)
UNION ALL
SELECT dd.day, 'new_mid', '新增设备', CAST(COALESCE(nm.new_mid, 0) AS DOUBLE) FROM dd LEFT JOIN nm USING (day)
UNION ALL
SELECT dd.day, 'order_amount', '新增交易额', g.amt FROM dd LEFT JOIN g USING (day)""",
    "realtime_hours_dau": _hours_sql(DAU + ",\ndh AS (SELECT log_date, log_hour, count(*) AS dau FROM dau GROUP BY 1, 2)",
                                     "dh", "log_date", "log_hour", "dau", "0"),
    "realtime_hours_gmv": _hours_sql(GMV_HOURS, "gh", "create_date", "create_hour", "order_amount", "0.0"),
    "coupon_alerts": f"WITH {EVENT_LOG} SELECT mid, window_start, window_end, n_uids, uids, item_ids FROM alerts",
    "alert_events": f"""WITH {EVENT_LOG}
SELECT a.mid, a.window_start, a.window_end, e.n_events, e.events
FROM alerts a JOIN alert_ev e ON a.mid = e.mid AND a.k = e.k""",
    "alert_upsert": alert_documents_sql(EVENT_LOG, 86_400_000_000),
    "sale_detail_wide": f"WITH {SALE} SELECT * FROM sale",
    "sale_detail_search": f"WITH {SEARCH} SELECT * FROM found",
    "sale_detail_page": f"""WITH {SEARCH}
SELECT *, (SELECT count(*) FROM found) AS total FROM found ORDER BY order_id, order_detail_id LIMIT 20 OFFSET 20""",
    "sale_share_segment": f"""WITH {SALE}
SELECT user_segment, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM sale GROUP BY user_segment""",
    "sale_share_band": f"""WITH {SALE},
banded AS (SELECT CASE WHEN user_age IS NULL THEN NULL WHEN user_age < 20 THEN '20岁以下'
                       WHEN user_age < 30 THEN '20-30岁' ELSE '30岁以上' END AS age_band FROM sale)
SELECT age_band, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM banded GROUP BY age_band""",
    "sales_by_province": f"""WITH {SALE}
SELECT province, sum(sku_num) AS quantity, CAST(sum(CAST(order_price AS DECIMAL(18,2))) AS DOUBLE) AS amount,
       CAST(least(floor(sum(sku_num) / 100), 5) AS INTEGER) AS color_class
FROM sale GROUP BY province""",
}

# Streams: same result as the batch twin on time-ordered input.
ORACLE_SQL.update({
    "coupon_alerts_5min": f"""WITH {event_log_sql(5 * 60_000_000, 5_000_000)}
SELECT mid, window_start, window_end, n_uids, uids, item_ids FROM alerts""",
    "stream_dau": ORACLE_SQL["dau_first"],
    "stream_gmv": ORACLE_SQL["gmv_hours"],
    "stream_coupon_alerts": ORACLE_SQL["coupon_alerts"],
    "alert_documents_minute": alert_documents_sql(event_log_sql(5 * 60_000_000, 5_000_000), 60_000_000),
    "stream_alert_documents": alert_documents_sql(event_log_sql(5 * 60_000_000, 5_000_000), 60_000_000),
    "sale_detail_stream": ORACLE_SQL["sale_detail_wide"],
    "stream_cdc_order_inserts": ORACLE_SQL["cdc_order_inserts"],
})


def _on(query: str, column: str, date: str) -> str:
    return f"SELECT * FROM ({ORACLE_SQL[query]}) WHERE {column} = DATE '{date}'"


ORACLE_SQL.update({
    "sales_by_province_scaled": ORACLE_SQL["sales_by_province"].replace("sum(sku_num) / 100), 5)", "sum(sku_num) / 1000), 999)"),
    "sale_detail_day": f"""WITH {SALE}
SELECT * FROM sale WHERE dt = DATE '1997-09-21' AND contains(lower(sku_name), 'ring')""",
    "sale_detail_page_full": f"""WITH {SEARCH},
banded AS (SELECT *, CASE WHEN user_age IS NULL THEN NULL WHEN user_age < 20 THEN '20岁以下'
                          WHEN user_age < 30 THEN '20-30岁' ELSE '30岁以上' END AS age_band FROM found),
seg AS (SELECT user_segment AS k, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM banded GROUP BY 1),
band AS (SELECT age_band AS k, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM banded GROUP BY 1),
paged AS (SELECT * FROM found ORDER BY order_id, order_detail_id LIMIT 20 OFFSET 20)
SELECT (SELECT count(*) FROM found) AS total,
       (SELECT string_agg(order_detail_id, ',' ORDER BY order_id, order_detail_id) FROM paged) AS page,
       (SELECT string_agg(concat_ws(':', coalesce(k, ''), n, share), ',' ORDER BY k NULLS FIRST) FROM seg) AS segments,
       (SELECT string_agg(concat_ws(':', coalesce(k, ''), n, share), ',' ORDER BY k NULLS FIRST) FROM band) AS age_bands""",
    "dau_total_day": _on("dau_total", "log_date", "2024-01-15"),
    "dau_hours_day": _on("dau_hours", "log_date", "2024-01-15"),
    "gmv_total_day": _on("gmv_total", "create_date", "1997-09-21"),
    "gmv_hours_day": _on("gmv_hours", "create_date", "2024-01-15"),
    "realtime_hours_dau_day": _on("realtime_hours_dau", "day", "2024-01-15"),
    "realtime_hours_gmv_day": _on("realtime_hours_gmv", "day", "2024-01-15"),
    "realtime_total_day": _on("realtime_total", "day", "2024-01-15"),
})

ORACLE_SQL["stream_dashboard"] = " UNION ALL ".join(
    [f"SELECT 'total' AS part, day, id AS key, value AS today, CAST(NULL AS DOUBLE) AS yesterday FROM ({ORACLE_SQL['realtime_total']})"]
    + [f"SELECT '{metric}' AS part, day, hour AS key, CAST(today AS DOUBLE) AS today, CAST(yesterday AS DOUBLE) AS yesterday FROM ({ORACLE_SQL[query]})"
       for metric, query in (("dau", "realtime_hours_dau"), ("order_amount", "realtime_hours_gmv"))])
ORACLE_SQL["sale_detail_deep_page"] = f"""WITH {SALE}
SELECT *, (SELECT count(*) FROM sale) AS total FROM sale ORDER BY order_id, order_detail_id, sku_id, order_price LIMIT 20 OFFSET 5000"""
ORACLE_SQL["sale_detail_next_page"] = f"""WITH {SALE}
SELECT * FROM sale WHERE order_id > 700 OR order_id = 700 AND (order_detail_id > '700-3' OR order_detail_id = '700-3' AND sku_id > 0)
ORDER BY order_id, order_detail_id, sku_id, order_price LIMIT 20"""
ORACLE_SQL["sale_detail_indexed_search"] = ORACLE_SQL["sale_detail_search"]
ORACLE_SQL["stream_sale_late_orders"] = ORACLE_SQL["sale_detail_wide"]

# --- full records: stand-in fields follow from the ids, every 50th record has a broken text beside it
_BROKEN = """SELECT {nulls}, '{{"mid": broken ' || CAST({id} AS VARCHAR) AS _corrupt_record FROM {table} WHERE {id} % 50 = 0"""


def _broken(columns: list[str], table: str, id_col: str) -> str:
    return _BROKEN.format(nulls=", ".join(f"NULL AS {c}" for c in columns), table=table, id=id_col)


STARTUP_JSON = STARTUP + """,
full_startup AS (
  SELECT mid, uid, 'app' || (user_id % 3) AS appid, 'area ' || (user_id % 34) AS area, CASE WHEN user_id % 2 = 0 THEN 'ios' ELSE 'android' END AS os,
         'ch' || (user_id % 5) AS ch, type, '1.' || (event_id % 4) AS vs, epoch_us(ts) // 1000 AS ts, log_date, log_hour
  FROM startup JOIN (SELECT event_id, user_id FROM events) USING (event_id))"""
_STARTUP = ["mid", "uid", "appid", "area", "os", "ch", "type", "vs", "ts", "log_date", "log_hour"]
_EVENT = ["mid", "uid", "appid", "area", "os", "type", "evid", "pgid", "npgid", "itemid", "ts", "log_date", "log_hour"]
ORACLE_SQL["parse_startup"] = f"""WITH {STARTUP_JSON}
SELECT {", ".join(_STARTUP)}, CAST(NULL AS VARCHAR) AS _corrupt_record FROM full_startup UNION ALL {_broken(_STARTUP, "events", "event_id")}"""
ORACLE_SQL["stream_dau_json"] = f"""WITH {STARTUP_JSON}
SELECT {", ".join(_STARTUP)}, CAST(NULL AS VARCHAR) AS broken FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, log_date ORDER BY ts, uid, appid, area, os, ch, type, vs) AS rn FROM full_startup) WHERE rn = 1
UNION ALL {_broken(_STARTUP, "events", "event_id")}"""
ORACLE_SQL["parse_events"] = f"""WITH {EVENT_BASE}
SELECT mid, uid, 'app' || (CAST(uid AS BIGINT) % 3) AS appid, 'area ' || (CAST(uid AS BIGINT) % 34) AS area,
       CASE WHEN CAST(uid AS BIGINT) % 2 = 0 THEN 'ios' ELSE 'android' END AS os, 'event' AS type, evid, 'p' || (event_id % 9) AS pgid,
       'p' || ((event_id + 1) % 9) AS npgid, itemid, epoch_us(ts) // 1000 AS ts, CAST(ts AS DATE) AS log_date, strftime(ts, '%H') AS log_hour,
       CAST(NULL AS VARCHAR) AS _corrupt_record FROM ev UNION ALL {_broken(_EVENT, "events", "event_id")}"""
_ORDER_COLUMNS = {
    "id": "CAST(o_orderkey AS VARCHAR)", "province_id": "CAST(o_custkey % 34 AS VARCHAR)", "consignee": "'user ' || o_custkey",
    "order_comment": "CAST(NULL AS VARCHAR)", "consignee_tel": "lpad(CAST(o_custkey AS VARCHAR), 11, '1')", "order_status": "o_orderstatus",
    "payment_way": "CAST(o_orderkey % 3 AS VARCHAR)", "user_id": "CAST(o_custkey AS VARCHAR)", "img_url": "'/img/' || o_orderkey || '.png'",
    "total_amount": "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)", "expire_time": "strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S')",
    "delivery_address": "'street ' || (o_custkey % 100) || ', \"east\"'", "create_time": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')",
    "operate_time": "strftime(o_orderdate + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S')", "tracking_no": "'T' || o_orderkey",
    "parent_order_id": "CASE WHEN o_orderkey % 10 = 0 THEN CAST(o_orderkey - 1 AS VARCHAR) END", "out_trade_no": "'O' || o_orderkey",
    "trade_body": "'order ' || o_orderkey"}
ORACLE_SQL["cdc_order_inserts"] = ORACLE_SQL["stream_cdc_order_inserts"] = \
    f"SELECT CAST(json_object({', '.join(f"'{c}', {v}" for c, v in _ORDER_COLUMNS.items())}) AS VARCHAR) AS value FROM orders"
_ORDER = [*_ORDER_COLUMNS, "create_date", "create_hour"]
ORACLE_SQL["parse_orders"] = f"""WITH o AS (SELECT {", ".join(f"{v} AS {c}" for c, v in _ORDER_COLUMNS.items())}, CAST(o_orderdate AS DATE) AS create_date,
  strftime(o_orderdate, '%H') AS create_hour FROM orders)
SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount), CAST(NULL AS VARCHAR) AS _corrupt_record FROM o
UNION ALL {_broken(_ORDER, "orders", "o_orderkey")}"""

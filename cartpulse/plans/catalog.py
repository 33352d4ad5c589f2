"""Registered queries over the test tables and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. Column names match the oracle SQL one for one.

Alert queries run at the real setting (5-minute windows every 5 seconds, one
document a device and minute: ``*_5min``, ``*_minute``, ``stream_alert_documents``)
and at 6 hours / 1 hour / one document a day. Micro-batches of the replayed start-up log are 1 hour of
event time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.functions.money import sorted_csv
from cartpulse.operators import alerts as AL
from cartpulse.operators import cdc as CDC
from cartpulse.operators import dau as DAU
from cartpulse.operators import gmv as GMV
from cartpulse.operators import paging as PAGES
from cartpulse.operators import search_index as NAMES
from cartpulse.operators import sales as SALES
from cartpulse.plans import dashboard as DASH
from cartpulse.plans.publisher import HourPublisher
from cartpulse.sources import json_logs as JL
from cartpulse.session import scratch_path
from cartpulse.sources import tables as TB
from cartpulse.streaming import alert_stream as AS
from cartpulse.streaming import cdc_stream as CS
from cartpulse.streaming import dau_stream as DS
from cartpulse.streaming import first_days as FD
from cartpulse.streaming import folds as FO
from cartpulse.streaming import gmv_stream as GS
from cartpulse.streaming import replay as RP
from cartpulse.streaming import sale_stream as SS
from cartpulse.streaming import sinks as SK

# --- test-table parameters ---
ALERT_WINDOW_T = "6 hours"
ALERT_SLIDE_T = "1 hour"
ALERT_BUCKET_MS_T = 86_400_000
BATCH_MS_T = 3_600_000
SEARCH_KEYWORD_T = "ring"
PAGE_START_T = 20
PAGE_LENGTH_T = 20
DEEP_START_T, AFTER_T = 5000, (700, "700-3", 0, 0.0)
STABLE_ORDER_T = ("order_id", "order_detail_id", "sku_id", "order_price")  # line numbers repeat within an order of the test tables
DAY_T, DAY_BEFORE_T = "2024-01-15", "2024-01-14"  # events: the dashboard's date
SALE_DAY_T = "1997-09-21"  # orders: the sale page's date
PROVINCE_WIDTH_T, PROVINCE_TOP_T = 1000, 1_000_000

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- derive / parse

def q_event_date_hour(spark, sf):
    return TB.startup_log(spark, sf)


def q_order_date_hour(spark, sf):
    return GMV.order_facts(TB.hourly_orders(spark, sf))


def q_parse_startup(spark, sf):
    msgs = JL.startup_messages(TB.startup_log(spark, sf))
    return JL.parse_startup(msgs)


def q_parse_events(spark, sf):
    msgs = JL.event_messages(TB.event_log(spark, sf))
    return JL.parse_events(msgs)


def _changes(spark, sf):
    return CDC.change_log_from_tables(TB.load_table(spark, sf, "orders"), TB.load_table(spark, sf, "lineitem"))


def q_cdc_order_inserts(spark, sf):
    return CDC.row_inserts(_changes(spark, sf), database=CDC.STAND_IN_DATABASE)


def q_parse_orders(spark, sf):
    orders = TB.load_table(spark, sf, "orders", ["o_orderkey"])
    return JL.parse_orders(JL.order_messages(q_cdc_order_inserts(spark, sf), orders, "o_orderkey"))


# ---------------------------------------------------------------- devices

def _active(spark, sf):
    """Device and day only: counting needs no first row."""
    return DAU.active_devices(TB.startup_log(spark, sf))


def _hours(spark, sf, days=None):
    return DAU.dau_hours(DAU.first_hours(TB.startup_log(spark, sf, days)))


def q_dau_first(spark, sf):
    return DAU.dau_rows(TB.startup_log(spark, sf))


def q_dau_cross_batch(spark, sf):
    return DAU.dau_cross_batch(TB.startup_log(spark, sf), BATCH_MS_T)


def q_dau_total(spark, sf):
    return DAU.dau_total(_active(spark, sf))


def q_dau_hours(spark, sf):
    return _hours(spark, sf)


def q_dedup_counts(spark, sf):
    return DAU.dedup_counts(TB.startup_log(spark, sf), BATCH_MS_T)


def q_new_devices(spark, sf):
    return DAU.new_devices(_active(spark, sf))


# ---------------------------------------------------------------- order value

def q_gmv_total(spark, sf):
    return GMV.gmv_total(GMV.order_facts(TB.daily_orders(spark, sf)))


def q_gmv_hours(spark, sf):
    return GMV.gmv_hours(GMV.order_facts(TB.hourly_orders(spark, sf)))


# ---------------------------------------------------------------- dashboard

def q_hours_map(spark, sf):
    return DASH.hours_map(_hours(spark, sf), "log_date", "log_hour", "dau")


def q_realtime_total(spark, sf):
    dau = _active(spark, sf)
    gmv = GMV.gmv_total(GMV.order_facts(TB.hourly_orders(spark, sf)))
    return DASH.realtime_total(DAU.dau_and_new_devices(dau), None, gmv)


def q_realtime_hours_dau(spark, sf):
    return DASH.realtime_hours(_hours(spark, sf), "log_date", "log_hour", "dau")


def q_realtime_hours_gmv(spark, sf):
    hours = GMV.gmv_hours(GMV.order_facts(TB.hourly_orders(spark, sf)))
    return DASH.realtime_hours(hours, "create_date", "create_hour", "order_amount", zero=0.0)


# ---------------------------------------------------------------- alerts

def _alerts(spark, sf):
    return AL.coupon_alerts(TB.event_log(spark, sf), ALERT_WINDOW_T, ALERT_SLIDE_T)


def q_coupon_alerts(spark, sf):
    a = _alerts(spark, sf)
    return a.select("mid", "window_start", "window_end", F.size("uids").cast("bigint").alias("n_uids"),
                    sorted_csv("uids").alias("uids"), sorted_csv("item_ids").alias("item_ids"))


def q_coupon_alerts_5min(spark, sf):
    """The alert rule at its real setting: 5-minute windows sliding by 5 seconds (60 windows per bucket)."""
    a = AL.coupon_alerts(TB.event_log(spark, sf))
    return a.select("mid", "window_start", "window_end", F.size("uids").cast("bigint").alias("n_uids"),
                    sorted_csv("uids").alias("uids"), sorted_csv("item_ids").alias("item_ids"))


def q_alert_events(spark, sf):
    ev = AL.coupon_alerts(TB.event_log(spark, sf), ALERT_WINDOW_T, ALERT_SLIDE_T, with_events=True)
    return ev.select("mid", "window_start", "window_end", F.size("events").cast("bigint").alias("n_events"),
                     F.array_join("events", ",").alias("events"))


def q_alert_upsert(spark, sf):
    return _doc_columns(AL.event_documents(TB.event_log(spark, sf), ALERT_WINDOW_T, ALERT_SLIDE_T, ALERT_BUCKET_MS_T))


def q_alert_documents_minute(spark, sf):
    return _doc_columns(AL.event_documents(TB.event_log(spark, sf)))


def _doc_columns(docs):
    return docs.select("alert_id", "mid", "ts", "window_start", sorted_csv("uids").alias("uids"),
                       sorted_csv("item_ids").alias("item_ids"), F.array_join("events", ",").alias("events"))


# ---------------------------------------------------------------- sale detail

def _tables(spark, sf, *names):
    return [TB.load_table(spark, sf, n) for n in names]


def _sale(spark, sf, date=None, keyword=None, columns=None):
    return SALES.sale_detail(*_tables(spark, sf, "lineitem", "orders", "customer", "part", "nation"),
                             date=date, keyword=keyword, columns=columns)


def q_sale_detail_wide(spark, sf):
    return _sale(spark, sf)


def q_sale_detail_search(spark, sf):
    return _sale(spark, sf, keyword=SEARCH_KEYWORD_T)


def q_sale_detail_page(spark, sf):
    return SALES.page(_sale(spark, sf, keyword=SEARCH_KEYWORD_T), PAGE_START_T, PAGE_LENGTH_T)


def q_sale_detail_deep_page(spark, sf):
    """A page deep inside all sale rows, from the stored page index."""
    path = scratch_path(spark, "sale_pages")
    PAGES.write_pages(_sale(spark, sf), path, STABLE_ORDER_T)
    return PAGES.Pages(spark, path).page(DEEP_START_T, PAGE_LENGTH_T)


def q_sale_detail_next_page(spark, sf):
    """The page behind a known row, from the stored page index, without an offset."""
    path = scratch_path(spark, "sale_pages")
    PAGES.write_pages(_sale(spark, sf), path, STABLE_ORDER_T)
    return PAGES.Pages(spark, path).after(AFTER_T, PAGE_LENGTH_T)


def q_sale_detail_indexed_search(spark, sf):
    """The keyword search with the products found by the index of name pieces."""
    path = scratch_path(spark, "name_index")
    tables = dict(zip(("lineitem", "orders", "customer", "part", "nation"), _tables(spark, sf, "lineitem", "orders", "customer", "part", "nation")))
    NAMES.write_index(tables["part"], path, "p_partkey", "p_name")
    tables["part"] = NAMES.search(spark, path, tables["part"], "p_partkey", "p_name", SEARCH_KEYWORD_T)
    return SALES.sale_detail(**tables, keyword=SEARCH_KEYWORD_T)


def q_sale_share_segment(spark, sf):
    return SALES.share_by_segment(_sale(spark, sf, columns=["user_segment"]))


def q_sale_share_band(spark, sf):
    return SALES.share_by_age_band(_sale(spark, sf, columns=["user_age"]))


def q_sales_by_province(spark, sf):
    return SALES.sales_by_province(_sale(spark, sf, columns=["province", "sku_num", "order_price"]))


def q_sales_by_province_scaled(spark, sf):
    """The map's classes with a width that tells the provinces of the test tables apart."""
    detail = _sale(spark, sf, columns=["province", "sku_num", "order_price"])
    return SALES.sales_by_province(detail, PROVINCE_WIDTH_T, PROVINCE_TOP_T)


def q_sale_detail_day(spark, sf):
    return _sale(spark, sf, SALE_DAY_T, SEARCH_KEYWORD_T)


def q_sale_detail_page_full(spark, sf):
    """The sale page in one row: total, page, shares of the matched rows; the matches are joined once and stored."""
    path = f"{scratch_path(spark, 'sale_page')}/matched"
    _sale(spark, sf, keyword=SEARCH_KEYWORD_T).write.parquet(path)
    page = SALES.sale_page(spark.read.parquet(path), PAGE_START_T, PAGE_LENGTH_T)

    def text(array, key):
        one = lambda x: F.concat_ws(":", F.coalesce(x[key], F.lit("")), x["n"], F.round(x["share"], 6))
        return F.array_join(F.transform(array, one), ",")

    return page.select("total", F.array_join(F.transform("detail", lambda x: x["order_detail_id"]), ",").alias("page"),
                       text("segments", "user_segment").alias("segments"), text("age_bands", "age_band").alias("age_bands"))


# ---------------------------------------------------------------- one date, as the dashboard asks

def q_dau_total_day(spark, sf):
    return DAU.dau_total(DAU.active_devices(TB.startup_log(spark, sf, [DAY_T])))


def q_dau_hours_day(spark, sf):
    return _hours(spark, sf, [DAY_T])


def q_gmv_total_day(spark, sf):
    return GMV.gmv_total(GMV.order_facts(TB.daily_orders(spark, sf, [SALE_DAY_T])), SALE_DAY_T)


def q_gmv_hours_day(spark, sf):
    return GMV.gmv_hours(GMV.order_facts(TB.hourly_orders(spark, sf, [DAY_T])), DAY_T)


def _realtime_hours_day(spark, sf, metric):
    days = [DAY_T, DAY_BEFORE_T]
    return DASH.realtime_hours_for(metric, _hours(spark, sf, days),
                                   GMV.gmv_hours(GMV.order_facts(TB.hourly_orders(spark, sf, days))), DAY_T)


def q_realtime_hours_dau_day(spark, sf):
    return _realtime_hours_day(spark, sf, "dau")


def q_realtime_hours_gmv_day(spark, sf):
    return _realtime_hours_day(spark, sf, "order_amount")


def q_realtime_total_day(spark, sf):
    # new devices need the device history up to the date
    gmv = GMV.gmv_total(GMV.order_facts(TB.hourly_orders(spark, sf, [DAY_T])), DAY_T)
    return DASH.realtime_total(DAU.dau_and_new_devices(_active(spark, sf)), None, gmv, DAY_T)


BATCH_QUERIES: dict[str, Query] = {
    "event_date_hour": q_event_date_hour,
    "order_date_hour": q_order_date_hour,
    "parse_startup": q_parse_startup,
    "parse_events": q_parse_events,
    "parse_orders": q_parse_orders,
    "cdc_order_inserts": q_cdc_order_inserts,
    "dau_first": q_dau_first,
    "dau_cross_batch": q_dau_cross_batch,
    "dau_total": q_dau_total,
    "dau_hours": q_dau_hours,
    "dedup_counts": q_dedup_counts,
    "new_devices": q_new_devices,
    "gmv_total": q_gmv_total,
    "gmv_hours": q_gmv_hours,
    "hours_map": q_hours_map,
    "realtime_total": q_realtime_total,
    "realtime_hours_dau": q_realtime_hours_dau,
    "realtime_hours_gmv": q_realtime_hours_gmv,
    "coupon_alerts": q_coupon_alerts,
    "coupon_alerts_5min": q_coupon_alerts_5min,
    "alert_events": q_alert_events,
    "alert_upsert": q_alert_upsert,
    "alert_documents_minute": q_alert_documents_minute,
    "sale_detail_wide": q_sale_detail_wide,
    "sale_detail_search": q_sale_detail_search,
    "sale_detail_page": q_sale_detail_page,
    "sale_detail_deep_page": q_sale_detail_deep_page,
    "sale_detail_next_page": q_sale_detail_next_page,
    "sale_detail_indexed_search": q_sale_detail_indexed_search,
    "sale_share_segment": q_sale_share_segment,
    "sale_share_band": q_sale_share_band,
    "sales_by_province": q_sales_by_province,
    "sales_by_province_scaled": q_sales_by_province_scaled,
    "sale_detail_day": q_sale_detail_day,
    "sale_detail_page_full": q_sale_detail_page_full,
    "dau_total_day": q_dau_total_day,
    "dau_hours_day": q_dau_hours_day,
    "gmv_total_day": q_gmv_total_day,
    "gmv_hours_day": q_gmv_hours_day,
    "realtime_hours_dau_day": q_realtime_hours_dau_day,
    "realtime_hours_gmv_day": q_realtime_hours_gmv_day,
    "realtime_total_day": q_realtime_total_day,
}

# ---------------------------------------------------------------- streams
# Each stream query stages its input from the tables as time-ordered slices
# under the shared checkpoint folder, runs the stream once per slice with
# ``availableNow`` (restarting from its checkpoint), and returns the sink.

N_SLICES_T = 4
ALERT_DELAY_T = "1 hour"


def q_stream_dau(spark, sf):
    work = scratch_path(spark, "stream_dau")
    startup = TB.startup_log(spark, sf)
    src = f"{work}/source"

    def start():
        return DS.start_dau_stream(RP.stream_reader(spark, src, startup.schema), f"{work}/rows",
                                   f"{work}/checkpoint", counts_table=f"{work}/counts")

    RP.replay([(startup, "ts", src, "parquet")], N_SLICES_T, start)
    return SK.read_table(spark, f"{work}/rows").select("mid", "log_date", "event_id", "uid", "type", "ts", "log_hour")


def q_stream_dau_json(spark, sf):
    """Device rows with all columns, from start-up JSON with broken texts among it."""
    work = scratch_path(spark, "stream_dau_json")
    src = f"{work}/source"

    def start():
        RP.run_available(DS.start_corrupt_stream(spark.readStream.text(src), JL.parse_startup, f"{work}/broken", f"{work}/ck_broken"))
        return DS.start_dau_json_stream(spark.readStream.text(src), f"{work}/rows", f"{work}/checkpoint")

    RP.replay([(JL.startup_messages(TB.startup_log(spark, sf), keep=("ts",)), "ts", src, "text")], N_SLICES_T, start)
    rows = SK.read_table(spark, f"{work}/rows").drop("batch_id").withColumn("broken", F.lit(None).cast("string"))
    broken = SK.read_table(spark, f"{work}/broken").select(F.col("value").alias("broken"))
    return rows.unionByName(broken, allowMissingColumns=True)


def q_stream_gmv(spark, sf):
    work = scratch_path(spark, "stream_gmv")
    orders = TB.hourly_orders(spark, sf)
    msgs = orders.select(F.to_json(F.struct("id", "user_id", "total_amount", "create_time")).alias("value"),
                         F.to_timestamp_ntz("create_time").alias("ts"))
    src = f"{work}/source"

    def start():
        return GS.start_order_stream(spark.readStream.text(src), f"{work}/orders", f"{work}/checkpoint")

    RP.replay([(msgs, "ts", src, "text")], N_SLICES_T, start)
    return GMV.gmv_hours(GS.read_orders(spark, f"{work}/orders"))


def q_stream_coupon_alerts(spark, sf):
    work = scratch_path(spark, "stream_alerts")
    events = TB.event_log(spark, sf)
    src = f"{work}/source"

    def start():
        alerts = AS.alert_stream(AS.events_of_json(spark.readStream.text(src)), ALERT_WINDOW_T, ALERT_SLIDE_T,
                                 ALERT_DELAY_T, bucket_ms=ALERT_BUCKET_MS_T)
        return AS.start_alert_stream(alerts, f"{work}/windows", f"{work}/docs", f"{work}/checkpoint")

    RP.replay([(JL.event_messages(events, keep=("ts",)), "ts", src, "text")], N_SLICES_T, start)
    a = AS.read_alerts(spark, f"{work}/windows")
    return a.select("mid", "window_start", "window_end", F.size("uids").cast("bigint").alias("n_uids"),
                    sorted_csv("uids").alias("uids"), sorted_csv("item_ids").alias("item_ids"))


def q_stream_alert_documents(spark, sf):
    """Alert documents at the real setting: 5-minute windows every 5 seconds, one document a device and minute."""
    work = scratch_path(spark, "stream_alert_docs")
    events = TB.event_log(spark, sf)
    src = f"{work}/source"

    def start():
        AS.fold_alert_docs(spark, f"{work}/docs", 8)
        alerts = AS.alert_stream(RP.stream_reader(spark, src, events.schema), delay=ALERT_DELAY_T, every_event=True)
        return AS.start_alert_stream(alerts, f"{work}/windows", f"{work}/docs", f"{work}/checkpoint")

    RP.replay([(events, "ts", src, "parquet")], N_SLICES_T, start)
    return _doc_columns(AS.read_alert_docs(spark, f"{work}/docs"))


def _hour_publisher(spark, sf):
    """Device and order streams with their hour tables, folded while they grow, and the first-day stream behind the devices."""
    work = scratch_path(spark, "stream_hours")
    startup, orders = TB.startup_log(spark, sf), TB.hourly_orders(spark, sf)
    msgs = orders.select(F.to_json(F.struct("id", "user_id", "total_amount", "create_time")).alias("value"), F.to_timestamp_ntz("create_time").alias("ts"))
    sums = {"dau": ("log_date", FO.added_up(["log_date", "log_hour"], dau="bigint")),
            "amounts": ("create_date", FO.added_up(["create_date", "create_hour"], order_amount="decimal(38,2)")),
            "new": ("log_date", FO.added_up(["log_date"], change="bigint"))}

    def start():
        for name, (day, combine) in sums.items():
            FO.fold(spark, f"{work}/{name}", day, combine, fan=2)
            FO.vacuum(spark, f"{work}/{name}", day, 1)
        RP.run_available(GS.start_order_stream(spark.readStream.text(f"{work}/o_src"), f"{work}/orders", f"{work}/ck_orders", hours_table=f"{work}/amounts"))
        RP.run_available(DS.start_dau_stream(RP.stream_reader(spark, f"{work}/s_src", startup.schema), f"{work}/rows", f"{work}/ck_dau",
                                             hours_table=f"{work}/dau"))
        device_rows = RP.stream_reader(spark, f"{work}/rows", SK.read_table(spark, f"{work}/rows").schema)
        return FD.start_new_device_stream(device_rows, f"{work}/new", f"{work}/ck_new")

    RP.replay([(startup, "ts", f"{work}/s_src", "parquet"), (msgs, "ts", f"{work}/o_src", "text")], N_SLICES_T, start)
    return HourPublisher(spark, f"{work}/dau", f"{work}/amounts", f"{work}/new")


def q_stream_dashboard(spark, sf):
    """The dashboard from partial sums: KPI rows (``part`` total) and both metrics' hours; no device row and no order is read."""
    pub = _hour_publisher(spark, sf)
    none = F.lit(None).cast("double").alias("yesterday")
    parts = [pub.realtime_total().select(F.lit("total").alias("part"), "day", F.col("id").alias("key"), F.col("value").alias("today"), none)]
    parts += [pub.realtime_hours(m).select(F.lit(m).alias("part"), "day", F.col("hour").alias("key"), F.col("today").cast("double").alias("today"),
                                           F.col("yesterday").cast("double").alias("yesterday")) for m in DASH.METRICS]
    return reduce(DataFrame.unionByName, parts)


def q_sale_detail_stream(spark, sf):
    work = scratch_path(spark, "stream_sale")
    orders = TB.load_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    lineitem = TB.load_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                                       "l_extendedprice"])
    # order lines are created with their order: their event time is the order's time
    lines = lineitem.join(orders.select(F.col("o_orderkey").alias("l_orderkey"),
                                        F.col("o_orderdate").alias("create_time")), "l_orderkey")
    o_src, l_src = f"{work}/orders_src", f"{work}/lines_src"
    customer, part, nation = _tables(spark, sf, "customer", "part", "nation")

    def start():
        return SS.start_sale_detail_stream(RP.stream_reader(spark, o_src, orders.schema), RP.stream_reader(spark, l_src, lines.schema),
                                           customer, part, nation, f"{work}/out", f"{work}/checkpoint")

    RP.replay([(orders, "o_orderdate", o_src, "parquet"), (lines, "create_time", l_src, "parquet")],
              N_SLICES_T, start)
    return SK.read_table(spark, f"{work}/out").drop("batch_id")


def q_stream_sale_late_orders(spark, sf):
    """Every seventh customer's orders land 400 days after their lines: those lines are given up by the stream
    and come back by the repair; the result is every line's sale detail."""
    work = scratch_path(spark, "stream_sale_late")
    orders = TB.load_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    lineitem = TB.load_table(spark, sf, "lineitem", SS.LINE_COLUMNS)
    lines = lineitem.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("create_time")), "l_orderkey")
    late = F.when(F.col("o_custkey") % 7 == 0, F.expr("o_orderdate + INTERVAL '400' DAY")).otherwise(F.col("o_orderdate"))
    arriving = orders.withColumn("landed", late)
    o_src, l_src = f"{work}/orders_src", f"{work}/lines_src"
    matched, dead = f"{work}/matched", f"{work}/dead"

    def start():
        return SS.start_sale_stream(RP.stream_reader(spark, o_src, arriving.schema), RP.stream_reader(spark, l_src, lines.schema),
                                    matched, dead, f"{work}/checkpoint")

    RP.replay([(lines, "create_time", l_src, "parquet"), (arriving, "landed", o_src, "parquet")], N_SLICES_T, start)
    SS.rejoin_dead_letters(spark, dead, spark.read.parquet(o_src), 0)
    return SALES.widen_lines(SS.read_sale_lines(spark, matched, dead), *_tables(spark, sf, "customer", "part", "nation"))


def q_stream_cdc_order_inserts(spark, sf):
    work = scratch_path(spark, "stream_cdc")
    changes = _changes(spark, sf)
    src = f"{work}/source"

    def start():
        return CS.start_cdc_stream(RP.stream_reader(spark, src, changes.schema), f"{work}/out", f"{work}/checkpoint", database=CDC.STAND_IN_DATABASE,
                                   compression="gzip")

    RP.replay([(changes, "ts", src, "parquet")], N_SLICES_T, start)
    return spark.read.text(f"{work}/out")


STREAM_QUERIES: dict[str, Query] = {
    "stream_dau": q_stream_dau,
    "stream_dau_json": q_stream_dau_json,
    "stream_gmv": q_stream_gmv,
    "stream_coupon_alerts": q_stream_coupon_alerts,
    "stream_alert_documents": q_stream_alert_documents,
    "stream_dashboard": q_stream_dashboard,
    "sale_detail_stream": q_sale_detail_stream,
    "stream_sale_late_orders": q_stream_sale_late_orders,
    "stream_cdc_order_inserts": q_stream_cdc_order_inserts,
}

ALL_QUERIES: dict[str, Query] = {**BATCH_QUERIES, **STREAM_QUERIES}

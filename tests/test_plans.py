"""Plan-shape checks: the properties that matter at scale, asserted on the physical plans."""

import pytest

import __spark_entry__ as E
from cartpulse.plans.catalog import ALL_QUERIES
from conftest import SF_SMALL

BATCH = [k for k in ALL_QUERIES if not k.startswith("stream_") and k != "sale_detail_stream"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_or_nested_loop_join(spark, no_broadcast, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, p


def test_device_dedup_aggregates_before_the_shuffle(spark):
    p = plan(E.queries()["dau_first"](spark, SF_SMALL))
    assert p.index("partial_min_by") > p.index("Exchange hashpartitioning")  # partial sits below the exchange
    assert "Window" not in p


def test_rollups_read_only_needed_columns(spark):
    p = plan(E.queries()["realtime_hours_dau"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in p  # the hour of the earliest time needs no id


@pytest.mark.parametrize("name", ["coupon_alerts", "coupon_alerts_5min", "alert_events", "alert_upsert", "alert_documents_minute"])
def test_alerts_scan_and_shuffle_the_events_once(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert p.count("FileScan") == 1 and p.count("Exchange") == 1 and "Aggregate" not in p and "Join" not in p, p
    # the only fan-out is an event's one or two time chunks, no copy per window
    assert p.count("Generate") == 1 and "c#" in [line for line in p.splitlines() if "Generate" in line][0]


def test_sale_detail_shuffles_lines_twice(spark, no_broadcast):
    p = plan(E.queries()["sale_detail_wide"](spark, SF_SMALL))
    assert "Exchange hashpartitioning(l_partkey" in p and "Exchange hashpartitioning(l_orderkey" in p
    assert "Exchange hashpartitioning(o_custkey" in p
    assert p.count("Exchange hashpartitioning") == 8  # lines x2, orders x3, customer, part, nation


def test_keyword_filter_reaches_the_part_scan(spark):
    p = plan(E.queries()["sale_detail_search"](spark, SF_SMALL))
    part_scan = [line for line in p.splitlines() if "part.parquet" in line][0]
    assert "ring" in part_scan  # the contains() predicate is evaluated in the part scan, before any join


def test_date_filter_is_pushed_into_the_order_scan(spark):
    from cartpulse.operators import sales as SALES
    from cartpulse.sources.tables import load_table
    t = [load_table(spark, SF_SMALL, n) for n in ("lineitem", "orders", "customer", "part", "nation")]
    p = plan(SALES.sale_detail(*t, date="1998-08-02"))
    order_scan = [line for line in p.splitlines() if "orders.parquet" in line][0]
    assert "PushedFilters: [IsNotNull(o_orderdate)" in order_scan and "GreaterThanOrEqual(o_orderdate" in order_scan


def test_page_is_a_top_k_not_a_global_sort(spark):
    p = plan(E.queries()["sale_detail_page"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p and "rangepartitioning" not in p


def test_shares_join_only_the_tables_they_need(spark, no_broadcast):
    scans = lambda name: {t for t in ("lineitem", "orders", "customer", "part", "nation")
                          if f"{t}.parquet" in plan(E.queries()[name](spark, SF_SMALL))}
    assert scans("sale_share_segment") == {"lineitem", "orders", "customer", "nation"}
    assert scans("sales_by_province") == {"lineitem", "orders", "customer", "nation"}
    assert scans("sale_share_band") == {"lineitem", "orders", "part"}


@pytest.mark.parametrize("name,column", [("dau_total_day", "ts"), ("gmv_total_day", "o_orderdate"), ("gmv_hours_day", "ts")])
def test_a_date_reaches_the_scan(spark, name, column):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert f"GreaterThanOrEqual({column}" in p and f"LessThan({column}" in p, p


@pytest.mark.parametrize("name", ["dau_total", "dau_hours", "dau_hours_day", "hours_map", "realtime_hours_dau", "realtime_hours_dau_day", "dedup_counts"])
def test_counts_of_devices_hash_aggregate(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    scans = [line for line in p.splitlines() if "events.parquet" in line]
    assert len(scans) == (2 if name == "realtime_hours_dau_day" and len(scans) == 2 else 1)
    device_part = p[p.index("HashAggregate"):] if "hours_map" not in name else p
    assert "SortAggregate" not in device_part, p


def test_cross_batch_dedup_scans_once_without_a_join(spark):
    p = plan(E.queries()["dau_cross_batch"](spark, SF_SMALL))
    assert p.count("FileScan") == 1 and p.count("Exchange") == 1 and "Join" not in p, p

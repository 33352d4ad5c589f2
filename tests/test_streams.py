"""Streams: restart safety, idempotent replay, batch = stream on time-ordered input."""

from pyspark.sql import functions as F

from cartpulse.operators import dau as DAU
from cartpulse.session import scratch_path
from cartpulse.sources.tables import startup_log
from cartpulse.streaming import dau_stream as DS
from cartpulse.streaming import sinks as SK
from conftest import SF_SMALL, ts

COLS = ["mid", "log_date", "event_id", "uid", "type", "ts", "log_hour"]


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def test_replayed_batch_changes_nothing(spark):
    work = scratch_path(spark, "test_replay")
    write = DS.dau_batch_writer(f"{work}/rows", f"{work}/counts")
    data = startup_log(spark, SF_SMALL)
    b0 = data.where(F.col("ts") < ts("2024-01-15 00:00:00"))
    b1 = data.where(F.col("ts") >= ts("2024-01-15 00:00:00"))
    write(b0, 0)
    write(b1, 1)
    first = rows(SK.read_table(spark, f"{work}/rows"))
    write(b1, 1)  # the last batch is replayed after a failure
    assert rows(SK.read_table(spark, f"{work}/rows")) == first == rows(DAU.dau_rows(data))
    counts = {r["stream_batch"]: (r["n_before"], r["n_after"]) for r in SK.read_table(spark, f"{work}/counts").collect()}
    assert counts[0][0] + counts[1][0] == data.count()
    assert counts[0][1] + counts[1][1] == len(first)


def test_late_row_of_yesterday_is_kept(spark):
    work = scratch_path(spark, "test_late")
    write = DS.dau_batch_writer(f"{work}/rows")
    schema = "event_id long, mid string, uid string, type string, ts timestamp_ntz"
    from cartpulse.functions.timeparts import with_date_hour
    mk = lambda rs: with_date_hour(spark.createDataFrame(rs, schema), "ts")
    write(mk([(1, "m", "u", "s", ts("2024-01-02 08:00:00"))]), 0)
    write(mk([(2, "m", "u", "s", ts("2024-01-01 23:00:00")), (3, "m", "u", "s", ts("2024-01-02 09:00:00"))]), 1)
    got = {(str(r["log_date"]), r["event_id"]) for r in SK.read_table(spark, f"{work}/rows").collect()}
    assert got == {("2024-01-02", 1), ("2024-01-01", 2)}


def test_stream_queries_equal_batch_twins(spark):
    import __spark_entry__ as E
    q = E.queries()
    pairs = [("stream_dau", "dau_first"), ("stream_gmv", "gmv_hours"), ("sale_detail_stream", "sale_detail_wide"),
             ("stream_cdc_order_inserts", "cdc_order_inserts")]
    for s, b in pairs:
        a, c = q[s](spark, SF_SMALL), q[b](spark, SF_SMALL)
        cols = sorted(c.columns)
        assert sorted(a.columns) == cols, s
        assert sorted(map(tuple, a.select(*cols).collect())) == sorted(map(tuple, c.select(*cols).collect())), s


def test_stream_alerts_are_the_batch_alerts(spark):
    import __spark_entry__ as E
    q = E.queries()
    for s, b in (("stream_coupon_alerts", "coupon_alerts"), ("stream_alert_documents", "alert_documents_minute")):
        streamed, batch = q[s](spark, SF_SMALL), q[b](spark, SF_SMALL)
        assert batch.count() > 0
        cols = batch.columns
        assert sorted(map(tuple, streamed.select(*cols).collect())) == sorted(map(tuple, batch.collect())), s


def _alert_run(spark, work, name, batches):
    """Feeds the batches one by one; returns the alerted windows as read after each."""
    from cartpulse.streaming import alert_stream as AS
    from cartpulse.streaming.replay import run_available, stream_reader
    schema = "event_id long, mid string, uid string, evid string, itemid string, ts timestamp_ntz"
    out, n = [], 0
    for rows in batches:
        spark.createDataFrame([(n + i, *r) for i, r in enumerate(rows)], schema).write.mode("append").parquet(f"{work}/src")
        n += len(rows)
        alerts = AS.alert_stream(stream_reader(spark, f"{work}/src", spark.read.parquet(f"{work}/src").schema))
        run_available(AS.start_alert_stream(alerts, f"{work}/windows", f"{work}/docs", f"{work}/ckpt"))
        out.append({(r["window_start"], tuple(r["uids"])) for r in AS.read_alerts(spark, f"{work}/windows").collect()})
    return out


def test_newest_burst_alerts_at_once_and_a_late_click_takes_it_back(spark):
    """Five accounts within five seconds at the end of the log: the batch's windows, without later events."""
    import datetime as dt
    from cartpulse.operators import alerts as AL
    from cartpulse.streaming import alert_stream as AS
    t = dt.datetime(2024, 1, 1, 10, 0, 1)
    burst = [("m", u, "coupon", "i", t + dt.timedelta(seconds=k)) for k, u in enumerate("abcde")]
    click = [("m", "z", "clickItem", "i", t + dt.timedelta(seconds=2))]
    work = scratch_path(spark, "test_burst")
    after = _alert_run(spark, work, "burst", [burst[:2], burst[2:], click])
    schema = "event_id long, mid string, uid string, evid string, itemid string, ts timestamp_ntz"
    batch = lambda rows: {(r["window_start"], tuple(r["uids"])) for r in
                          AL.coupon_alerts(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)).collect()}
    assert after[0] == set() and after[1] == batch(burst) and len(after[1]) == 60
    assert after[2] == batch(burst + click)
    docs = AS.read_alert_docs(spark, f"{work}/docs").collect()
    assert {r["window_start"] for r in docs} <= {w for w, _ in after[2]}


def test_alert_tables_without_a_batch_read_as_empty(spark):
    from cartpulse.streaming import alert_stream as AS
    work = scratch_path(spark, "test_no_alerts")
    assert AS.read_alerts(spark, f"{work}/windows").count() == 0 and AS.read_alert_docs(spark, f"{work}/docs").count() == 0


def test_alert_docs_log_upserts_last_window(spark):
    import datetime as dt
    from cartpulse.streaming.alert_stream import alert_docs
    work = scratch_path(spark, "test_docs")
    schema = "mid string, window_start timestamp_ntz, window_end timestamp_ntz, uids array<string>, item_ids array<string>"
    t = dt.datetime(2024, 1, 1, 10, 0, 0)
    w = lambda s, e: ("m", t + dt.timedelta(seconds=s), t + dt.timedelta(seconds=e), ["a"], ["i"])
    SK.write_batch(alert_docs(spark.createDataFrame([w(0, 300), w(5, 305)], schema)), f"{work}/docs", 0)
    SK.write_batch(alert_docs(spark.createDataFrame([w(10, 310)], schema)), f"{work}/docs", 1)
    from cartpulse.streaming.alert_stream import read_alert_docs
    got = read_alert_docs(spark, f"{work}/docs").collect()
    assert len(got) == 1 and got[0]["ts"] == t + dt.timedelta(seconds=310)
    compacted = SK.compact_latest(spark, f"{work}/docs", "alert_id", "ts", f"{work}/docs_compact").collect()
    assert [r["ts"] for r in compacted] == [got[0]["ts"]]


def test_alert_state_is_one_row_a_device_and_chunk_and_is_freed(spark):
    import datetime as dt
    from cartpulse.streaming import alert_stream as AS
    from cartpulse.streaming.replay import run_available, stream_reader
    schema = "event_id long, mid string, uid string, evid string, itemid string, ts timestamp_ntz"
    work, t = scratch_path(spark, "test_alert_state"), dt.datetime(2024, 1, 1, 10, 0, 0)
    states, dropped = [], 0
    late = (99, "m", "late", "coupon", "i", t)
    for n, rows in enumerate([[(i, "m", f"u{i}", "coupon", "i", t + dt.timedelta(seconds=i)) for i in range(40)],
                              [(50, "x", "u", "coupon", "i", t + dt.timedelta(days=1))], [(52, "x", "u", "coupon", "i", t + dt.timedelta(days=1))], [late, (51, "x", "u", "coupon", "i", t + dt.timedelta(days=1))]]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{work}/src")
        q = AS.start_alert_stream(AS.alert_stream(stream_reader(spark, f"{work}/src", spark.read.parquet(f"{work}/src").schema)),
                                  f"{work}/windows", f"{work}/docs", f"{work}/ckpt")
        run_available(q)
        op = q.lastProgress["stateOperators"][0]
        states.append(op["numRowsTotal"])
        dropped += op["numRowsDroppedByWatermark"]
    alerts = {tuple(r["uids"]) for r in AS.read_alerts(spark, f"{work}/windows").collect()}
    assert dropped in (1, 2) and not any("late" in u for u in alerts)  # refused and counted, once per chunk it belongs to
    assert states[0] <= 8 and states[-1] <= 8  # device and chunk rows with their timers, not 60 windows a bucket; m's are freed


def test_seen_keys_first_wins_and_a_batch_reads_nothing_stored(spark):
    """The earlier batch's row stays, of one batch the smallest; a batch's input is its own files."""
    from cartpulse.functions.timeparts import with_date_hour
    from cartpulse.streaming.replay import run_available, stream_reader
    schema = "event_id long, mid string, uid string, type string, ts timestamp_ntz"
    work = scratch_path(spark, "test_seen")
    batches = [[(1, "m", "u", "s", "2024-01-02 08:00:05"), (0, "m", "u", "s", "2024-01-02 08:00:05"), (2, None, "u", "s", "2024-01-02 09:00:00")],
               [(3, "m", "u", "s", "2024-01-02 01:00:00"), (4, "m", "u", "s", "2024-01-01 23:00:00"), (5, "n", "u", "s", "2024-01-02 02:00:00")],
               [(6, None, "u", "s", "2024-01-02 00:00:00"), (7, "n", "u", "s", "2024-01-02 00:00:00")]]
    read = []
    for rows in batches:
        data = with_date_hour(spark.createDataFrame([(*r[:4], ts(r[4])) for r in rows], schema), "ts")
        data.write.mode("append").parquet(f"{work}/src")
        q = DS.start_dau_stream(stream_reader(spark, f"{work}/src", data.schema), f"{work}/rows", f"{work}/ckpt", counts_table=f"{work}/counts")
        run_available(q)
        read.append(q.lastProgress["numInputRows"])
    got = {(r["mid"], str(r["log_date"]), r["event_id"]) for r in SK.read_table(spark, f"{work}/rows").collect()}
    assert got == {("m", "2024-01-02", 0), (None, "2024-01-02", 2), ("m", "2024-01-01", 4), ("n", "2024-01-02", 5)}
    assert read == [3, 3, 2]
    assert sorted(r["n_after"] for r in SK.read_table(spark, f"{work}/counts").collect()) == [0, 2, 2]


def test_a_replayed_stream_batch_gives_the_same_rows(spark):
    """The newest commit is lost after its rows were written: the batch runs again and replaces them."""
    import glob
    import os
    from cartpulse.streaming.replay import run_available, stream_reader
    work = scratch_path(spark, "test_again").removeprefix("file:")
    data = startup_log(spark, SF_SMALL)
    cuts = [data.where(F.col("ts") < ts("2024-01-15 00:00:00")), data.where(F.col("ts") >= ts("2024-01-15 00:00:00"))]
    run = lambda: run_available(DS.start_dau_stream(stream_reader(spark, f"{work}/src", data.schema), f"{work}/rows", f"{work}/ckpt"))
    for part in cuts:
        part.write.mode("append").parquet(f"{work}/src")
        run()
    before = rows(SK.read_table(spark, f"{work}/rows"))
    newest = max(int(os.path.basename(p)) for p in glob.glob(f"{work}/ckpt/commits/[0-9]*"))
    for p in [*glob.glob(f"{work}/ckpt/commits/{newest}"), *glob.glob(f"{work}/ckpt/commits/.{newest}.crc")]:
        os.remove(p)
    run()
    assert rows(SK.read_table(spark, f"{work}/rows")) == before == rows(DAU.dau_rows(data))


def test_live_gmv_stream_and_watermark_dedup(spark):
    from cartpulse.streaming.gmv_stream import live_gmv_hours
    from cartpulse.sources.json_logs import parse_orders
    from cartpulse.streaming.replay import run_available
    work = scratch_path(spark, "test_live")
    spark.createDataFrame([('{"id":"1","total_amount":"5.00","create_time":"2024-01-01 10:05:00"}',),
                           ('{"id":"2","total_amount":"7.00","create_time":"2024-01-01 10:40:00"}',)],
                          "value string").write.text(f"{work}/src")
    q = (live_gmv_hours(parse_orders(spark.readStream.text(f"{work}/src"))).writeStream
         .outputMode("complete").format("memory").queryName("live_gmv_test")
         .option("checkpointLocation", f"{work}/ckpt").trigger(availableNow=True).start())
    run_available(q)
    assert [tuple(r) for r in spark.table("live_gmv_test").select("create_hour", "order_amount").collect()] == [("10", 12.0)]

    schema = "event_id long, mid string, uid string, type string, ts timestamp_ntz, log_date date, log_hour string"
    data = startup_log(spark, SF_SMALL)
    data.write.parquet(f"{work}/startup")
    q2 = (DS.dau_watermark_dedup(spark.readStream.schema(schema).parquet(f"{work}/startup"), "40 days")
          .writeStream.format("memory").queryName("wm_dedup_test").option("checkpointLocation", f"{work}/ckpt2")
          .trigger(availableNow=True).start())
    run_available(q2)
    got = spark.table("wm_dedup_test")
    assert got.count() == DAU.dau_rows(data).count()
    assert got.groupBy("mid", "log_date").count().where("count > 1").count() == 0


def test_metric_selector(spark):
    import pytest
    from cartpulse.plans.dashboard import realtime_hours_for
    e = spark.createDataFrame([], "log_date date, log_hour string, dau long")
    with pytest.raises(ValueError):
        realtime_hours_for("visits", e, e)


def test_publisher_serves_one_day_from_stream_tables(spark):
    import datetime as dt
    from cartpulse.plans.publisher import Publisher
    from cartpulse.streaming import gmv_stream as GS
    from cartpulse.streaming.replay import replay, stream_reader
    from cartpulse.sources import tables as TB
    from cartpulse.operators import gmv as GMV
    from cartpulse.plans import dashboard as DASH
    work = scratch_path(spark, "test_pub")
    startup = startup_log(spark, SF_SMALL)
    orders = TB.hourly_orders(spark, SF_SMALL)
    msgs = orders.select(F.to_json(F.struct("id", "user_id", "total_amount", "create_time")).alias("value"),
                         F.to_timestamp_ntz("create_time").alias("ts"))

    def start_dau():
        return DS.start_dau_stream(stream_reader(spark, f"{work}/s_src", startup.schema), f"{work}/rows",
                                   f"{work}/ck1")

    def start_gmv():
        return GS.start_order_stream(spark.readStream.text(f"{work}/o_src"), f"{work}/orders", f"{work}/ck2")

    replay([(startup, "ts", f"{work}/s_src", "parquet")], 2, start_dau)
    replay([(msgs, "ts", f"{work}/o_src", "text")], 2, start_gmv)
    pub = Publisher(spark, f"{work}/rows", f"{work}/orders")
    day = "2024-01-15"
    served = {r["id"]: r["value"] for r in pub.realtime_total(day).collect()}
    dau = DAU.dau_rows(startup)
    batch = {r["id"]: r["value"] for r in DASH.realtime_total(
        DAU.dau_total(dau), DAU.new_devices(dau), GMV.gmv_total(GMV.order_facts(orders)), day).collect()}
    assert served == batch
    hours = pub.realtime_hours("order_amount", day).collect()
    want = DASH.realtime_hours(GMV.gmv_hours(GMV.order_facts(orders)), "create_date", "create_hour",
                               "order_amount", day, zero=0.0).collect()
    assert sorted(map(tuple, hours)) == sorted(map(tuple, want)) and len(hours) == 24
    assert str(pub.realtime_hours("dau", day).first()["day"]) == day
    # the SQL lookups agree with the DataFrame path and read only the day's folders
    assert pub.sql("dau_total", day).first()["dau"] == served["dau"]
    assert pub.sql("gmv_total", day).first()["order_amount"] == served["order_amount"]
    sql_hours = {r["create_hour"]: r["order_amount"] for r in pub.sql("gmv_hours", day).collect()}
    assert sql_hours == {r["hour"]: r["today"] for r in hours if r["today"] != 0.0}
    assert sum(r["dau"] for r in pub.sql("dau_hours", day).collect()) == served["dau"]
    plan = pub.sql("dau_hours", day)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_date" in plan


def test_malformed_message_is_kept_and_stream_goes_on(spark):
    from cartpulse.streaming import gmv_stream as GS
    from cartpulse.streaming.replay import run_available
    from cartpulse.operators import gmv as GMV
    work = scratch_path(spark, "test_bad_json")
    src = f"{work}/src"
    undated = '{"id":"9","total_amount":"1.00"}'
    first = ['{"id":"1","total_amount":"5.00","create_time":"2024-01-01 10:05:00"}', "{bad", undated, undated]
    second = ['{"id":"2","total_amount":"7.00","create_time":"2024-01-01 10:40:00"}',
              '{"id":"1","total_amount":"5.00","create_time":"2024-01-01 10:05:00"}', undated]  # re-sent copies
    for lines in (first, second):
        spark.createDataFrame([(v,) for v in lines], "value string").write.mode("append").text(src)
        run_available(GS.start_order_stream(spark.readStream.text(src), f"{work}/orders", f"{work}/ckpt"))
    stored = SK.read_table(spark, f"{work}/orders")
    assert stored.where(F.col("_corrupt_record").isNotNull()).count() == 1
    assert stored.where(F.col("_corrupt_record").isNull()).count() == 3  # ids 1, 2, 9 once each
    assert GMV.undated_orders(GS.read_orders(spark, f"{work}/orders")).first()["undated"] == 1
    sums = GMV.gmv_hours(GS.read_orders(spark, f"{work}/orders")).collect()
    assert [(r["create_hour"], r["order_amount"]) for r in sums] == [("10", 12.0)]


def test_console_sink_runs(spark):
    from cartpulse.streaming.replay import run_available
    work = scratch_path(spark, "test_console")
    spark.range(3).write.parquet(f"{work}/src")
    q = (SK.console_sink(spark.readStream.schema("id long").parquet(f"{work}/src"), 100)
         .option("checkpointLocation", f"{work}/ckpt").trigger(availableNow=True).start())
    run_available(q)
    assert q.lastProgress["numInputRows"] == 3


def test_processing_time_trigger(spark):
    """The real-time mode: a 1-second processing-time trigger over arriving files."""
    import time
    from cartpulse.streaming.sinks import read_table
    work = scratch_path(spark, "test_trigger")
    data = startup_log(spark, SF_SMALL)
    data.write.parquet(f"{work}/src")
    q = DS.start_dau_stream(spark.readStream.schema(data.schema).parquet(f"{work}/src"), f"{work}/rows",
                            f"{work}/ckpt", trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        first = read_table(spark, f"{work}/rows").count()
        data.write.mode("append").parquet(f"{work}/src")  # the same records arrive again
        q.processAllAvailable()
        time.sleep(1.5)
        q.processAllAvailable()
    finally:
        q.stop()
    assert first == DAU.dau_rows(data).count() == read_table(spark, f"{work}/rows").count()


def test_orders_without_id_are_all_kept(spark):
    from cartpulse.operators import gmv as GMV
    from cartpulse.streaming import gmv_stream as GS
    from cartpulse.streaming.replay import run_available
    work = scratch_path(spark, "test_no_id")
    lines = ['{"total_amount":"5.00","create_time":"2024-01-01 10:05:00"}', '{"total_amount":"7.00","create_time":"2024-01-01 10:40:00"}']
    for value in lines:
        spark.createDataFrame([(value,)], "value string").write.mode("append").text(f"{work}/src")
        run_available(GS.start_order_stream(spark.readStream.text(f"{work}/src"), f"{work}/orders", f"{work}/ckpt"))
    sums = GMV.gmv_hours(GS.read_orders(spark, f"{work}/orders")).collect()
    assert [(r["create_hour"], r["order_amount"]) for r in sums] == [("10", 12.0)]


def test_storage_checks_ask_the_paths_own_file_system(spark):
    """A path without scheme belongs to the default file system, here one that only Hadoop's API can open."""
    work = scratch_path(spark, "test_default_fs").removeprefix("file:")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    old = conf.get("fs.defaultFS")
    spark.range(2).selectExpr("id", "current_date() as d").write.partitionBy("d").parquet(f"file:{work}/t")
    conf.set("fs.viewfs.mounttable.cartpulse.link./shared", f"file:{work}")
    conf.set("fs.defaultFS", "viewfs://cartpulse/")
    try:
        assert SK.table_exists(spark, "/shared/t") and SK.path_exists(spark, "/shared/t") and not SK.table_exists(spark, "/shared/none")
        assert SK.read_table(spark, "/shared/t").count() == 2
    finally:
        conf.set("fs.defaultFS", old)


def test_lines_without_an_order_in_time_are_kept_and_come_back(spark):
    """A late order is refused by the join; its lines are dead letters until the repair, each once; orphans stay."""
    import datetime as dt
    from cartpulse.streaming import sale_stream as SS
    from cartpulse.streaming.replay import run_available, stream_reader
    work = scratch_path(spark, "test_dead")
    order_schema, line_schema = "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz", \
        "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, create_time timestamp_ntz"
    day = lambda i: dt.datetime(2024, 1, i)
    line = lambda o, n, i: (o, n, 7, 1.0, 2.0, day(i))
    steps = [([(1, 10, day(1))], [line(1, 1, 1), line(2, 1, 1), line(2, 1, 1), line(9, 1, 1)]),
             ([(3, 30, day(20))], [line(3, 1, 20)]),
             ([(2, 20, day(1)), (4, 40, day(21))], [line(4, 1, 21)])]
    dead = []
    for orders, lines in steps:
        spark.createDataFrame(orders, order_schema).write.mode("append").parquet(f"{work}/o")
        spark.createDataFrame(lines, line_schema).write.mode("append").parquet(f"{work}/l")
        run_available(SS.start_sale_stream(stream_reader(spark, f"{work}/o", order_schema), stream_reader(spark, f"{work}/l", line_schema),
                                           f"{work}/matched", f"{work}/dead", f"{work}/ckpt"))
        letters = SS.read_dead_letters(spark, f"{work}/dead")
        dead.append(sorted(r["l_orderkey"] for r in letters.collect()))
    assert dead[0] == [] and dead[1] == dead[2] == [2, 2, 9]
    landed = spark.read.parquet(f"{work}/o")
    assert SS.rejoin_dead_letters(spark, f"{work}/dead", landed, 0) == 2
    assert SS.rejoin_dead_letters(spark, f"{work}/dead", landed, 1) == 0  # nothing is found twice
    assert [r["l_orderkey"] for r in SS.read_dead_letters(spark, f"{work}/dead").collect()] == [9]
    got = sorted((r["l_orderkey"], r["o_custkey"]) for r in SS.read_sale_lines(spark, f"{work}/matched", f"{work}/dead").collect())
    assert got == [(1, 10), (2, 20), (2, 20), (3, 30), (4, 40)]

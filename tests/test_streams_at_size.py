"""What streams keep and write must not grow faster than their input."""

import datetime as dt
import glob

from cartpulse.operators import cdc as CDC
from cartpulse.session import scratch_path
from cartpulse.streaming import alert_stream as AS
from cartpulse.streaming import cdc_stream as CS
from cartpulse.streaming import replay as RP
from cartpulse.streaming import sale_stream as SS
from cartpulse.streaming import sinks as SK

ORDERS = "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"
LINES = "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, create_time timestamp_ntz"
day = lambda i, h=0: dt.datetime(2024, 1, i, h)
line = lambda o, n, i, h=0: (o, n, 7, 1.0, 2.0, day(i, h))


def _land(spark, work, orders, lines):
    spark.createDataFrame(orders, ORDERS).write.mode("append").parquet(f"{work}/o")
    spark.createDataFrame(lines, LINES).write.mode("append").parquet(f"{work}/l")
    return RP.stream_reader(spark, f"{work}/o", ORDERS), RP.stream_reader(spark, f"{work}/l", LINES)


def test_sale_join_keeps_open_rows_only(spark):
    """Pairs over three batches come once, repeated keys included; what the watermark has passed is not kept."""
    work = scratch_path(spark, "test_open")
    steps = [([(1, 10, day(9))], [line(1, 1, 10), line(2, 1, 9, 12), line(3, 1, 1), line(None, 1, 10)]),
             ([(1, 11, day(9, 12)), (2, 20, day(9, 6)), (3, 30, day(1))], [line(1, 2, 9, 18)]),
             ([(4, 40, day(20)), (None, 50, day(20))], [line(4, 1, 20), line(None, 2, 20)])]
    for orders, lines in steps:
        q = SS.start_sale_stream(*_land(spark, work, orders, lines), f"{work}/matched", f"{work}/dead", f"{work}/ckpt")
        RP.run_available(q)
        assert q.lastProgress["stateOperators"] == []  # no state store call a row
    got = sorted((r["l_orderkey"], r["l_linenumber"], r["o_custkey"]) for r in SK.read_table(spark, f"{work}/matched").collect())
    assert got == [(1, 1, 10), (1, 1, 11), (1, 2, 10), (1, 2, 11), (2, 1, 20), (4, 1, 40)]
    dead = [(r["l_orderkey"], r["l_linenumber"]) for r in SK.read_table(spark, f"{work}/dead").collect()]
    assert sorted(dead, key=str) == [(3, 1), (None, 1)]  # order 3 was refused: it came behind the watermark
    last = [spark.read.parquet(f"{work}/ckpt_open/{t}/batch_id=2") for t in ("lines", "orders")]
    assert sorted((r["l_orderkey"] for r in last[0].collect()), key=str) == [4, None] and sorted((r["o_orderkey"] for r in last[1].collect()), key=str) == [4, None]
    assert not SK.path_exists(spark, f"{work}/ckpt_open/lines/batch_id=0")


def test_a_sale_batch_that_runs_again_gives_the_same(spark):
    import os
    work = scratch_path(spark, "test_sale_again").removeprefix("file:")
    read = lambda t: sorted(map(str, SK.read_table(spark, f"{work}/{t}").collect()))
    for orders, lines in (([(1, 10, day(9))], [line(1, 1, 9), line(2, 1, 9)]), ([(2, 20, day(9)), (3, 30, day(20))], [line(3, 1, 20)])):
        sources = _land(spark, work, orders, lines)
        RP.run_available(SS.start_sale_stream(*sources, f"{work}/matched", f"{work}/dead", f"{work}/ckpt"))
    before = read("matched"), read("dead")
    for f in (f"{work}/ckpt/commits/1", f"{work}/ckpt/commits/.1.crc"):
        os.remove(f)
    RP.run_available(SS.start_sale_stream(*sources, f"{work}/matched", f"{work}/dead", f"{work}/ckpt"))
    assert (read("matched"), read("dead")) == before and len(before[0]) == 3


def test_sale_detail_stream_joins_without_state_stores(spark):
    work = scratch_path(spark, "test_detail")
    customer = spark.createDataFrame([(10, 1, "BUILDING")], "c_custkey long, c_nationkey long, c_mktsegment string")
    part = spark.createDataFrame([(7, "ring", "b", 3, 1.5)], "p_partkey long, p_name string, p_brand string, p_size int, p_retailprice double")
    nation = spark.createDataFrame([(1, "CHINA")], "n_nationkey long, n_name string")
    for orders, lines in (([], [line(1, 1, 9), line(5, 1, 9)]), ([(1, 10, day(9)), (2, 99, day(9))], [line(2, 1, 9)])):
        q = SS.start_sale_detail_stream(*_land(spark, work, orders, lines), customer, part, nation, f"{work}/out", f"{work}/ckpt")
        RP.run_available(q)
        assert q.lastProgress["stateOperators"] == []
    got = sorted((r["order_detail_id"], r["user_segment"], r["sku_name"], r["province"]) for r in SK.read_table(spark, f"{work}/out").collect())
    assert got == [("1-1", "BUILDING", "ring", "CHINA"), ("2-1", None, "ring", None)]


def test_alert_state_rows_do_not_grow_with_the_devices(spark):
    from cartpulse.operators import alerts as AL
    work, t = scratch_path(spark, "test_groups"), dt.datetime(2024, 1, 1, 10, 0, 0)
    schema = "event_id long, mid string, uid string, evid string, itemid string, ts timestamp_ntz"
    rows = [(4 * d + i, f"m{d}", f"u{i}", "clickItem" if d % 9 == i == 3 else "coupon", "i", t + dt.timedelta(seconds=20 * i + d % 7))
            for d in range(300) for i in range(4)]
    for part in (rows[::2], rows[1:600:2], rows[601::2]):  # the second batch has no row of half the devices
        spark.createDataFrame(part, schema).write.mode("append").parquet(f"{work}/src")
        q = AS.start_alert_stream(AS.alert_stream(RP.stream_reader(spark, f"{work}/src", schema), every_event=True, groups=4),
                                  f"{work}/windows", f"{work}/docs", f"{work}/ckpt")
        RP.run_available(q)
        assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 24  # groups, chunks and their timers, not 300 devices
    cols = ["alert_id", "mid", "uids", "item_ids", "events", "ts", "window_start"]
    got = AS.read_alert_docs(spark, f"{work}/docs").select(*cols).collect()
    want = AL.event_documents(spark.createDataFrame(rows, schema)).select(*cols).collect()
    assert len(want) > 300 and sorted(map(str, got)) == sorted(map(str, want))


def test_change_log_files_are_packed(spark):
    """Staged slices and messages are compressed, and a slice's rows are written as they come."""
    work = scratch_path(spark, "test_packed").removeprefix("file:")
    orders = spark.createDataFrame([(i, i % 3, "F" if i % 2 else "P", 1.5, day(1 + i % 20)) for i in range(200)],
                                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz")
    lines = spark.createDataFrame([(1, 2, 3.0, day(2))], "l_orderkey long, l_partkey long, l_quantity double, l_shipdate timestamp_ntz")
    changes = CDC.change_log_from_tables(orders, lines)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")

    def start():
        return CS.start_cdc_stream(RP.stream_reader(spark, f"{work}/src", changes.schema), f"{work}/out", f"{work}/ckpt", database="shop", compression="gzip")

    RP.replay([(changes, "ts", f"{work}/src", "parquet")], 4, start)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    staged, out = glob.glob(f"{work}/src/*.parquet"), glob.glob(f"{work}/out/part-*")
    assert staged and all(f.endswith(".zstd.parquet") for f in staged)
    assert out and all(f.endswith(".txt.gz") for f in out)
    want = CDC.row_inserts(changes, database="shop")
    assert sorted(r[0] for r in spark.read.text(f"{work}/out").collect()) == sorted(r[0] for r in want.collect())

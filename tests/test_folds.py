"""Folding under readers, keyed snapshots, first days: one version seen whole, bounded folders, nothing lost or doubled."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartpulse.session import scratch_path
from cartpulse.streaming import alert_stream as AS
from cartpulse.streaming import first_days as FD
from cartpulse.streaming import folds as FO
from cartpulse.streaming import sinks as SK
from cartpulse.streaming.replay import run_available, stream_reader

SCHEMA = "log_date date, log_hour string, dau bigint"
SUMS = FO.added_up(["log_date", "log_hour"], dau="bigint")
DAYS = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None]


def hours(spark, n):
    return spark.createDataFrame([(DAYS[n % 3], "08", n + 1), (DAYS[(n + 1) % 3], f"{n % 24:02}", 10)], SCHEMA)


def totals(df):
    return {(r["log_date"], r["log_hour"]): r["n"] for r in df.groupBy("log_date", "log_hour").agg(F.sum("dau").alias("n")).collect()}


def expected(n):
    want = {}
    for b in range(n):
        for d, h, v in ((DAYS[b % 3], "08", b + 1), (DAYS[(b + 1) % 3], f"{b % 24:02}", 10)):
            want[d, h] = want.get((d, h), 0) + v
    return want


def folders(spark, table):
    content = FO.manifest(spark, table)[1]
    return [sum(map(len, FO._visible(spark, table, "log_date", content, [d]))) for d in FO._dates(spark, table, "log_date", content)]


def test_folds_keep_every_batch_once_and_bound_the_folders(spark):
    table, most = scratch_path(spark, "test_folds"), 0
    assert FO.fold(spark, table, "log_date") == 0 and FO.read_folded(spark, table, "log_date") is None
    for n in range(26):
        SK.write_dated_batch(hours(spark, n), table, n, "log_date")
        if n % 3 == 2:
            reader = FO.read_folded(spark, table, "log_date")  # this reader planned before the fold ...
            FO.fold(spark, table, "log_date", SUMS, fan=3)
            assert totals(reader) == expected(n + 1)           # ... and reads after it
            FO.vacuum(spark, table, "log_date", 2)
            assert totals(FO.read_folded(spark, table, "log_date")) == expected(n + 1)
            most = max([most, *folders(spark, table)])
    assert most <= 8 and max(x["level"] for xs in FO.manifest(spark, table)[1]["folds"].values() for x in xs) >= 2
    assert len(FO._batches(spark, table, "2024-01-01", "log_date")) < 17  # folded batches are removed
    one = FO.read_folded(spark, table, "log_date", [DAYS[0]])
    assert totals(one) == {k: v for k, v in expected(26).items() if k[0] == DAYS[0]}
    none = FO.read_folded(spark, table, "log_date", [None])
    assert totals(none) == {k: v for k, v in expected(26).items() if k[0] is None}
    # the newest batch is never folded: a replay may write it again
    SK.write_dated_batch(hours(spark, 25), table, 25, "log_date")
    assert totals(FO.read_folded(spark, table, "log_date")) == expected(26)


def test_two_folds_cannot_publish_one_version(spark):
    table = scratch_path(spark, "test_race")
    FO.publish(spark, table, 1, {"folds": {}})
    with pytest.raises(FileExistsError):
        FO.publish(spark, table, 1, {"folds": {"x": []}})
    assert FO.manifest(spark, table) == (1, {"folds": {}}) and FO._children(spark, f"{table}/{FO.MANIFESTS}") and not [
        n for n in FO._children(spark, f"{table}/{FO.MANIFESTS}") if n.startswith(".") and not n.endswith(".crc")]


def test_a_fold_keeps_the_earliest_of_repeated_keys(spark):
    table = scratch_path(spark, "test_first")
    mk = lambda rows: spark.createDataFrame(rows, "mid string, log_date date, event_id bigint")
    for n, rows in enumerate([[("a", DAYS[0], 9)], [("a", DAYS[0], 1), ("b", DAYS[0], 2)], [("b", DAYS[0], 1), ("c", DAYS[0], 3)], [("d", DAYS[0], 4)]]):
        SK.write_dated_batch(mk(rows), table, n, "log_date")
    FO.fold(spark, table, "log_date", FO.first_rows(["mid", "log_date"], ["event_id"]), fan=3)
    got = {(r["mid"], r["event_id"]) for r in FO.read_folded(spark, table, "log_date").collect()}
    assert got == {("a", 9), ("b", 2), ("c", 3), ("d", 4)}


def test_document_snapshot_rewrites_touched_buckets_only(spark):
    table = scratch_path(spark, "test_docs_fold")
    t = dt.datetime(2024, 1, 1, 10)
    doc = lambda i, v, gone=False: (f"m{i}:1", f"m{i}", [f"u{v}"], ["i"], [], t + dt.timedelta(seconds=v), t, gone)
    schema = AS.DOC_SCHEMA.removesuffix(", batch_id long")
    put = lambda n, docs: SK.write_batch(spark.createDataFrame(docs, schema), table, n)
    now = lambda **o: {(r["alert_id"], r["uids"][0]) for r in AS.read_alert_docs(spark, table, **o).collect()}
    assert AS.fold_alert_docs(spark, table, 8) == 0 and now() == set()
    put(0, [doc(i, 0) for i in range(40)])
    AS.fold_alert_docs(spark, table, 8)
    before = FO.manifest(spark, table)[1]["buckets"]
    put(1, [doc(3, 5), doc(4, 7, True), doc(99, 1), doc(3, 6)])  # in one batch the newest window wins
    want = {(f"m{i}:1", "u0") for i in range(40) if i not in (3, 4)} | {("m3:1", "u6"), ("m99:1", "u1")}
    assert now() == want and now(only=["m3:1", "m4:1", "m5:1"]) == {("m3:1", "u6"), ("m5:1", "u0")}
    AS.fold_alert_docs(spark, table, 8)
    after = FO.manifest(spark, table)[1]["buckets"]
    assert now() == want and 0 < sum(before.get(b) != after.get(b) for b in range(0, 8) for b in [str(b)]) <= 3
    put(2, [doc(4, 9), doc(5, 2, True)])
    assert now() == want - {("m5:1", "u0")} | {("m4:1", "u9")}
    put(3, [])
    AS.fold_alert_docs(spark, table, 8)
    assert now() == want - {("m5:1", "u0")} | {("m4:1", "u9")}


def test_first_days_move_when_an_earlier_day_comes_late(spark):
    work = scratch_path(spark, "test_first_days")
    d = [dt.date(2024, 1, i) for i in range(1, 6)]
    for rows in ([("a", d[2]), ("b", d[2]), ("b", d[3])], [("a", d[3]), ("c", d[3]), (None, d[4])], [("a", d[0]), ("c", d[3]), ("a", None)]):
        spark.createDataFrame(rows, "mid string, log_date date").write.mode("append").parquet(f"{work}/src")
        run_available(FD.start_new_device_stream(stream_reader(spark, f"{work}/src", "mid string, log_date date"), f"{work}/new", f"{work}/ckpt"))
    got = {r["log_date"]: r["new_mid"] for r in FD.read_new_devices(spark, f"{work}/new").collect()}
    assert got == {d[0]: 1, d[2]: 1, d[3]: 1, d[4]: 1}
    assert [tuple(r) for r in FD.read_new_devices(spark, f"{work}/new", [d[2]]).collect()] == [(d[2], 1)]
    assert FD.read_new_devices(spark, f"{work}/none").collect() == []

"""Daily active devices: in-batch dedup, cross-batch filter, rollups (hand fixtures)."""

from pyspark.sql import functions as F

from cartpulse.functions.timeparts import with_date_hour
from cartpulse.operators import dau as DAU
from cartpulse.operators.dedup import filter_seen, filter_seen_by_batch
from conftest import ts

SCHEMA = "event_id long, mid string, uid string, type string, ts timestamp_ntz"


def startup(spark, rows):
    return with_date_hour(spark.createDataFrame(rows, SCHEMA), "ts")


def test_same_device_twice_keeps_smallest_ts(spark):
    df = startup(spark, [(1, "m1", "u", "s", ts("2024-01-01 10:00:02")), (2, "m1", "u", "s", ts("2024-01-01 10:00:01"))])
    rows = DAU.dau_rows(df).collect()
    assert len(rows) == 1 and rows[0]["event_id"] == 2


def test_equal_ts_breaks_tie_by_lower_id(spark):
    t = ts("2024-01-01 10:00:00")
    df = startup(spark, [(7, "m1", "u", "s", t), (3, "m1", "u", "s", t)])
    assert [r["event_id"] for r in DAU.dau_rows(df).collect()] == [3]


def test_device_across_midnight_gives_one_row_per_date(spark):
    df = startup(spark, [(1, "m1", "u", "s", ts("2024-01-01 23:59:59")), (2, "m1", "u", "s", ts("2024-01-02 00:00:01"))])
    rows = sorted((str(r["log_date"]), r["log_hour"]) for r in DAU.dau_rows(df).collect())
    assert rows == [("2024-01-01", "23"), ("2024-01-02", "00")]


def test_cross_batch_keeps_first_batch_row_only(spark):
    # same device and date in hour-batches 10 and 11: only batch 10's row survives
    df = startup(spark, [(1, "m1", "u", "s", ts("2024-01-01 10:30:00")), (2, "m1", "u", "s", ts("2024-01-01 11:10:00")),
                         (3, "m2", "u", "s", ts("2024-01-01 11:20:00"))])
    kept = {(r["mid"], r["event_id"]) for r in DAU.dau_cross_batch(df, 3_600_000).collect()}
    assert kept == {("m1", 1), ("m2", 3)}


def test_filter_seen_variants_agree(spark):
    batch = startup(spark, [(1, "a", "u", "s", ts("2024-01-02 01:00:00")), (2, "b", "u", "s", ts("2024-01-02 01:00:00")),
                            (3, "c", "u", "s", ts("2024-01-01 23:00:00"))])
    seen = startup(spark, [(9, "a", "u", "s", ts("2024-01-02 00:00:00")), (8, "c", "u", "s", ts("2024-01-02 00:00:00"))])
    keys = ["mid", "log_date"]
    a = {r["event_id"] for r in filter_seen(batch, seen, keys).collect()}
    b = {r["event_id"] for r in filter_seen_by_batch(batch, seen, keys).collect()}
    # "c" was seen on the 2nd only: its late row of the 1st is kept (keyed by the row's own date)
    assert a == b == {2, 3}


def test_hour_sums_add_up_to_daily_totals(spark):
    from cartpulse.sources.tables import startup_log
    from conftest import SF_SMALL
    dau = DAU.dau_rows(startup_log(spark, SF_SMALL))
    per_day = {r["log_date"]: r["dau"] for r in DAU.dau_total(dau).collect()}
    hours = DAU.dau_hours(dau).groupBy("log_date").agg(F.sum("dau").alias("s")).collect()
    assert {r["log_date"]: r["s"] for r in hours} == per_day
    assert dau.groupBy("mid", "log_date").count().where("count > 1").count() == 0


def test_new_devices_counts_first_day_only(spark):
    df = startup(spark, [(1, "a", "u", "s", ts("2024-01-01 01:00:00")), (2, "a", "u", "s", ts("2024-01-02 01:00:00")),
                         (3, "b", "u", "s", ts("2024-01-02 02:00:00"))])
    got = {str(r["log_date"]): r["new_mid"] for r in DAU.new_devices(DAU.dau_rows(df)).collect()}
    assert got == {"2024-01-01": 1, "2024-01-02": 1}


def test_dedup_counts_per_batch(spark):
    df = startup(spark, [(1, "a", "u", "s", ts("2024-01-01 10:00:00")), (2, "a", "u", "s", ts("2024-01-01 10:10:00")),
                         (3, "a", "u", "s", ts("2024-01-01 11:00:00"))])
    got = {r["batch_id"] % 24: (r["n_before"], r["n_after"]) for r in DAU.dedup_counts(df, 3_600_000).collect()}
    assert got == {10: (2, 1), 11: (1, 0)}


def test_one_pass_dau_and_new_devices_equal_separate_rollups(spark):
    from cartpulse.sources.tables import startup_log
    from conftest import SF_SMALL
    dau = DAU.dau_rows(startup_log(spark, SF_SMALL))
    both = {r["log_date"]: (r["dau"], r["new_mid"]) for r in DAU.dau_and_new_devices(dau).collect()}
    totals = {r["log_date"]: r["dau"] for r in DAU.dau_total(dau).collect()}
    new = {r["log_date"]: r["new_mid"] for r in DAU.new_devices(dau).collect()}
    assert both == {d: (n, new.get(d, 0)) for d, n in totals.items()}

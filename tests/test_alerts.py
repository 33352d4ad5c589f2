"""Coupon alerts: the decision rule, window edges and one document per device-minute."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartpulse.operators import alerts as AL
from conftest import ts

SCHEMA = "event_id long, mid string, uid string, evid string, itemid string, ts timestamp_ntz"


def events(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)


def coupons(uids, start="2024-01-01 10:00:01", step=1):
    t0 = ts(start)
    return [("m", u, "coupon", f"i{k}", t0 + dt.timedelta(seconds=k * step)) for k, u in enumerate(uids)]


def test_three_accounts_no_click_alerts(spark):
    a = AL.coupon_alerts(events(spark, coupons(["a", "b", "c"])))
    rows = a.collect()
    assert rows and all(r["uids"] == ["a", "b", "c"] for r in rows)
    docs = AL.alert_documents(a).collect()
    assert len({d["alert_id"] for d in docs}) == len(docs)  # one document per device and minute


def test_two_accounts_three_coupons_no_alert(spark):
    assert AL.coupon_alerts(events(spark, coupons(["a", "b", "a"]))).count() == 0


def test_click_first_or_last_suppresses(spark):
    base = coupons(["a", "b", "c"])
    first = [("m", "x", "clickItem", "i9", ts("2024-01-01 10:00:00"))] + base
    last = base + [("m", "x", "clickItem", "i9", ts("2024-01-01 10:00:04"))]
    assert AL.coupon_alerts(events(spark, first)).count() == 0
    assert AL.coupon_alerts(events(spark, last)).count() == 0


def test_null_account_is_not_counted(spark):
    assert AL.coupon_alerts(events(spark, coupons(["a", "b", None]))).count() == 0


def test_window_end_is_open(spark):
    # a, b at t and c at t + 300 s are never in one 5-minute window
    rows = coupons(["a", "b"], step=0) + [("m", "c", "coupon", "i", ts("2024-01-01 10:05:01"))]
    assert AL.coupon_alerts(events(spark, rows)).count() == 0


def test_last_window_in_a_minute_wins(spark):
    a = AL.coupon_alerts(events(spark, coupons(["a", "b", "c"])))
    docs = AL.alert_documents(a).collect()
    per_window = a.collect()
    for d in docs:
        same_min = [w["window_end"] for w in per_window
                    if int((w["window_end"] - dt.datetime(1970, 1, 1)).total_seconds() * 1000) // 60000
                    == int(d["alert_id"].split(":")[1])]
        assert d["ts"] == max(same_min)


def test_grid_handles_size_not_multiple_of_slide(spark):
    # 7-second windows every 5 seconds (buckets of gcd = 1 second); coupons at :05, :06, :07
    rows = coupons(["a", "b", "c"], start="2024-01-01 10:00:05", step=1)
    got = {(r["window_start"].second, r["window_end"].second)
           for r in AL.coupon_alerts(events(spark, rows), "7 seconds", "5 seconds").collect()}
    brute = {(k * 5, k * 5 + 7) for k in range(3) if all(k * 5 <= t < k * 5 + 7 for t in (5, 6, 7))}
    assert got == brute == {(5, 12)}


def test_interval_parsing():
    assert AL.interval_us("5 minutes") == 300_000_000 and AL.interval_us("1 hour") == 3_600_000_000
    assert AL.interval_us("5 seconds") == 5_000_000


def test_events_list_is_time_ordered_and_complete(spark):
    rows = coupons(["a", "b", "c"]) + [("m", "a", "pageView", None, ts("2024-01-01 10:00:02.5"))]
    ev = events(spark, rows)
    a = AL.coupon_alerts(ev, "1 minute", "1 minute")
    got = AL.alert_events(ev, a, "1 minute", "1 minute").collect()
    assert [r["events"] for r in got] == [["coupon", "coupon", "pageView", "coupon"]]


def test_prefiltered_plan_equals_direct_window_rule(spark):
    """Brute force: evaluate every window directly from the raw events and compare."""
    from cartpulse.sources.tables import event_log
    from conftest import SF_SMALL
    ev = event_log(spark, SF_SMALL)
    got = {(r["mid"], r["window_start"]) for r in AL.coupon_alerts(ev, "6 hours", "1 hour").collect()}
    rows = ev.collect()
    hour = dt.timedelta(hours=1)
    want = set()
    by_window = {}
    for r in rows:
        start = r["ts"].replace(minute=0, second=0, microsecond=0)
        for k in range(6):
            by_window.setdefault((r["mid"], start - k * hour), []).append(r)
    for key, rs in by_window.items():
        uids = {r["uid"] for r in rs if r["evid"] == "coupon" and r["uid"] is not None}
        if len(uids) >= 3 and not any(r["evid"] == "clickItem" for r in rs):
            want.add(key)
    assert got == want


def every_window(ev, window, slide):
    """Brute force: every event copied to all its windows, exact sets per window, the rule."""
    from pyspark.sql import functions as F
    from cartpulse.functions.timeparts import EPOCH_NTZ, floor_div, lit_long, ntz_to_epoch_us
    size, step = AL.interval_us(window), AL.interval_us(slide)
    us = ntz_to_epoch_us("ts")
    coupon = F.col("evid") == "coupon"
    k = F.explode(F.sequence(floor_div(us - lit_long(size), step) + 1, floor_div(us, step)))
    inside = (F.col("k") * lit_long(step) <= us) & (us < F.col("k") * lit_long(step) + lit_long(size))  # (sequence runs backwards where no window holds the event)
    found = (ev.withColumn("k", k).where(inside).groupBy("mid", "k")
             .agg(F.array_sort(F.collect_set(F.when(coupon, F.col("uid")))).alias("uids"), F.array_sort(F.collect_set(F.when(coupon, F.col("itemid")))).alias("items"),
                  F.max(F.col("evid") == "clickItem").alias("clicked"),
                  F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", "evid"))), lambda x: x["evid"]).alias("events"))
             .where((F.size("uids") >= 3) & ~F.col("clicked")))
    at = lambda x: F.timestamp_add("MICROSECOND", x, EPOCH_NTZ())
    start = F.col("k") * lit_long(step)
    return found.select("mid", at(start).alias("window_start"), at(start + lit_long(size)).alias("window_end"), "uids", "items", "events")


def texts(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("window,slide,chunks", [("6 hours", "1 hour", 12), ("5 minutes", "5 seconds", 12), ("5 minutes", "5 seconds", 1),
                                                 ("7 seconds", "5 seconds", 2), ("2 minutes", "3 minutes", 1)])
def test_sweep_equals_every_window(spark, window, slide, chunks):
    from cartpulse.sources.tables import event_log
    from conftest import SF_SMALL
    ev = event_log(spark, SF_SMALL)
    want = texts(every_window(ev, window, slide))
    assert texts(AL.coupon_alerts(ev, window, slide, with_events=True, chunk_windows=chunks)) == want
    assert texts(AL.coupon_alerts(ev, window, slide, chunk_windows=chunks)) == texts(every_window(ev, window, slide).drop("events"))
    assert want or window in ("7 seconds", "2 minutes")


def test_documents_are_the_newest_windows(spark):
    from cartpulse.sources.tables import event_log
    from conftest import SF_SMALL
    ev = event_log(spark, SF_SMALL)
    for window, slide, ms in (("5 minutes", "5 seconds", 60_000), ("6 hours", "1 hour", 86_400_000), ("5 minutes", "5 seconds", 7_200_000)):
        every = every_window(ev, window, slide).withColumnRenamed("items", "item_ids")
        cols = ["alert_id", "mid", "uids", "item_ids", "events", "ts", "window_start"]
        assert texts(AL.event_documents(ev, window, slide, ms).select(*cols)) == texts(AL.alert_documents(every, bucket_ms=ms).select(*cols))
    with pytest.raises(ValueError):
        AL.event_documents(ev, "5 minutes", "5 seconds", 7)


def test_a_hot_device_and_rows_without_device_or_time(spark):
    t0 = ts("2024-01-01 09:59:57")
    rows = [("hot", f"u{i % 7}" if i % 11 else None, "clickItem" if i % 97 == 0 else "coupon", f"i{i % 5}", t0 + dt.timedelta(seconds=i * 1.7)) for i in range(1500)]
    rows += [(None, f"u{i}", "coupon", "i", t0) for i in range(9)] + [("m", f"u{i}", "coupon", None, t0) for i in range(3)]
    ev = events(spark, rows)
    timeless = ev.withColumn("ts", ev["ts"] + (ev["ts"] - ev["ts"]) * 0).limit(0)
    got = AL.coupon_alerts(ev.unionByName(timeless), "1 minute", "5 seconds", with_events=True, chunk_windows=1)
    assert texts(got) == texts(every_window(ev.where("mid is not null"), "1 minute", "5 seconds")) and got.count() > 100
    assert AL.coupon_alerts(ev.limit(0)).count() == 0


@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 4), st.booleans()), max_size=40), st.integers(1, 9), st.integers(1, 4),
       st.integers(1, 3), st.one_of(st.none(), st.integers(1, 6)), st.integers(-5, 20), st.integers(1, 40))
@settings(max_examples=400, deadline=None)
def test_sweep_on_random_buckets(rows, width, slide, accounts, document, low, span):
    from cartpulse.operators.sweep import Bucket, Rule, alerted
    by = {}
    for at, uid, click in sorted(rows):
        b = by.setdefault(at, Bucket(at))
        b.clicked |= click and uid == 0
        b.uids.add(f"u{uid}")
        b.items.add(f"i{uid % 2}")
        b.events.append((at, uid))
    high = low + span
    want = []
    for e in range(low, high):
        inside = [b for at, b in sorted(by.items()) if e - width <= at < e]
        uids = set().union(*(b.uids for b in inside))
        if (e - width) % slide == 0 and len(uids) >= accounts and not any(b.clicked for b in inside):
            want.append((e, sorted(uids), sorted(set().union(*(b.items for b in inside))), [x for b in inside for x in b.events]))
    if document:
        want = list({w[0] // document: w for w in want}.values())
    # a sweep gets the buckets that its windows can hold
    assert list(alerted([b for at, b in sorted(by.items()) if low - width <= at < high], Rule(width, slide, accounts, document), low, high)) == want

"""Coupon-abuse alerts over sliding event-time windows.

A device raises an alert for a window when at least ``min_accounts``
distinct accounts took a coupon in it and no item was clicked in it.

Plan (batch), all in exact integer arithmetic on epoch microseconds:

1. keep only ``coupon`` / ``clickItem`` events - no other event can change
   the decision (all events where their lists are wanted);
2. number every event's bucket (bucket width = gcd(size, slide): a bucket lies wholly
   inside or outside any window) and its time chunk; an event near
   a chunk's end goes to the next chunk too, whose first windows reach back to it;
3. one shuffle by (device, chunk), sorted by time; a sweep (:mod:`sweep`) over
   the buckets finds ranges of alerted window ends and writes out those windows only.

A device holding a third of all events is spread over its chunks; a task holds
the buckets of one window width of one device at a time.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from cartpulse.constants import (ALERT_ID_BUCKET_MS, ALERT_MIN_ACCOUNTS, ALERT_SLIDE, ALERT_WINDOW,
                                 EVID_CLICK_ITEM, EVID_COUPON)
from cartpulse.functions.timeparts import EPOCH_NTZ, epoch_bucket, floor_div, lit_long, ntz_to_epoch_us
from cartpulse.operators.sweep import CLICK, COUPON, Bucket, Rule, Sweep

CHUNK_WINDOWS = 12  # window sizes per time chunk: one event in twelve is in two chunks
OUT_ROWS = 2048     # alerted windows per output batch

_UNIT_US = {"microsecond": 1, "millisecond": 1000, "second": 1_000_000, "minute": 60_000_000,
            "hour": 3_600_000_000, "day": 86_400_000_000, "week": 7 * 86_400_000_000}


def interval_us(text: str) -> int:
    """Microseconds of a fixed-length duration such as ``"5 minutes"`` or ``"1 hour"``."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", text.lower())
    if not m or m.group(2) not in _UNIT_US:
        raise ValueError(f"unsupported duration {text!r}")
    return int(m.group(1)) * _UNIT_US[m.group(2)]


class _Grid:
    """Window / bucket index arithmetic for one (size, slide)."""

    def __init__(self, window: str, slide: str):
        self.size, self.slide = interval_us(window), interval_us(slide)
        self.bucket = math.gcd(self.size, self.slide)

    def bucket_of(self, ts: str | Column) -> Column:
        return floor_div(ntz_to_epoch_us(ts), self.bucket)

    def buckets_of_window(self, k: Column) -> Column:
        """Buckets j wholly inside window k (its bounds are multiples of the bucket width)."""
        start = k * lit_long(self.slide)
        return F.sequence(floor_div(start, self.bucket), floor_div(start + lit_long(self.size), self.bucket) - 1)

    def start(self, k: Column) -> Column:
        return F.timestamp_add("MICROSECOND", k * lit_long(self.slide), EPOCH_NTZ())

    def end(self, k: Column) -> Column:
        return F.timestamp_add("MICROSECOND", k * lit_long(self.slide) + lit_long(self.size), EPOCH_NTZ())

    def index_of_start(self, start: str | Column) -> Column:
        return floor_div(ntz_to_epoch_us(start), self.slide)


_SWEPT = StructType([StructField("mid", StringType()), StructField("e", LongType()), StructField("uids", ArrayType(StringType())),
                     StructField("item_ids", ArrayType(StringType())), StructField("events", ArrayType(StringType()))])


def chunk_buckets(grid: _Grid, windows: int = CHUNK_WINDOWS, document_us: int | None = None) -> int:
    """Buckets of a time chunk: at least ``windows`` window sizes, whole documents."""
    unit = math.lcm(grid.bucket, document_us or grid.bucket)
    return -(-windows * grid.size // unit) * unit // grid.bucket


def with_chunks(events: DataFrame, grid: _Grid, chunk: int) -> DataFrame:
    """Adds bucket ``j`` and every chunk ``c`` that has a window with that bucket (one, seldom two)."""
    j, width = F.col("j"), grid.size // grid.bucket
    chunks = F.sequence(floor_div(j + lit_long(1), chunk), floor_div(j + lit_long(width), chunk))
    return events.withColumn("j", grid.bucket_of("ts")).withColumn("c", F.explode(chunks))


def _swept(rule: Rule, chunk: int):
    """``mapInArrow`` function over rows sorted by (mid, c, j): alerted windows, streamed device by device."""

    def run(batches):
        out: list[tuple] = []
        key, sweep, bucket = None, None, None

        def closed():
            if sweep is not None:
                yield from sweep.push(bucket)
                yield from sweep.end()

        def flush():
            mids, ends, uids, items, events = zip(*out)
            batch = pa.RecordBatch.from_arrays([pa.array(mids, pa.string()), pa.array(ends, pa.int64()), pa.array(uids, pa.list_(pa.string())),
                                                pa.array(items, pa.list_(pa.string())), pa.array(events, pa.list_(pa.string()))], _SWEPT.names)
            out.clear()
            return batch

        for b in batches:
            for mid, c, j, kind, uid, item, evid in zip(*(b.column(i).to_pylist() for i in range(7))):
                if key != (mid, c):
                    if key is not None:
                        out.extend((key[0], *w) for w in closed())
                    key, sweep, bucket = (mid, c), Sweep(rule, c * chunk, (c + 1) * chunk), Bucket(j)
                elif j != bucket.at:
                    for w in sweep.push(bucket):
                        out.append((mid, *w))
                        if len(out) >= OUT_ROWS:
                            yield flush()
                    bucket = Bucket(j)
                if kind == CLICK:
                    bucket.clicked = True
                elif kind == COUPON:
                    if uid is not None:
                        bucket.uids.add(uid)
                    if item is not None:
                        bucket.items.add(item)
                if evid is not None:
                    bucket.events.append(evid)
            if out:
                yield flush()
        if key is not None:
            out.extend((key[0], *w) for w in closed())
            if out:
                yield flush()

    return run


def coupon_alerts(events: DataFrame, window: str = ALERT_WINDOW, slide: str = ALERT_SLIDE,
                  min_accounts: int = ALERT_MIN_ACCOUNTS, with_events: bool = False, newest_per_ms: int | None = None,
                  chunk_windows: int = CHUNK_WINDOWS) -> DataFrame:
    """Alerted windows: (mid, window_start, window_end, uids, item_ids[, events]), sets sorted.

    ``with_events`` adds the ids (``evid``) of every event of the device in the
    window, in (ts, event_id) order. ``newest_per_ms`` keeps, of the windows of a device
    that end in the same so many milliseconds, the newest - what a document store
    keeps that is written by (device, minute). One scan and one shuffle either way.

    A NULL account is not counted (an unknown account is no evidence); events
    without a device or a time belong to no window.
    """
    g = _Grid(window, slide)
    document_us = newest_per_ms * 1000 if newest_per_ms else None
    if document_us and document_us % g.bucket:
        raise ValueError(f"documents of {newest_per_ms} ms do not hold whole buckets of {g.bucket} us")
    chunk = chunk_buckets(g, chunk_windows, document_us)
    rule = Rule(g.size // g.bucket, g.slide // g.bucket, min_accounts, document_us // g.bucket if document_us else None)
    kind = F.when(F.col("evid") == F.lit(EVID_COUPON), F.lit(COUPON)).when(F.col("evid") == F.lit(EVID_CLICK_ITEM), F.lit(CLICK)).otherwise(F.lit(0))
    used = events.where(F.col("mid").isNotNull() & F.col("ts").isNotNull())
    if not with_events:
        used = used.where(F.col("evid").isin(EVID_COUPON, EVID_CLICK_ITEM))
    order = ["ts", "event_id"] if with_events else []
    rows = with_chunks(used.select("mid", kind.alias("kind"), "uid", "itemid", "evid", "ts", *(["event_id"] if with_events else [])), g, chunk)
    placed = rows.select("mid", "c", "j", "kind", "uid", "itemid", F.col("evid") if with_events else F.lit(None).cast("string").alias("evid"), *order)
    sorted_rows = placed.repartition("mid", "c").sortWithinPartitions("mid", "c", "j", *order).select("mid", "c", "j", "kind", "uid", "itemid", "evid")
    e = F.col("e") * lit_long(g.bucket)
    at = lambda us: F.timestamp_add("MICROSECOND", us, EPOCH_NTZ())
    return (sorted_rows.mapInArrow(_swept(rule, chunk), _SWEPT)
            .select("mid", at(e - lit_long(g.size)).alias("window_start"), at(e).alias("window_end"), "uids", "item_ids",
                    *(["events"] if with_events else [])))


def alert_event_rows(events: DataFrame, alerts: DataFrame, window: str = ALERT_WINDOW,
                     slide: str = ALERT_SLIDE) -> DataFrame:
    """One row per (alerted window, event of that device inside it): the distributed form of A6.

    Each alerted window (with whatever columns ``alerts`` carries) is expanded
    to the buckets it covers and equi-joined with the events on
    (mid, bucket) - no range join, and a hot device is spread over its
    buckets (AQE splits a skewed bucket).
    """
    g = _Grid(window, slide)
    covered = alerts.withColumn("j", F.explode(g.buckets_of_window(g.index_of_start("window_start"))))
    bucketed = events.select("mid", "ts", "event_id", "evid", g.bucket_of("ts").alias("j"))
    return covered.join(bucketed, ["mid", "j"]).drop("j")


def alert_events(events: DataFrame, alerts: DataFrame, window: str = ALERT_WINDOW,
                 slide: str = ALERT_SLIDE) -> DataFrame:
    """Alerted windows with every event id (``evid``) of the device in them, in (ts, event_id) order.

    Other columns of ``alerts`` (e.g. the account / item sets) are carried
    through, so documents can be built from this one frame. The list of one
    window is assembled in one task; its length is bounded by one device's
    events in one window (use :func:`alert_event_rows` to keep it as rows).
    """
    keys = ["mid", "window_start", "window_end"]
    extra = [c for c in alerts.columns if c not in keys]
    rows = alert_event_rows(events, alerts, window, slide)
    return (rows.groupBy(*keys)
            .agg(*[F.first(c).alias(c) for c in extra],  # constant within a window
                 F.array_sort(F.collect_list(F.struct("ts", "event_id", "evid"))).alias("evs"))
            .select(*keys, *extra, F.transform("evs", lambda x: x["evid"]).alias("events")))


def alert_documents(alerts: DataFrame, events_per_window: DataFrame | None = None,
                    bucket_ms: int = ALERT_ID_BUCKET_MS) -> DataFrame:
    """Alert documents keyed ``mid:<window_end epoch-ms div bucket_ms>``; last window in a bucket wins.

    ``alerts`` may already carry ``events`` (of :func:`alert_events` or ``coupon_alerts(with_events=True)``).

    This is the effect of writing documents by id into an index: a later
    alert of the same device and minute overwrites the earlier one.
    """
    docs = alerts
    if events_per_window is not None:
        docs = docs.join(events_per_window.select("mid", "window_start", "window_end", "events"),
                         ["mid", "window_start", "window_end"], "left")
    elif "events" not in docs.columns:
        docs = docs.withColumn("events", F.lit(None).cast("array<string>"))
    docs = docs.withColumn("alert_id", alert_id(bucket_ms))
    cols = ["mid", "uids", "item_ids", "events", "window_start", "window_end"]
    latest = F.max_by(F.struct(*cols), F.col("window_end")).alias("_doc")
    return (docs.groupBy("alert_id").agg(latest)
            .select("alert_id", "_doc.mid", "_doc.uids", "_doc.item_ids", "_doc.events",
                    F.col("_doc.window_end").alias("ts"), F.col("_doc.window_start").alias("window_start")))


def alert_id(bucket_ms: int = ALERT_ID_BUCKET_MS) -> Column:
    return F.concat_ws(":", F.col("mid"), epoch_bucket("window_end", bucket_ms).cast("string"))


def event_documents(events: DataFrame, window: str = ALERT_WINDOW, slide: str = ALERT_SLIDE,
                    bucket_ms: int = ALERT_ID_BUCKET_MS, min_accounts: int = ALERT_MIN_ACCOUNTS) -> DataFrame:
    """The alert documents of an event log with their event lists, in the sweep's one scan and one shuffle:
    a document's windows all lie in one time chunk, so only its newest window is written out."""
    newest = coupon_alerts(events, window, slide, min_accounts, with_events=True, newest_per_ms=bucket_ms)
    return newest.select(alert_id(bucket_ms).alias("alert_id"), "mid", "uids", "item_ids", "events", F.col("window_end").alias("ts"), "window_start")

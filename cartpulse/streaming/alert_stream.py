"""Streaming coupon alerts on event time, with one state row per device group and time chunk.

An event goes to its device's time chunk (and, near a chunk's end, to the next one,
whose first windows reach back to it). Devices are dealt to groups by hash. The state of a (group, chunk) is its
devices' buckets in the chunk: accounts, items, click flag and events - what the batch sweep
reads, not one row per window. Each key costs a dozen calls between Python and the state store (state, timers), whatever it
holds: with groups these grow with time, not with devices. A micro-batch sweeps only the windows its events can change,
before and after, and writes those that differ: the micro-batch that brings a window its third
account reports it at once, a late click takes an alert back, and
windows at the end of the log need no later event to come out. A timer frees a chunk's state
when the watermark has passed its last window; events later than the
watermark are refused and counted in the batch's progress (``numRowsDroppedByWatermark``).

Alerted windows and alert documents (per device and minute the newest alerted window, with
its event list) are append-only logs of versions; :func:`read_alerts` and
:func:`read_alert_docs` take the newest version of each and leave out those taken back.
"""

from __future__ import annotations

from bisect import insort
from collections import defaultdict

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from cartpulse.constants import (ALERT_ID_BUCKET_MS, ALERT_MIN_ACCOUNTS, ALERT_SLIDE, ALERT_WINDOW,
                                 EVID_CLICK_ITEM, EVID_COUPON)
from cartpulse.functions.timeparts import epoch_bucket, epoch_ms_to_local, ntz_to_epoch_us, ntz_to_instant
from cartpulse.operators.alerts import _Grid, chunk_buckets, with_chunks
from cartpulse.operators.sweep import Bucket, Rule, alerted
from cartpulse.session import start_stream
from cartpulse.sources.json_logs import parse_events
from cartpulse.streaming.folds import fold_documents, read_documents
from cartpulse.streaming.seen_keys import STATE_CONF
from cartpulse.streaming.sinks import read_table, write_batch

STREAM_CHUNK_WINDOWS = 3  # window sizes per chunk: a state value stays small, one event in three is in two chunks
WINDOW_SCHEMA = ("mid string, window_start timestamp_ntz, window_end timestamp_ntz, uids array<string>, "
                 "item_ids array<string>, clicked boolean, batch_id long")
DOC_SCHEMA = ("alert_id string, mid string, uids array<string>, item_ids array<string>, events array<string>, "
              "ts timestamp_ntz, window_start timestamp_ntz, clicked boolean, batch_id long")
GROUPS = 64  # device groups per time chunk
RING = "buckets array<struct<mid:string,at:bigint,clicked:boolean,uids:array<string>,items:array<string>,events:array<struct<us:bigint,id:bigint,evid:string>>>>"
#: Versions: of a window (``doc`` NULL) or of a document (``doc`` its number; no ``window_end`` once it is gone).
CHANGES = ("mid string, window_start timestamp_ntz, window_end timestamp_ntz, uids array<string>, item_ids array<string>, "
           "events array<string>, clicked boolean, doc bigint")

_CHANGE = Row("mid", "window_start", "window_end", "uids", "item_ids", "events", "clicked", "doc")


class _Alerts(StatefulProcessor):
    """State of one (device group, chunk) and the versions a micro-batch brings."""

    def __init__(self, rule: Rule, chunk: int, bucket_us: int, lists: bool):
        self.rule, self.chunk, self.bucket_us, self.lists = rule, chunk, bucket_us, lists
        self.windows = Rule(rule.width, rule.slide, rule.accounts)

    def init(self, handle) -> None:
        self.handle = handle
        self.ring = handle.getValueState("ring", RING)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802,N803 - the interface's names
        c, stored = key[1], self.ring.get()
        held = defaultdict(list)
        for b in () if stored is None else stored[0]:
            held[b[0]].append(b)
        if stored is None:  # the chunk's last window ends here
            self.handle.registerTimer((c + 1) * self.chunk * self.bucket_us // 1000)
        devices = {}  # those with rows: their buckets before, after, and the places touched
        for r in rows:
            if r.mid not in devices:
                was = {b[1]: Bucket(b[1], b[2], set(b[3]), set(b[4]), [tuple(e) for e in b[5]]) for b in held.pop(r.mid, ())}
                devices[r.mid] = was, dict(was), set()
            before, after, touched = devices[r.mid]
            if r.j not in touched:
                touched.add(r.j)
                old = before.get(r.j) or Bucket(r.j)
                after[r.j] = Bucket(r.j, old.clicked, set(old.uids), set(old.items), list(old.events))
            b = after[r.j]
            if r.evid == EVID_CLICK_ITEM:
                b.clicked = True
            elif r.evid == EVID_COUPON:
                if r.uid is not None:
                    b.uids.add(r.uid)
                if r.itemid is not None:
                    b.items.add(r.itemid)
            if self.lists:
                insort(b.events, (r.us, r.event_id, r.evid or ""))
        kept = [(*b[:5], [tuple(e) for e in b[5]]) for bs in held.values() for b in bs]  # plain tuples: state takes no Row back
        kept += [(mid, b.at, b.clicked, sorted(b.uids), sorted(b.items), b.events) for mid, (_, after, _) in devices.items() for _, b in sorted(after.items())]
        self.ring.update((kept,))
        for mid, (before, after, touched) in devices.items():
            yield from self._changes(mid, c, before, after, touched)

    def _changes(self, mid, c, before, after, touched):
        """Versions of one device's windows and documents that differ."""
        # whole documents around the windows that hold a touched bucket
        doc = self.rule.document
        low = max(min(touched) + 1, c * self.chunk) // doc * doc
        high = -(-(min(max(touched) + self.rule.width, (c + 1) * self.chunk - 1) + 1) // doc) * doc
        was, now = ({w[0]: w[1:] for w in alerted((b for _, b in sorted(bs.items())), self.windows, low, high)} for bs in (before, after))
        for e in sorted(was.keys() | now.keys()):
            if was.get(e) != now.get(e):
                yield self._version(mid, e, now.get(e) or was[e], e not in now, None)
        for d in range(low // doc, high // doc):
            old, new = (max((e for e in ws if e // doc == d), default=None) for ws in (was, now))
            if (old, was.get(old)) != (new, now.get(new)):
                yield self._version(mid, new, now.get(new) or ([], [], []), new is None, d)

    def _version(self, mid, e, content, gone: bool, doc):
        uids, items, events = content
        start, end = (None, None) if e is None else (_wall((e - self.rule.width) * self.bucket_us), _wall(e * self.bucket_us))
        return _CHANGE(mid, start, end, uids, items, [x[2] for x in events] if self.lists else None, gone, doc)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802,N803
        self.ring.clear()
        yield from ()

    def close(self) -> None:
        pass


def _wall(us: int):
    import datetime as dt
    return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us)


def events_of_json(messages: DataFrame) -> DataFrame:
    """Event JSON (``value``) as a stream's input; texts that do not parse have no device and enter no window."""
    rows = parse_events(messages)
    return rows.select(F.lit(None).cast("bigint").alias("event_id"), "mid", "uid", "evid", "itemid", epoch_ms_to_local("ts").alias("ts"))


def alert_stream(events: DataFrame, window: str = ALERT_WINDOW, slide: str = ALERT_SLIDE, delay: str = "1 minute",
                 min_accounts: int = ALERT_MIN_ACCOUNTS, every_event: bool = False, bucket_ms: int = ALERT_ID_BUCKET_MS,
                 chunk_windows: int = STREAM_CHUNK_WINDOWS, groups: int = GROUPS) -> DataFrame:
    """Changed alert windows and documents (:data:`CHANGES`) of a stream of events.

    Only coupons and item clicks enter the state. With ``every_event`` all events do, and
    documents carry their event lists. ``delay`` is the watermark's: an event that is older than the
    newest one by more is refused. ``groups`` (fixed for a checkpoint) bounds the state rows of a time chunk; a state value
    holds a group's events of one chunk.
    """
    g = _Grid(window, slide)
    if bucket_ms * 1000 % g.bucket:
        raise ValueError(f"documents of {bucket_ms} ms do not hold whole buckets of {g.bucket} us")
    chunk = chunk_buckets(g, chunk_windows, bucket_ms * 1000)
    rule = Rule(g.size // g.bucket, g.slide // g.bucket, min_accounts, bucket_ms * 1000 // g.bucket)
    used = events.where(F.col("mid").isNotNull() & F.col("ts").isNotNull())
    if not every_event:
        used = used.where(F.col("evid").isin(EVID_COUPON, EVID_CLICK_ITEM))
    timed = used.withColumn("event_time", ntz_to_instant("ts")).withWatermark("event_time", delay)
    rows = with_chunks(timed, g, chunk).select(F.pmod(F.xxhash64("mid"), F.lit(groups)).alias("g"), "c", "mid", "j", "uid", "itemid", "evid", "event_id", ntz_to_epoch_us("ts").alias("us"), "event_time")
    return rows.groupBy("g", "c").transformWithState(_Alerts(rule, chunk, g.bucket, every_event), CHANGES, "Update", "EventTime")


def alert_docs(alerts: DataFrame, bucket_ms: int = ALERT_ID_BUCKET_MS) -> DataFrame:
    """Document versions: of changes that carry ``doc``, or one per alerted window."""
    events = F.col("events") if "events" in alerts.columns else F.lit(None).cast("array<string>")
    number = F.col("doc") if "doc" in alerts.columns else epoch_bucket("window_end", bucket_ms)
    return alerts.select(
        F.concat_ws(":", F.col("mid"), number.cast("string")).alias("alert_id"),
        "mid", "uids", "item_ids", events.alias("events"), F.col("window_end").alias("ts"), "window_start",
        F.col("clicked") if "clicked" in alerts.columns else F.lit(False).alias("clicked"))


def _current(log: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """Newest version per key; keys whose newest version was taken back are gone."""
    rest = [c for c in log.columns if c not in (*keys, "batch_id")]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("_v")).select(*keys, "_v.*")
    return newest.where(~F.col("clicked")).drop("clicked")


def read_alerts(spark: SparkSession, windows_table: str) -> DataFrame:
    """Alerted windows as of the last batch: (mid, window_start, window_end, uids, item_ids)."""
    log = read_table(spark, windows_table, WINDOW_SCHEMA)
    log = spark.createDataFrame([], WINDOW_SCHEMA) if log is None else log
    return _current(log, ["mid", "window_start", "window_end"], ["batch_id"])


DOC_VERSION = ["batch_id", "ts"]  # the newest batch, in it the newest window


def fold_alert_docs(spark: SparkSession, docs_table: str, buckets: int = 64) -> int:
    """Merge the document versions so far into the snapshot; only buckets with new versions are written again."""
    return fold_documents(spark, docs_table, "alert_id", DOC_VERSION, "clicked", buckets, DOC_SCHEMA)


def read_alert_docs(spark: SparkSession, docs_table: str, only: list[str] | None = None) -> DataFrame:
    """Alert documents as of the last batch: of each ``alert_id`` the newest version, those taken back left out;
    ``only`` the documents of these ids, from their buckets."""
    docs = read_documents(spark, docs_table, "alert_id", DOC_VERSION, "clicked", DOC_SCHEMA, only)
    docs = spark.createDataFrame([], DOC_SCHEMA) if docs is None else docs
    return docs.drop("clicked", "batch_id")


def start_alert_stream(alerts: DataFrame, windows_table: str, docs_table: str, checkpoint: str,
                       trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Write each micro-batch's changed alert windows and alert documents; no batch reads anything stored."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()
        try:
            write_batch(batch_df.where("doc IS NULL").drop("events", "doc"), windows_table, batch_id)
            write_batch(alert_docs(batch_df.where("doc IS NOT NULL")), docs_table, batch_id)
        finally:
            batch_df.unpersist()

    w = (alerts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})))
    if name:
        w = w.queryName(name)
    return start_stream(w, alerts.sparkSession, STATE_CONF)

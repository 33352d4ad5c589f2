"""Streaming daily active devices: exact first-arrival dedup across micro-batches.

``start_dau_stream`` keeps the devices seen in state (:mod:`seen_keys`): a
micro-batch costs what its own rows cost, however large the day's table has
grown. Its new rows go to ``log_date=<d>/batch_id=<n>``, replaced if the batch is replayed.

``dau_batch_writer`` is the same rule with the stored rows themselves as state, for
batches outside a stream (a backfill, a repair of rows that came after the state had
forgotten their key): in-batch dedup, then an anti join against
the stored rows of the batch's dates, cut to the batch's keys by a semi join.

Counts of rows in / rows kept are recorded per batch with ``observe``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartpulse.functions.timeparts import ntz_to_instant
from cartpulse.operators.dau import DAU_KEYS, DAU_ORDER, dau_hours
from cartpulse.operators.dedup import filter_seen_by_batch, first_per_key
from cartpulse.schemas import CORRUPT_COL
from cartpulse.session import start_stream
from cartpulse.sources.json_logs import corrupt_rows, parse_startup, valid_rows
from cartpulse.streaming.seen_keys import DELAY, STATE_CONF, first_per_key_stream
from cartpulse.streaming.sinks import read_dated, write_batch, write_dated_batch


def dau_batch_writer(rows_table: str, counts_table: str | None = None, keys=DAU_KEYS, order=DAU_ORDER):
    keys = list(keys)

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        seen_in, kept_out = Observation(f"in_{batch_id}"), Observation(f"out_{batch_id}")
        src = batch_df.observe(seen_in, F.count(F.lit(1)).alias("n"))
        # the deduplicated batch is used twice (its keys cut the stored rows, its rows are anti-joined)
        firsts = first_per_key(src, keys, order).persist()
        try:
            # one small job: fills the cache and brings the micro-batch's dates (a handful)
            dates = [r[0] for r in firsts.groupBy("log_date").count().collect()]
            stored = read_dated(spark, rows_table, "log_date", dates)
            new = firsts
            if stored is not None:
                new = filter_seen_by_batch(firsts, stored.where(F.col("batch_id") != batch_id), keys)
            write_dated_batch(new.observe(kept_out, F.count(F.lit(1)).alias("n")), rows_table, batch_id, "log_date")
        finally:
            firsts.unpersist()
        if counts_table is not None:
            n_in, n_out = seen_in.get.get("n", 0), kept_out.get.get("n", 0)
            counts = spark.range(1).select(F.lit(batch_id).cast("bigint").alias("stream_batch"),
                                           F.lit(n_in).cast("bigint").alias("n_before"),
                                           F.lit(n_out).cast("bigint").alias("n_after"))
            write_batch(counts, counts_table, batch_id)

    return write


def start_dau_stream(startup: DataFrame, rows_table: str, checkpoint: str, counts_table: str | None = None,
                     trigger: dict | None = None, name: str | None = None, delay: str = DELAY,
                     hours_table: str | None = None, order: Sequence[str] = DAU_ORDER, event_time: Column | None = None) -> StreamingQuery:
    """Device rows of a start-up stream; a day's devices are remembered until ``delay`` after its end.

    ``counts_table`` gets the device rows of each batch (its input rows are in the query's progress);
    ``hours_table`` the batch's devices per (log_date, log_hour): each device is counted once, so hours add up over batches.
    """
    firsts = first_per_key_stream(startup, DAU_KEYS, order, ntz_to_instant("ts") if event_time is None else event_time, delay)

    def write(batch_df: DataFrame, batch_id: int) -> None:
        kept = Observation(f"dau_{batch_id}")
        rows = batch_df.persist() if hours_table is not None else batch_df
        write_dated_batch(rows.observe(kept, F.count(F.lit(1)).alias("n")), rows_table, batch_id, "log_date")
        if hours_table is not None:
            write_dated_batch(dau_hours(rows), hours_table, batch_id, "log_date")
            rows.unpersist()
        if counts_table is not None:
            n = F.lit(kept.get.get("n", 0)).cast("bigint").alias("n_after")
            write_batch(batch_df.sparkSession.range(1).select(F.lit(batch_id).cast("bigint").alias("stream_batch"), n), counts_table, batch_id)

    w = (firsts.writeStream.foreachBatch(write).outputMode("update")
         .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})))
    if name:
        w = w.queryName(name)
    return start_stream(w, startup.sparkSession, STATE_CONF)


JSON_ORDER = ("ts", "uid", "appid", "area", "os", "ch", "type", "vs")


def start_dau_json_stream(messages: DataFrame, rows_table: str, checkpoint: str, **options) -> StreamingQuery:
    """Start-up JSON (``value``) -> device rows with all eleven columns (``ts`` epoch-ms). Of one device and day the earliest
    message stays, of equally early ones the smallest by its fields; texts that do not parse are for :func:`start_corrupt_stream`."""
    rows = valid_rows(parse_startup(messages))
    return start_dau_stream(rows, rows_table, checkpoint, order=JSON_ORDER, event_time=F.timestamp_millis("ts"), **options)


def start_corrupt_stream(messages: DataFrame, parse, table: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The texts that ``parse`` could not read, kept in a table (``value``) so that they can be counted, looked at and sent again."""
    broken = corrupt_rows(parse(messages)).select(F.col(CORRUPT_COL).alias("value"))
    w = (broken.writeStream.foreachBatch(lambda df, batch_id: write_batch(df, table, batch_id)).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})))
    return start_stream(w, messages.sparkSession)


def dau_watermark_dedup(startup: DataFrame, delay: str = "1 day") -> DataFrame:
    """State-store variant: first arrival per (mid, log_date) kept while inside the watermark delay.

    Bounded state (keys expire after ``delay``) but which row of a key wins
    inside one micro-batch is arrival order, not smallest ts.
    """
    return (startup.withColumn("event_time", ntz_to_instant("ts"))
            .withWatermark("event_time", delay)
            .dropDuplicatesWithinWatermark(list(DAU_KEYS)))

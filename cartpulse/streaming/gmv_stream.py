"""Streaming order value: parse order messages, store each order once, sum at read time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartpulse.functions.money import MONEY, money_sum
from cartpulse.functions.timeparts import ntz_to_epoch_us
from cartpulse.operators.dedup import filter_seen_by_batch, first_per_key
from cartpulse.schemas import CORRUPT_COL
from cartpulse.session import start_stream
from cartpulse.sources.json_logs import parse_orders
from cartpulse.streaming.seen_keys import DELAY, STATE_CONF, first_per_key_stream
from cartpulse.streaming.sinks import read_dated, read_table, write_dated_batch


ORDER_KEYS = ["create_date", "id"]  # copies of one order carry the same date
ORDER_FIRST = ["create_time", "total_amount", "user_id"]  # of the copies in a batch the smallest stays


def _stands_alone():
    """Messages without an id to merge by are stored one by one."""
    return F.col(CORRUPT_COL).isNotNull() | F.col("id").isNull()


def order_batch_writer(order_table: str):
    """``foreachBatch`` writer: store each order id once.

    In the batch, the first copy per id is kept (partial aggregation); across
    batches, ids already stored under the batch's dates are dropped by the
    anti join used for devices. Unparseable messages and orders
    without an id are stored as they are (never merged). The table then needs no dedup when read.
    """
    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        single = _stands_alone()
        valid = batch_df.where(~single)
        firsts = first_per_key(valid, ORDER_KEYS, ORDER_FIRST).persist()
        try:
            dates = [r[0] for r in firsts.groupBy("create_date").count().collect()]
            stored = read_dated(spark, order_table, "create_date", dates)
            new = firsts
            if stored is not None:
                seen = stored.where((F.col("batch_id") != batch_id) & F.col(CORRUPT_COL).isNull() & F.col("id").isNotNull())
                new = filter_seen_by_batch(firsts, seen, ORDER_KEYS)
            rows = new.unionByName(batch_df.where(single))
            write_dated_batch(rows, order_table, batch_id, "create_date")
        finally:
            firsts.unpersist()

    return write


def start_order_stream(messages: DataFrame, order_table: str, checkpoint: str, trigger: dict | None = None,
                       name: str | None = None, delay: str = DELAY, hours_table: str | None = None) -> StreamingQuery:
    """Order JSON messages -> order table laid out ``create_date=/batch_id=``, one row per order id.

    The ids stored are kept in state (:mod:`seen_keys`) until ``delay`` after their day, so no batch reads the table;
    :func:`order_batch_writer` does the same from the stored rows, outside a stream. A message that stands
    alone has its own text and a random number as key. An order without a date is known on the day it arrives.
    ``hours_table`` gets the batch's exact sums per (create_date, create_hour), which add up over batches.
    """
    parsed = parse_orders(messages).withColumn("_alone", F.when(_stands_alone(), F.uuid()))
    day = F.timestamp_micros(ntz_to_epoch_us(F.col("create_date").cast("timestamp_ntz")))
    firsts = first_per_key_stream(parsed, [*ORDER_KEYS, "_alone"], ORDER_FIRST, day, delay).drop("_alone")

    def write(batch_df: DataFrame, batch_id: int) -> None:
        rows = batch_df.persist() if hours_table is not None else batch_df
        write_dated_batch(rows, order_table, batch_id, "create_date")
        if hours_table is not None:
            cents = rows.where(F.col(CORRUPT_COL).isNull() & F.col("create_date").isNotNull()).groupBy("create_date", "create_hour")
            write_dated_batch(cents.agg(F.sum(F.col("total_amount").cast(MONEY)).cast("decimal(38,2)").alias("order_amount")), hours_table, batch_id, "create_date")
            rows.unpersist()

    w = (firsts.writeStream.foreachBatch(write).outputMode("update")
         .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})))
    if name:
        w = w.queryName(name)
    return start_stream(w, messages.sparkSession, STATE_CONF)


def read_orders(spark: SparkSession, order_table: str, dates: list | None = None) -> DataFrame | None:
    """Stored, parseable orders (already one row per id); ``dates`` lists only those date folders."""
    if dates is None:
        stored = read_table(spark, order_table)
    else:
        stored = read_dated(spark, order_table, "create_date", dates)
    if stored is None:
        return None
    return stored.where(F.col(CORRUPT_COL).isNull())


def live_gmv_hours(parsed_orders: DataFrame) -> DataFrame:
    """Running order value per (date, hour) of a parsed order stream (update/complete output mode)."""
    return (parsed_orders.where(F.col("create_date").isNotNull())
            .groupBy("create_date", "create_hour").agg(money_sum("total_amount").alias("order_amount")))

"""Cross-batch "first row per key" on aggregation state: a micro-batch reads no stored rows.

The state holds, per key, the row with the smallest (arrival, order), where
arrival is the micro-batch's time. A row of an earlier batch is never replaced, and of one batch's
rows the smallest ``order`` wins. A key comes out whenever it was touched; it is new if its
row's arrival is this batch's. Each map task first reduces its rows to one per key, so a hot key
costs one row per task.

A batch that is run again after a failure has the time it had (Spark keeps it with the batch's
offsets) and gives the same rows. Keys are grouped by their event day, and
a day's keys leave the state when the watermark has passed its end by ``delay``;
rows that come even later are refused and counted in the batch's progress
(``numRowsDroppedByWatermark``): store those with a ``*_batch_writer``, which looks at the stored rows.
A clock that is set back between two batches would make a known key look new.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The state store of keyed state: on disk, its commits write changes only. Batches without data would
#: only free state; the next batch with data does that.
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass":
              "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
              "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
              "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
DELAY = "2 days"


def first_per_key_stream(rows: DataFrame, keys: Sequence[str], order: Sequence[str], event_time: Column,
                         delay: str = DELAY) -> DataFrame:
    """Of a stream: the first row of every key not seen before (update mode).

    NULL is a key value like any other; rows without an ``event_time`` count to the
    day they arrive on. A key belongs to the day of its ``event_time``.
    """
    names = rows.columns
    now = F.current_timestamp()  # the micro-batch's time
    rest = [c for c in names if c not in keys]
    timed = rows.withColumn("_seen", now).withColumn("_at", F.coalesce(event_time, "_seen")).withWatermark("_at", delay)
    first = F.min_by(F.struct(*rest, "_seen"), F.struct("_seen", *order)).alias("_first")
    found = timed.groupBy(F.window("_at", "1 day").alias("_day"), *keys).agg(first)
    return found.where(F.col("_first._seen") == now).select(*[F.col(c) if c in keys else F.col(f"_first.{c}") for c in names])

"""Daily active devices: first start-up per (device, day) and its rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartpulse.functions.timeparts import EPOCH_NTZ, epoch_bucket, ntz_to_epoch_us, two_digit_hour
from cartpulse.operators.dedup import first_per_key

DAU_KEYS = ("mid", "log_date")
DAU_ORDER = ("ts", "event_id")


def dau_rows(startup: DataFrame, keys=DAU_KEYS, order=DAU_ORDER) -> DataFrame:
    """One row per device and day: the start-up with the smallest (ts, id)."""
    return first_per_key(startup, keys, order)


def active_devices(startup: DataFrame) -> DataFrame:
    """(mid, log_date) of every active device: all that counting needs."""
    return startup.select(*DAU_KEYS).distinct()


def first_hours(startup: DataFrame) -> DataFrame:
    """(mid, log_date, log_hour) of each device's first start-up.

    The earliest time decides the hour whatever the id, so the dedup is a minimum of one fixed-width
    number: a hash aggregation on both sides of the shuffle, without a sort.
    """
    first = startup.groupBy(*DAU_KEYS).agg(F.min(ntz_to_epoch_us("ts")).alias("_us"))
    return first.select(*DAU_KEYS, two_digit_hour(F.timestamp_add("MICROSECOND", F.col("_us"), EPOCH_NTZ())).alias("log_hour"))


def with_batch_id(df: DataFrame, batch_ms: int, ts: str = "ts") -> DataFrame:
    """Micro-batch number of each record when the log is replayed in ``batch_ms`` slices."""
    return df.withColumn("batch_id", epoch_bucket(ts, batch_ms))


def dau_cross_batch(startup: DataFrame, batch_ms: int) -> DataFrame:
    """Rows kept by the two-stage stream dedup, computed for every micro-batch at once.

    Stage 1 keeps the first row per (mid, log_date, batch_id), stage 2 drops a row when an earlier batch kept
    the same (mid, log_date). What stays is the row of the smallest (batch_id, ts, event_id) per
    (mid, log_date): one scan, one aggregation, no join with the rows seen before.
    """
    firsts = first_per_key(with_batch_id(startup, batch_ms), DAU_KEYS, ("batch_id", *DAU_ORDER))
    rest = [c for c in startup.columns if c not in DAU_KEYS]
    return firsts.select(*DAU_KEYS, "batch_id", *rest)


def dedup_counts(startup: DataFrame, batch_ms: int) -> DataFrame:
    """Per micro-batch: records in, and device rows left after both dedup stages.

    One pass, hash aggregations only: inputs are counted per (mid, log_date, batch); a
    key's first batch comes from a window over (mid, log_date) (at most one
    row per batch of the day per key), and one aggregation per batch counts
    both numbers.
    """
    keys = [*DAU_KEYS, "batch_id"]
    batches = with_batch_id(startup, batch_ms).groupBy(*keys).agg(F.count("*").alias("n_in"))
    first_batch = F.min("batch_id").over(Window.partitionBy(*DAU_KEYS))
    return (batches.withColumn("_first_batch", first_batch)
            .groupBy("batch_id")
            .agg(F.sum("n_in").alias("n_before"),
                 F.count_if(F.col("batch_id") == F.col("_first_batch")).alias("n_after")))


def dau_total(dau: DataFrame, date: str | None = None) -> DataFrame:
    """DAU per date (``count(*)`` of the day's device rows)."""
    if date is not None:
        dau = dau.where(F.col("log_date") == F.lit(date).cast("date"))
    return dau.groupBy("log_date").agg(F.count("*").alias("dau"))


def dau_hours(dau: DataFrame, date: str | None = None) -> DataFrame:
    """DAU per date and hour of the device's first start-up."""
    if date is not None:
        dau = dau.where(F.col("log_date") == F.lit(date).cast("date"))
    return dau.groupBy("log_date", "log_hour").agg(F.count("*").alias("dau"))


def new_devices(dau: DataFrame) -> DataFrame:
    """Devices whose first day ever is the date: (log_date, new_mid)."""
    first_day = dau.groupBy("mid").agg(F.min("log_date").alias("log_date"))
    return first_day.groupBy("log_date").agg(F.count("*").alias("new_mid"))


def dau_and_new_devices(dau: DataFrame) -> DataFrame:
    """(log_date, dau, new_mid) in one pass over the device rows.

    A device's first day comes from a window over the device (one row per
    day it was active), so active and new devices are counted by the same
    aggregation.
    """
    first_day = F.min("log_date").over(Window.partitionBy("mid"))
    return (dau.select("mid", "log_date").withColumn("_first_day", first_day)
            .groupBy("log_date")
            .agg(F.count("*").alias("dau"), F.count_if(F.col("log_date") == F.col("_first_day")).alias("new_mid")))

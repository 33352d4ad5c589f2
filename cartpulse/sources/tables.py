"""Batch scans and the mapping of the driver's test tables onto the warehouse's records.

Every reader selects only the columns it needs so the parquet scan's
``ReadSchema`` stays narrow; filters written on top are pushed into the scan
by Catalyst.

Stand-ins (the test tables are TPC-H-like plus an ``events`` log):

* start-up log: ``events`` with ``mid = uid = user_id``;
* event log: ``events`` with ``mid = user_id div 5`` (five accounts share a
  device, so devices grow with the users), ``uid = user_id``, ``purchase`` ->
  ``coupon``, ``view`` -> ``clickItem``, ``itemid = props.k``. A device is in
  use for ten minutes a day: the time of day is shrunk 144-fold and starts at
  the device's hour, so that accounts meet inside the alert's 5-minute window;
* order (daily): ``orders`` (``create_time`` = order date at midnight);
* order (hourly): ``purchase`` events (``total_amount = value``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.constants import EVID_CLICK_ITEM, EVID_COUPON
from cartpulse.functions.timeparts import EPOCH_NTZ, floor_div, lit_long, ntz_to_epoch_us, wall_clock_text, with_date_hour

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

ACCOUNTS_PER_DEVICE = 5
DAY_US, HOUR_US = 86_400_000_000, 3_600_000_000
BURST_SHRINK = 144  # a day's events fall into ten minutes


def load_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def startup_log(spark: SparkSession, sf_dir: str, dates: Sequence[str] | None = None) -> DataFrame:
    """Start-up records: (event_id, mid, uid, type, ts, log_date, log_hour)."""
    ev = on_days(load_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"]), "ts", dates)
    df = ev.select(
        "event_id",
        F.col("user_id").cast("string").alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.col("event_type").alias("type"),
        "ts",
    )
    return with_date_hour(df, "ts")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour events: (event_id, mid, uid, evid, itemid, ts)."""
    device = floor_div(F.col("user_id"), ACCOUNTS_PER_DEVICE)
    us = ntz_to_epoch_us("ts")
    day = floor_div(us, DAY_US) * lit_long(DAY_US)
    burst = day + (device % 24) * lit_long(HOUR_US) + floor_div(us - day, BURST_SHRINK)
    ev = load_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"])
    return ev.select(
        "event_id",
        device.cast("string").alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.when(F.col("event_type") == "purchase", F.lit(EVID_COUPON))
         .when(F.col("event_type") == "view", F.lit(EVID_CLICK_ITEM))
         .otherwise(F.col("event_type")).alias("evid"),
        F.get_json_object("props", "$.k").alias("itemid"),
        F.timestamp_add("MICROSECOND", burst, EPOCH_NTZ()).alias("ts"),
    )


def on_days(df: DataFrame, ts: str, dates: Sequence[str] | None) -> DataFrame:
    """Rows whose ``ts`` lies on one of the dates (None: all), as time ranges that reach the scan."""
    if dates is None:
        return df
    start = [F.lit(d).cast("date") for d in dates]
    ranges = [(F.col(ts) >= d.cast("timestamp_ntz")) & (F.col(ts) < F.date_add(d, 1).cast("timestamp_ntz")) for d in start]
    return df.where(reduce(or_, ranges, F.lit(False)))


def daily_orders(spark: SparkSession, sf_dir: str, dates: Sequence[str] | None = None) -> DataFrame:
    """Order rows from ``orders``: (id, user_id, order_status, total_amount, create_time)."""
    o = on_days(load_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                     "o_orderdate"]), "o_orderdate", dates)
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
        wall_clock_text("o_orderdate").alias("create_time"),
    )


def hourly_orders(spark: SparkSession, sf_dir: str, dates: Sequence[str] | None = None) -> DataFrame:
    """Order rows from ``purchase`` events: (id, user_id, total_amount, create_time)."""
    ev = on_days(load_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"]), "ts", dates)
    return ev.where(F.col("event_type") == "purchase").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("value").alias("total_amount"),
        wall_clock_text("ts").alias("create_time"),
    )


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int = 1,
              properties: dict | None = None) -> DataFrame:
    """A fact table from a SQL store, read in ``num_partitions`` parallel range slices.

    Filters and column selections written on the result are pushed into the
    generated SQL by the JDBC source.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", str(lower))
                  .option("upperBound", str(upper)).option("numPartitions", str(num_partitions)))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()

"""Dashboard results served from the stored fact tables written by the streams.

The device-row table (``stream_dau``) is laid out ``log_date=/batch_id=`` and
the order table (``stream_gmv``) ``create_date=/batch_id=``, so a one-day
request reads only that day's folders (partition pruning, or only those
folders listed); "yesterday" adds one more.

With the streams' hour tables and the first-day table (:class:`HourPublisher`) a poll reads the
folded partial sums of one or two dates, whatever the day's rows and the device history.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.operators import dau as DAU
from cartpulse.operators import gmv as GMV
from cartpulse.plans import dashboard as DASH
from cartpulse.streaming.first_days import read_new_devices
from cartpulse.streaming.folds import read_folded
from cartpulse.streaming.gmv_stream import read_orders
from cartpulse.streaming.sinks import read_table


class Publisher:
    """Serves KPI totals and hour series for a date from the stream-written tables."""

    def __init__(self, spark: SparkSession, dau_table: str, order_table: str):
        self.spark = spark
        self.dau_table = dau_table
        self.order_table = order_table

    def _dau(self) -> DataFrame:
        rows = read_table(self.spark, self.dau_table)
        if rows is None:
            return self.spark.createDataFrame([], "mid string, log_date date, log_hour string")
        return rows.select("mid", "log_date", "log_hour")

    def _orders(self, dates: list | None) -> DataFrame:
        orders = read_orders(self.spark, self.order_table, dates)
        if orders is None:
            return self.spark.createDataFrame([], "id string, total_amount double, create_date date, create_hour string")
        return orders

    def realtime_total(self, date: str) -> DataFrame:
        d = F.lit(date).cast("date")
        dau = self._dau()
        # new devices need history up to the date (first day per device), not just the date
        new = DAU.new_devices(dau.where(F.col("log_date") <= d))
        day = dt.date.fromisoformat(date)
        return DASH.realtime_total(DAU.dau_total(dau, date), new, GMV.gmv_total(self._orders([day]), date), date)

    def realtime_hours(self, metric: str, date: str) -> DataFrame:
        day = dt.date.fromisoformat(date)
        two_days = [day, day - dt.timedelta(days=1)]
        dau_hours = DAU.dau_hours(self._dau().where(F.col("log_date").isin(*two_days)))
        gmv_hours = GMV.gmv_hours(self._orders(two_days))
        return DASH.realtime_hours_for(metric, dau_hours, gmv_hours, date)

    # --- the same answers through Spark SQL over temp views (named parameters, pruned by date) ---

    SQL = {
        "dau_total": "SELECT count(*) AS dau FROM {dau} WHERE log_date = :d",
        "dau_hours": "SELECT log_hour, count(*) AS dau FROM {dau} WHERE log_date = :d GROUP BY log_hour",
        "gmv_total": "SELECT CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS order_amount "
                     "FROM {orders} WHERE create_date = :d",
        "gmv_hours": "SELECT create_hour, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS order_amount "
                     "FROM {orders} WHERE create_date = :d GROUP BY create_hour",
    }

    def register_views(self, prefix: str = "cp") -> dict[str, str]:
        """Temp views over the stored tables (parseable orders only); returns their names."""
        names = {"dau": f"{prefix}_dau_rows", "orders": f"{prefix}_order_rows"}
        self._dau().createOrReplaceTempView(names["dau"])
        self._orders(None).createOrReplaceTempView(names["orders"])
        self._views = names
        return names

    def sql(self, name: str, date: str) -> DataFrame:
        """One of the four dashboard lookups (``SQL`` keys) for ``date`` via ``spark.sql``."""
        views = getattr(self, "_views", None) or self.register_views()
        return self.spark.sql(self.SQL[name].format(**views), args={"d": dt.date.fromisoformat(date)})


class HourPublisher:
    """The same answers from partial sums: hours of devices and orders per batch, changes of first days."""

    def __init__(self, spark: SparkSession, dau_hours_table: str, order_hours_table: str, new_devices_table: str):
        self.spark, self.dau_table, self.order_table, self.new_table = spark, dau_hours_table, order_hours_table, new_devices_table

    def dau_hours(self, dates: list | None = None) -> DataFrame:
        parts = read_folded(self.spark, self.dau_table, "log_date", dates)
        if parts is None:
            return self.spark.createDataFrame([], "log_date date, log_hour string, dau bigint")
        return parts.groupBy("log_date", "log_hour").agg(F.sum("dau").alias("dau"))

    def gmv_hours(self, dates: list | None = None) -> DataFrame:
        parts = read_folded(self.spark, self.order_table, "create_date", dates)
        if parts is None:
            return self.spark.createDataFrame([], "create_date date, create_hour string, order_amount double")
        return parts.groupBy("create_date", "create_hour").agg(F.sum("order_amount").cast("double").alias("order_amount"))

    def realtime_total(self, date: str | None = None) -> DataFrame:
        """KPI rows of one date, or of every date."""
        dates = None if date is None else [dt.date.fromisoformat(date)]
        dau = self.dau_hours(dates).groupBy("log_date").agg(F.sum("dau").alias("dau"))
        orders = read_folded(self.spark, self.order_table, "create_date", dates)
        amount = self.gmv_hours(dates) if orders is None else orders
        gmv = amount.groupBy("create_date").agg(F.sum("order_amount").cast("double").alias("order_amount"))
        return DASH.realtime_total(dau, read_new_devices(self.spark, self.new_table, dates), gmv, date)

    def realtime_hours(self, metric: str, date: str | None = None) -> DataFrame:
        """Today and yesterday by hour, of one date or of every date."""
        day = None if date is None else dt.date.fromisoformat(date)
        dates = None if day is None else [day, day - dt.timedelta(days=1)]
        return DASH.realtime_hours_for(metric, self.dau_hours(dates), self.gmv_hours(dates), date)

"""Gross merchandise value per day and per hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.functions.money import money_sum
from cartpulse.functions.timeparts import split_create_time


def order_facts(orders: DataFrame) -> DataFrame:
    """Order rows with ``create_date`` / ``create_hour`` derived from ``create_time``."""
    return split_create_time(orders)


def gmv_total(facts: DataFrame, date: str | None = None) -> DataFrame:
    """Order amount per date; rows without a date are not summed."""
    if date is not None:
        facts = facts.where(F.col("create_date") == F.lit(date).cast("date"))
    return (facts.where(F.col("create_date").isNotNull())
            .groupBy("create_date").agg(money_sum("total_amount").alias("order_amount")))


def gmv_hours(facts: DataFrame, date: str | None = None) -> DataFrame:
    """Order amount per date and real hour (all orders of an hour are summed)."""
    if date is not None:
        facts = facts.where(F.col("create_date") == F.lit(date).cast("date"))
    return (facts.where(F.col("create_date").isNotNull())
            .groupBy("create_date", "create_hour").agg(money_sum("total_amount").alias("order_amount")))


def undated_orders(facts: DataFrame) -> DataFrame:
    """Count of orders that carry no usable create time (kept out of dated sums)."""
    return facts.agg(F.count_if(F.col("create_date").isNull()).alias("undated"))

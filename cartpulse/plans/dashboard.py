"""Dashboard results: KPI totals, today-vs-yesterday hour series, hour maps.

All of these run after a (day, hour) or (day) aggregation, so everything
past the first ``groupBy`` handles at most days x 24 rows whatever the input
size. Yesterday's series is produced by shifting the day by one and merging
in the same aggregation - no self join; missing hours are filled from a
24-hour spine generated per day (``sequence`` + ``explode``), not a cross join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.constants import KPI_DAU, KPI_NEW_MID, KPI_ORDER_AMOUNT


def realtime_hours(hour_values: DataFrame, day: str, hour: str, value: str,
                   date: str | None = None, zero=0) -> DataFrame:
    """(day, hour, today, yesterday) for every day of ``hour_values`` (or one ``date``), 24 rows each.

    One pass over the (day, hour) aggregate: each input row emits its value
    as "today" of its day, as "yesterday" of the next day, and the 24 spine
    hours of its day; a single aggregation merges them.
    """
    hv = hour_values.select(F.col(day).alias("day"), F.col(hour).alias("hour"), F.col(value).alias("v"))
    vtype = dict(hv.dtypes)["v"]
    null_v = F.lit(None).cast(vtype)
    if date is not None:
        d = F.lit(date).cast("date")
        hv = hv.where(F.col("day").isin(d, F.date_sub(d, 1)))
        spine_day = d  # the asked-for day always gets its 24 rows
        keep = F.col("day") == d
    else:
        spine_day = F.col("day")
        keep = F.lit(True)

    def entry(dd, hh, today, yest, spine):
        return F.struct(dd.alias("day"), hh.alias("hour"), today.alias("today"), yest.alias("yesterday"),
                        F.lit(spine).alias("in_spine"))

    spine = F.transform(F.sequence(F.lit(0), F.lit(23)),
                        lambda h: entry(spine_day, F.lpad(h.cast("string"), 2, "0"), null_v, null_v, True))
    entries = F.concat(F.array(entry(F.col("day"), F.col("hour"), F.col("v"), null_v, False),
                               entry(F.date_add("day", 1), F.col("hour"), null_v, F.col("v"), False)), spine)
    if date is not None:
        # a day with no rows at all still gets its spine
        seed = hv.sparkSession.range(1).select(F.inline(F.transform(
            F.sequence(F.lit(0), F.lit(23)),
            lambda h: entry(d, F.lpad(h.cast("string"), 2, "0"), null_v, null_v, True))))
        exploded = hv.select(F.inline(entries)).unionByName(seed)
    else:
        exploded = hv.select(F.inline(entries))
    merged = (exploded.groupBy("day", "hour")
              .agg(F.sum("today").alias("today"), F.sum("yesterday").alias("yesterday"),
                   F.bool_or("in_spine").alias("in_spine")))
    z = F.lit(zero).cast(vtype)
    return merged.where(F.col("in_spine") & keep).select(
        "day", "hour", F.coalesce("today", z).alias("today"), F.coalesce("yesterday", z).alias("yesterday"))


METRICS = ("dau", "order_amount")


def realtime_hours_for(metric: str, dau_hour_counts: DataFrame, gmv_hour_sums: DataFrame,
                       date: str | None = None) -> DataFrame:
    """Hour series of one dashboard metric: ``dau`` or ``order_amount`` (anything else is an error)."""
    if metric == "dau":
        return realtime_hours(dau_hour_counts, "log_date", "log_hour", "dau", date)
    if metric == "order_amount":
        return realtime_hours(gmv_hour_sums, "create_date", "create_hour", "order_amount", date, zero=0.0)
    raise ValueError(f"unknown metric {metric!r}; expected one of {METRICS}")


def hours_map(hour_values: DataFrame, day: str, hour: str, value: str) -> DataFrame:
    """(day, hours) with ``hours`` a JSON object hour -> value, keys in hour order."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(hour).alias("k"), F.col(value).alias("v"))))
    return (hour_values.groupBy(F.col(day).alias("day"))
            .agg(F.to_json(F.map_from_entries(entries)).alias("hours")))


def realtime_total(dau_per_day: DataFrame, new_per_day: DataFrame | None, gmv_per_day: DataFrame,
                   date: str | None = None) -> DataFrame:
    """KPI rows (day, id, name, value) for every day with devices or orders, or for one ``date``.

    ``dau_per_day``: (log_date, dau) or (log_date, dau, new_mid) with
    ``new_per_day`` None; ``new_per_day``: (log_date, new_mid);
    ``gmv_per_day``: (create_date, order_amount). A day without orders has a
    NULL amount; a day without devices has 0 active and 0 new devices. The
    inputs are merged by one aggregation over their days, without a join.
    """
    combined = new_per_day is None
    none = F.lit(None)

    def part(df, day, dau=none, new_mid=none, amount=none):
        return df.select(F.col(day).alias("day"), dau.cast("bigint").alias("dau"), new_mid.cast("bigint").alias("new_mid"),
                         amount.cast("double").alias("order_amount"))

    parts = [part(dau_per_day, "log_date", F.col("dau"), F.col("new_mid") if combined else none),
             part(gmv_per_day.where("create_date is not null"), "create_date", amount=F.col("order_amount"))]
    if not combined:
        parts.append(part(new_per_day, "log_date", new_mid=F.col("new_mid")))
    if date is not None:
        d = F.lit(date).cast("date")
        # the asked-for day always gets its rows
        parts = [p.where(F.col("day") == d) for p in parts] + [part(dau_per_day.sparkSession.range(1).select(d.alias("day")), "day")]
    wide = (reduce(DataFrame.unionByName, parts).groupBy("day")
            .agg(F.max("dau").alias("dau"), F.max("new_mid").alias("new_mid"), F.max("order_amount").alias("order_amount")))

    def kpi(pair, v):
        return F.struct(F.lit(pair[0]).alias("id"), F.lit(pair[1]).alias("name"), v.cast("double").alias("value"))

    rows = F.array(kpi(KPI_DAU, F.coalesce(F.col("dau"), F.lit(0))),
                   kpi(KPI_NEW_MID, F.coalesce(F.col("new_mid"), F.lit(0))),
                   kpi(KPI_ORDER_AMOUNT, F.col("order_amount")))
    return wide.select("day", F.inline(rows))

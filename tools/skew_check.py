"""Hot-key check: one device / customer holds a third of all rows.

Derives skewed variants of the test tables, runs the operators on them and
reads Spark's event log (written to a fresh scratch folder; the web UI stays
off) to report, for every stage that reads a shuffle, the largest task's
share of the records that stage read (partition coalescing is off so the
raw hash distribution shows). A plan that sends a hot group to one task
shows a share near 1/3 or more; partial aggregation and AQE skew splitting
keep it near 1/tasks.

usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cartpulse.session import build_session  # noqa: E402

PARTS = 8


def skewed_events(spark, sf):
    from cartpulse.sources.tables import load_table
    ev = load_table(spark, sf, "events").repartition(PARTS)  # many scan tasks, as on a cluster
    # a third of all events come from user 0 (the hot device in both stand-ins)
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="cartpulse-eventlog-")
    spark = build_session(shuffle_partitions=32, extra={"spark.sql.adaptive.coalescePartitions.enabled": "false","spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{logdir}",
                                 "spark.eventLog.compress": "false",
                                 "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB"})
    import cartpulse.sources.tables as TB
    from cartpulse.operators import alerts as AL, dau as DAU, sales as SALES

    ev = skewed_events(spark, sf)
    ev.createOrReplaceTempView("skewed_events")
    startup = TB.with_date_hour(ev.select("event_id", F.col("user_id").cast("string").alias("mid"),
                                          F.col("user_id").cast("string").alias("uid"),
                                          F.col("event_type").alias("type"), "ts"), "ts")
    elog = ev.select("event_id", (F.col("user_id") % 10).cast("string").alias("mid"),
                     F.col("user_id").cast("string").alias("uid"),
                     F.when(F.col("event_type") == "purchase", "coupon").when(F.col("event_type") == "view", "clickItem")
                      .otherwise(F.col("event_type")).alias("evid"),
                     F.get_json_object("props", "$.k").alias("itemid"), "ts")
    orders = TB.load_table(spark, sf, "orders").repartition(PARTS).withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey")))
    lineitem = TB.load_table(spark, sf, "lineitem").repartition(PARTS)
    cases = {
        "dau_first": lambda: DAU.dau_rows(startup),
        "dau_cross_batch": lambda: DAU.dau_cross_batch(startup, 3_600_000),
        "new_devices": lambda: DAU.new_devices(DAU.dau_rows(startup)),
        "coupon_alerts_5min": lambda: AL.coupon_alerts(elog),
        "alert_events (6 h / 1 h)": lambda: AL.alert_events(elog, AL.coupon_alerts(elog, "6 hours", "1 hour"),
                                                            "6 hours", "1 hour"),
        "sale_detail (hot customer)": lambda: SALES.sale_detail(
            lineitem, orders, TB.load_table(spark, sf, "customer"), TB.load_table(spark, sf, "part"),
            TB.load_table(spark, sf, "nation")),
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the large-table plan
    for name, build in cases.items():
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    spark.stop()
    report(sorted(p for p in glob.glob(f"{logdir}/**", recursive=True) if os.path.isfile(p)))


def _lines(paths):
    for p in paths:
        with open(p) as fh:
            yield from fh


def report(paths):
    stage_group, tasks = {}, {}
    for line in _lines(paths):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in ev.get("Stage IDs", []):
                stage_group[sid] = group
        elif kind == "SparkListenerTaskEnd":
            m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
            recs = m.get("Total Records Read", 0)
            if recs:
                tasks.setdefault(ev["Stage ID"], []).append(recs)
    out = {}
    for sid, recs in sorted(tasks.items()):
        if sum(recs) >= 1000 and len(recs) > PARTS:  # hash-shuffle stages (the 8-way input split is even)
            out.setdefault(stage_group.get(sid), []).append(
                {"stage": sid, "tasks": len(recs), "records": sum(recs), "max_task_share": round(max(recs) / sum(recs), 3)})
    print(json.dumps(out))


if __name__ == "__main__":
    main()

"""Session helpers: scoped query settings and the shared checkpoint folder."""

import glob
import json

from cartpulse.session import ensure_checkpoint_dir, query_conf, scratch_path, start_stream


def test_query_conf_restores_settings(spark):
    key, other = "spark.sql.shuffle.partitions", "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key)
    had_other = spark.conf.get(other, None)
    with query_conf(spark, {key: "3", other: "false"}):
        assert spark.conf.get(key) == "3" and spark.conf.get(other) == "false"
    assert spark.conf.get(key) == before
    assert spark.conf.get(other, None) == had_other


def test_scratch_paths_are_fresh_and_under_the_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark).replace("file:", "")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base.rstrip("/"))


def test_stream_partition_count_is_kept_in_the_checkpoint(spark):
    work = scratch_path(spark, "test_parts")
    spark.range(10).selectExpr("id % 3 AS k").write.parquet(f"{work}/src")
    agg = spark.readStream.schema("k long").parquet(f"{work}/src").groupBy("k").count()
    w = (agg.writeStream.outputMode("complete").format("memory").queryName("parts_test")
         .option("checkpointLocation", f"{work}/ckpt").trigger(availableNow=True))
    q = start_stream(w, spark, partitions=3)
    q.awaitTermination(120)
    offsets = sorted(glob.glob(f"{work}/ckpt/offsets/[0-9]*"))
    meta = json.loads(open(offsets[0]).read().splitlines()[1])
    assert meta["conf"]["spark.sql.shuffle.partitions"] == "3"
    assert sorted(r["count"] for r in spark.table("parts_test").collect()) == [3, 3, 4]


def test_entry_survives_a_missing_library():
    """With a library of the training-data operators absent, all other queries register."""
    import subprocess
    import sys
    root = __import__("pathlib").Path(__file__).resolve().parent.parent
    code = ("import sys; sys.modules['xxhash'] = None; sys.modules['sentencepiece'] = None\n"
            "import __spark_entry__ as E; from cartpulse.plans.catalog import ALL_QUERIES\n"
            "assert set(ALL_QUERIES) <= set(E.queries()) and E.oracle_sql()")
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-500:]

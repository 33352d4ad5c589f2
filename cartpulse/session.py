"""Session helpers: building a session for tests/bench and finding shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library wants. Shuffle partitions are sized by
# the caller: ~cores locally, ~(shuffle bytes / 128 MB) on a cluster; AQE then
# coalesces small partitions and splits skewed ones at run time.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "cartpulse",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read. Only
    when it is unset (local tests) is a fresh local folder chosen, and never
    when the master is not local.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="cartpulse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder below the shared checkpoint dir (never reused)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")  # with its scheme: the default file system may be another one
    return "/".join([base, "cartpulse", *parts, uuid.uuid4().hex])


class query_conf:  # noqa: N801 - used as a context manager
    """Session settings applied only while a streaming query is being started.

    A streaming query copies the session configuration when it starts, so
    settings made here stay with that query and are restored for the rest of
    the session afterwards.
    """

    def __init__(self, spark: SparkSession, conf: dict[str, str]):
        self.spark, self.conf, self.saved = spark, conf, {}

    def __enter__(self):
        for k, v in self.conf.items():
            self.saved[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)
        return self

    def __exit__(self, *exc):
        for k, v in self.saved.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


def start_stream(writer, spark: SparkSession, conf: dict[str, str] | None = None, partitions: int | None = None):
    """Start a streaming query with its own shuffle partition count.

    A stream's state stores and per-batch jobs are sized for one micro-batch,
    not for the session's largest batch job: ``partitions`` (default: the
    cluster's cores) is fixed into the checkpoint at the first start and
    reused on every restart.
    """
    settings = {"spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism)}
    settings.update(conf or {})
    with query_conf(spark, settings):
        return writer.start()

"""Idempotent per-micro-batch sinks.

Every ``foreachBatch`` writer stores a micro-batch under its own
``batch_id=<n>`` folder with overwrite, so a batch replayed after a failure
replaces its own earlier output and nothing else. Readers see the union of
all batch folders. Keyed upserts (alert documents) are resolved at read time:
the newest version of each key wins (an append-only log merged on read).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HIVE_DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # folder name Spark writes for a NULL partition value


def batch_folder(table: str, batch_id: int) -> str:
    return f"{table.rstrip('/')}/batch_id={batch_id}"


def write_batch(df: DataFrame, table: str, batch_id: int, partition_by: list[str] | None = None) -> None:
    """Write one micro-batch's rows (replacing an earlier attempt of the same batch)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(batch_folder(table, batch_id))


def delete_batch(spark: SparkSession, table: str, batch_id: int) -> None:
    """Remove one micro-batch's folder, if there is one."""
    fs, p = _fs_path(spark, batch_folder(table, batch_id))
    fs.delete(p, True)


def write_dated_batch(df: DataFrame, table: str, batch_id: int, date_col: str) -> None:
    """Write one micro-batch under ``<date_col>=<d>/batch_id=<n>`` folders.

    Dynamic partition overwrite replaces exactly the (date, batch) folders the
    batch produces, so a replayed batch replaces its own earlier attempt, and
    a reader interested in a few dates lists only those dates' folders.
    """
    (df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(date_col, "batch_id").parquet(table))


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the path's own file system; a path without scheme belongs to the default one, as in Spark's readers."""
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def table_exists(spark: SparkSession, table: str) -> bool:
    """True once the table folder holds a partition folder."""
    fs, p = _fs_path(spark, table)
    return bool(fs.exists(p)) and any("=" in st.getPath().getName() for st in fs.listStatus(p))


def read_dated(spark: SparkSession, table: str, date_col: str, dates) -> DataFrame | None:
    """Rows of a date-partitioned sink table for the given dates only (others are not even listed)."""
    names = sorted({HIVE_DEFAULT_PARTITION if d is None else str(d) for d in dates})
    paths = [f"{table.rstrip('/')}/{date_col}={d}" for d in names]
    paths = [p for p in paths if path_exists(spark, p)]
    if not paths:
        return None
    return spark.read.option("basePath", table).parquet(*paths)


def read_table(spark: SparkSession, table: str, schema=None) -> DataFrame | None:
    """All committed micro-batches of a sink table (``batch_id`` is a partition column)."""
    if not table_exists(spark, table):
        return None
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(table)


def read_latest(spark: SparkSession, table: str, key: str, version: str) -> DataFrame | None:
    """Upsert view of an append-only document log: per ``key`` the row with the largest ``version``."""
    log = read_table(spark, table)
    if log is None:
        return None
    cols = [c for c in log.columns if c not in (key, "batch_id")]
    best = F.max_by(F.struct(*cols), F.struct(F.col(version), F.col("batch_id"))).alias("_d")
    return log.groupBy(key).agg(best).select(key, "_d.*")


def console_sink(df: DataFrame, num_rows: int = 100):
    """Print a stream's rows (the original printed counts and the first 100 rows per batch)."""
    return df.writeStream.format("console").option("numRows", num_rows).option("truncate", "false")


def compact_latest(spark: SparkSession, table: str, key: str, version: str, dest: str,
                   partition_by: list[str] | None = None) -> DataFrame:
    """Fold a document log into one row per key, written as a new table at ``dest``.

    ``dest`` must be a new folder (a job cannot overwrite what it reads);
    readers switch to it afterwards. The written table also ends the
    lineage of the merged view.
    """
    if path_exists(spark, dest):
        raise FileExistsError(dest)
    latest = read_latest(spark, table, key, version)
    if latest is None:
        raise FileNotFoundError(table)
    w = latest.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(dest)
    return spark.read.parquet(dest)

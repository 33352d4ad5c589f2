"""Shared helpers of the training-data operators: scratch tables and column selection."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.session import ensure_checkpoint_dir

# words end at ASCII white space (0x20, 0x09-0x0D), the same set bytes.split() uses
SPACE_CLASS = r"[\x20\x09-\x0D]"


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``, with its scheme."""
    return qualified(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}")


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme of the file system that Spark's own readers and writers take it from,
    so that files written from tasks lie in the same place as tables."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: the lineage
    ends here, and every executor can read the rows after another one is lost."""
    path = scratch_uri(df.sparkSession, name)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names; other columns never travel."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

"""Keyword search by an inverted index of three-letter pieces instead of a scan of all names.

A name that contains a keyword contains all the keyword's pieces. The index holds (piece, id) rows in folders
by the piece's checksum, sorted by piece; a search reads the folders of its own pieces, keeps the
ids that have all of them, and verifies these names with ``contains``.
"""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE = 3


def _pieces(text: Column) -> Column:
    n = F.length(text) - F.lit(PIECE) + 1
    return F.when(n >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(text, i, F.lit(PIECE)))))


def write_index(names: DataFrame, path: str, id_col: str, text_col: str, buckets: int = 64) -> None:
    """Index ``text_col`` (any case) of every row. Rows without a text or an id are in no search; repeated rows count once."""
    rows = names.select(F.col(id_col).alias("id"), F.explode(_pieces(F.lower(text_col))).alias("piece")).where("id IS NOT NULL").distinct()
    placed = rows.withColumn("bucket", F.pmod(F.crc32(F.encode("piece", "UTF-8")), F.lit(buckets)).cast("int"))
    # a piece that most names have lies in many files: its ids are spread over the tasks
    spread = placed.repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(8))).sortWithinPartitions("bucket", "piece")
    spread.write.partitionBy("bucket").parquet(f"{path}/buckets={buckets}")


def search(spark: SparkSession, path: str, names: DataFrame, id_col: str, text_col: str, keyword: str, buckets: int = 64) -> DataFrame:
    """The rows of ``names`` whose text contains ``keyword`` in any case. A keyword shorter
    than a piece has no piece to look up: all names are scanned."""
    word = keyword.lower()
    holds = F.lower(text_col).contains(word)
    if len(word) < PIECE:
        return names.where(holds)
    pieces = sorted({word[i:i + PIECE] for i in range(len(word) - PIECE + 1)})
    folders = sorted({crc32(p.encode()) % buckets for p in pieces})
    index = spark.read.parquet(f"{path}/buckets={buckets}").where(F.col("bucket").isin(folders) & F.col("piece").isin(pieces))
    ids = index.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") == len(pieces)).select(F.col("id").alias("_hit"))
    return names.join(ids, F.col(id_col) == F.col("_hit"), "left_semi").where(holds)

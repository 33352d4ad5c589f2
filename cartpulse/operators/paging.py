"""Deep pages without a deep sort: rows stored in key order in range parts, with each part's row count.

:func:`write_pages` sorts once (a range shuffle). A page then is arithmetic on the
parts' counts (at most ``parts`` numbers) and a read of the one or two parts that hold it;
the next page after a known row needs no offset at all.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PART = "_part"


def write_pages(rows: DataFrame, path: str, order: Sequence[str], parts: int = 64) -> None:
    """Store ``rows`` below ``path`` in ``order`` (end it with a unique key, or equal rows may change places), about equal parts."""
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(PART, F.spark_partition_id())
    ranged.write.partitionBy(PART).parquet(f"{path}/rows")
    stored = rows.sparkSession.read.parquet(f"{path}/rows")
    key = F.struct(*order)
    counts = stored.groupBy(PART).agg(F.count("*").alias("n"), F.max(key).alias("last"))
    counts.select(PART, "n", "last", F.lit(json.dumps(list(order))).alias("order")).coalesce(1).write.parquet(f"{path}/index")


class Pages:
    """A stored page index."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.index = sorted(spark.read.parquet(f"{path}/index").collect())  # one row a part
        self.order = json.loads(self.index[0]["order"]) if self.index else []
        self.total = sum(r["n"] for r in self.index)

    def _parts(self, numbers: list[int]) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows").where(F.col(PART).isin(numbers)).drop(PART)

    def page(self, start: int, length: int) -> DataFrame:
        """Rows ``start`` to ``start + length - 1`` with the ``total``; reads only the parts that hold them."""
        held, before, skipped = [], 0, 0
        for r in self.index:
            if before + r["n"] > start and before < start + length:
                skipped = before if not held else skipped
                held.append(r[PART])
            before += r["n"]
        rows = self._parts(held).orderBy(*self.order).offset(start - skipped if held else 0).limit(length)
        return rows.withColumn("total", F.lit(self.total).cast("bigint"))

    def after(self, key: Sequence, length: int) -> DataFrame:
        """The ``length`` rows behind the row with this key (the last one of the page before)."""
        held, n = [], 0
        for r in self.index:
            if tuple(r["last"]) > tuple(key):
                if held and n >= length:  # the first part may lie before the key but for one row
                    break
                n += r["n"] if held else 0
                held.append(r[PART])
        rows = self._parts(held)
        behind = F.struct(*self.order) > F.struct(*[F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in zip(self.order, key)])
        return rows.where(behind).orderBy(*self.order).limit(length)

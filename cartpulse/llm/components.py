"""Connected components of a distributed edge list (alternating large-star / small-star).

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Every
round is two shuffles over the edges; each round's edges are written to the
shared checkpoint folder, so a lost executor costs one round at most and no
link ever reaches the driver (only a row count and a checksum do).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to its smallest neighbour (or itself)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to its smallest neighbour."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of one orderable type -> ``(u, root)`` for every linked node.

    ``root`` is the smallest node reachable, itself included. NULL ends and
    self links are ignored; repeated links change nothing; no links give no rows.
    """
    now = stored(edges.select("u", "v").filter("u is not null and v is not null and u <> v").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = stored(small_star(large_star(now)), "edges")
        new = _mark(now)
        if new == mark:
            break
        mark = new
    nodes = now.select("u", F.col("v").alias("root"))
    return nodes.unionByName(now.select(F.col("v").alias("u"), F.col("v").alias("root"))).distinct()

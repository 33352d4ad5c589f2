"""Sharding by a minimax contiguous partition over ordered atomic groups.

Groups are equal texts; they are ordered by the 64-bit hash of the text and an
atom is one of ``2**cell_bits`` equal ranges of that order, so all copies of a
text lie in one atom and the atom sizes the driver sees are bounded at every
input size (2**18 pairs of longs). The smallest shard capacity that some
contiguous cut into ``shards`` parts can keep is found by binary search with a
greedy check; the cut then keeps that capacity and otherwise follows the even
share of what is left, so a huge atom does not leave later shards empty. An
atom is at most one 2**18th of the hash order beyond its largest group, which
bounds how far the capacity lies above the one over single groups.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartpulse.llm.common import id_text, stored

CELL_BITS = 18
SLICE_ROWS = 50_000  # rows a slot window handles in one task, about


def fits(ends: np.ndarray, capacity: int, shards: int, start: int = 0) -> bool:
    """Greedy check: do the atoms from ``start`` on fit into ``shards`` parts of ``capacity``?
    ``ends`` are the running totals of the sizes, with a leading 0."""
    at = start
    for _ in range(shards):
        if at >= len(ends) - 1:
            return True
        to = int(np.searchsorted(ends, ends[at] + capacity, side="right")) - 1
        if to == at:
            return False
        at = to
    return at >= len(ends) - 1


def smallest_capacity(sizes: np.ndarray, shards: int) -> int:
    """Binary search of the smallest feasible capacity of a contiguous partition."""
    ends = np.concatenate(([0], np.cumsum(np.asarray(sizes, np.int64))))
    total, largest = int(ends[-1]), int(max([0, *np.asarray(sizes).tolist()]))
    low, high = max(largest, -(-total // shards)), max(largest, -(-total // shards)) + largest
    while low < high:
        mid = (low + high) // 2
        if fits(ends, mid, shards):
            high = mid
        else:
            low = mid + 1
    return low


def cut_points(sizes: np.ndarray, shards: int) -> list[int]:
    """Indexes of the first atom of shards 1..shards-1 under the smallest capacity.

    Each shard ends where it comes nearest to an even share of the rest, unless
    the capacity or the feasibility of what follows forces another place.
    """
    sizes = np.asarray(sizes, np.int64)
    capacity = smallest_capacity(sizes, shards)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    n, at, cuts = len(sizes), 0, []
    for left in range(shards - 1, 0, -1):
        share = (ends[-1] - ends[at]) / (left + 1)
        most = int(np.searchsorted(ends, ends[at] + capacity, side="right")) - 1
        to = min(int(np.searchsorted(ends, ends[at] + share, side="left")), most)
        if to > at and abs(ends[to - 1] - ends[at] - share) < abs(ends[to] - ends[at] - share):
            to -= 1
        low, high = max(to, at), max(most, at)
        if not fits(ends, capacity, left, low):  # the greedy end is always feasible: find the first that is
            while low < high:
                mid = (low + high) // 2
                low, high = (low, mid) if fits(ends, capacity, left, mid) else (mid + 1, high)
        at = min(low, n)
        cuts.append(at)
    return cuts


def shard_documents(docs: DataFrame, shards: int = 40, overhead: int = 16, cell_bits: int = CELL_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)``, one row per input row.

    ``size`` is the text's UTF-8 bytes plus ``overhead``. A NULL text has size
    ``overhead`` and CRC 0, and NULL texts are one group. Slots are gapless from
    0 in each shard, ordered by a hash slice of the doc_id, then doc_id, then
    hash. Rows repeated in every column take neighbouring slots. NULL ids come
    first in their slice. An empty table gives no rows; other columns are not read.
    """
    base = id_text(docs, id_col, text_col)
    rows = stored(base.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.lit(overhead)).alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0).cast("long")).alias("text_crc32"),
        F.coalesce(F.xxhash64("text"), F.lit(0).cast("long")).alias("hash")), "shard-rows")
    cell = F.shiftrightunsigned("hash", 64 - cell_bits).cast("int")
    found = rows.groupBy(cell.alias("cell")).agg(F.sum("size").alias("bytes")).toPandas()  # at most 2**cell_bits rows
    sizes = np.zeros(1 << cell_bits, np.int64)
    sizes[found["cell"].to_numpy(np.int64)] = found["bytes"].to_numpy(np.int64)
    cuts = cut_points(sizes, shards)
    shard = reduce(lambda a, b: a + b, [(cell >= F.lit(int(c))).cast("int") for c in cuts], F.lit(0))
    placed = rows.withColumn("shard", shard)
    most = placed.groupBy("shard").count().agg(F.max("count")).first()[0] or 0  # from at most `shards` rows
    slices = max(1, -(-most // SLICE_ROWS))
    placed = placed.withColumn("slice", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(slices)).cast("int"))
    counts = placed.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "slice", (F.sum("n").over(Window.partitionBy("shard").orderBy("slice")) - F.col("n")).alias("before"))
    w = Window.partitionBy("shard", "slice").orderBy("doc_id", "hash")
    return (placed.withColumn("rank", F.row_number().over(w)).join(before, ["shard", "slice"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("rank") - 1).cast("long").alias("slot")))

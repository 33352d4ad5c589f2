"""Packing into optimal length buckets.

The global histogram of document lengths (a Spark aggregate, one row per distinct
length) goes to the driver. It is short: distinct lengths add up to at most all tokens,
so there are at most sqrt(2 * tokens) of them. Dynamic programming over the exact
lengths picks the bucket upper bounds that minimise total padding, by divide and
conquer (the best split moves up with the length), in about buckets * lengths * log(lengths)
steps; a bucket's bound is its longest length, so nothing is ever cut off. Inside each bucket,
batches hold as many documents as the token budget allows when all are padded to the bound (one
where a document alone exceeds it).

Batches form in hash slices of each bucket, about ``SLICE_ROWS`` rows each, so no
task orders a whole bucket; each slice leaves at most one batch unfilled.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartpulse.llm.common import SPACE_CLASS

EXACT = 512
STEPS = 256
SLICE_ROWS = 50_000


def token_count(text: Column) -> Column:
    """Words of the text plus one end mark, so every document takes room."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")
    return F.when(trimmed == "", F.lit(1)).otherwise(F.size(F.split(trimmed, SPACE_CLASS + "+")) + 1).cast("long")


def cell_of(length: Column) -> Column:
    """Cell number, rising with the length: exact up to ``EXACT``, then ``STEPS`` cells per power of two.
    For coarse length statistics; the bounds come from the exact lengths."""
    power = F.floor(F.log2(F.greatest(length, F.lit(EXACT)).cast("double"))).cast("int")
    within = F.floor((length - F.pow(F.lit(2.0), power)) * STEPS / F.pow(F.lit(2.0), power)).cast("long")
    return F.when(length <= EXACT, length).otherwise(EXACT + (power - 9) * STEPS + within + 1).cast("long")


def _layer(best: np.ndarray, top: np.ndarray, n: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One more bucket: for every j the least best[i] + cost(i, j) over i < j, and the first i that gives it.

    That i never falls as j rises, so the middle j of a range splits the candidates of both halves;
    all ranges of a level are computed at once, about len(top) candidates a level."""
    new, came = np.zeros_like(best), np.zeros(len(best), np.int32)
    low, high, first, last = (np.array([x], np.int64) for x in (1, len(top), 0, len(top) - 1))
    while len(low):
        j = (low + high) // 2
        size = np.minimum(last, j - 1) - first + 1
        starts = np.cumsum(size) - size
        i, of = np.arange(size.sum()) - np.repeat(starts - first, size), np.repeat(j, size)
        cost = best[i] + top[of - 1] * (n[of] - n[i]) - (t[of] - t[i])
        least = np.minimum.reduceat(cost, starts)
        split = np.minimum.reduceat(np.where(cost == np.repeat(least, size), i, len(top)), starts)
        new[j], came[j] = least, split
        low, high = np.concatenate((low, j + 1)), np.concatenate((j - 1, high))
        first, last = np.concatenate((first, split)), np.concatenate((split, last))
        some = low <= high
        low, high, first, last = low[some], high[some], first[some], last[some]
    return new, came


def bucket_bounds(lengths: np.ndarray, counts: np.ndarray, totals: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding.

    Per distinct length in rising order: the length, number of documents, sum of their lengths.
    cost(i, j) = lengths[j-1] * documents of lengths i..j-1 - their tokens; best[k][j] = min over i of best[k-1][i] + cost(i, j).
    """
    m = len(lengths)
    if not m:
        return []
    top = np.asarray(lengths, np.int64)
    n, t = (np.concatenate(([0], np.cumsum(np.asarray(x, np.int64)))) for x in (counts, totals))
    best, came = np.concatenate(([0], top * n[1:] - t[1:])), [np.zeros(m + 1, np.int32)]
    for _ in range(1, min(buckets, m)):
        best, split = _layer(best, top, n, t)
        came.append(split)
    bounds, j = [], m
    for split in reversed(came):
        if j:
            bounds.append(int(lengths[j - 1]))
            j = int(split[j])
    return bounds[::-1]


def pack(docs: DataFrame, buckets: int = 16, budget: int = 16_384, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, bucket, padded_len, batch, slot)``, one row per input row.

    ``bucket`` counts from 0 by rising ``padded_len`` (the bucket's bound, at least
    ``n_tokens``); ``batch`` names the batch, ``slot`` the place in it, from 0. A NULL or empty
    text has one token. Equal lengths are ordered by doc_id, NULL ids first;
    repeated rows take neighbouring slots. An empty table gives no rows; extra columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), token_count(F.col(text_col).cast("string")).alias("n_tokens"))
    lengths = rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).orderBy("n_tokens").toArrow()
    tops, held = (lengths.column(c).to_numpy() for c in ("n_tokens", "n"))
    bounds = bucket_bounds(tops, held, tops * held, buckets)
    if not bounds:
        return rows.select("doc_id", "n_tokens", F.lit(0).alias("bucket"), F.lit(0).cast("long").alias("padded_len"), F.lit("").alias("batch"), F.lit(0).alias("slot")).limit(0)
    low, pick = -1, None
    for k, bound in enumerate(bounds):
        inside = int(held[(tops > low) & (tops <= bound)].sum())
        one = F.struct(F.lit(k).alias("bucket"), F.lit(bound).cast("long").alias("padded_len"), F.lit(max(1, -(-inside // SLICE_ROWS))).alias("slices"),
                       F.lit(max(1, budget // bound)).alias("room"))
        pick = F.when(F.col("n_tokens") <= bound, one) if pick is None else pick.when(F.col("n_tokens") <= bound, one)
        low = bound
    placed = rows.select("doc_id", "n_tokens", pick.alias("p")).select("doc_id", "n_tokens", "p.*")
    placed = placed.withColumn("slice", F.pmod(F.xxhash64("doc_id", "n_tokens"), F.col("slices").cast("long")))
    rank = F.row_number().over(Window.partitionBy("bucket", "slice").orderBy("n_tokens", "doc_id")) - 1
    placed = placed.withColumn("rank", rank)
    return placed.select("doc_id", "n_tokens", "bucket", "padded_len",
                         F.concat_ws("-", "bucket", "slice", F.floor(F.col("rank") / F.col("room"))).alias("batch"),
                         (F.col("rank") % F.col("room")).cast("int").alias("slot"))

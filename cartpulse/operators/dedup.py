"""First record per key (in-batch dedup) and the cross-batch "already seen" filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, for every key, the row with the smallest ``order`` tuple.

    ``min_by`` is an aggregate, so each map task first reduces its rows to one
    per key (partial aggregation) and only those cross the shuffle; a hot key
    costs one row per task, not a third of the input in one sort.
    ``order`` should end with a unique id so ties are broken deterministically.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(best).select(*keys, "_first.*")


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys`` treating NULL = NULL (a NULL date is still a key); planned as an equi join."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, cond, how)


def filter_seen(batch: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``seen`` (left anti join, NULL-safe keys).

    No broadcast hint: the seen set grows with the data. Catalyst/AQE pick a
    broadcast only when the measured size allows it.
    """
    return _null_safe_join(batch, seen, list(keys), "left_anti")


def filter_seen_by_batch(batch: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Same result as :func:`filter_seen` for a batch with one row per key.

    The seen rows are first cut to the batch's keys by a semi join, then
    anti-joined. No hint and no row count: the planner broadcasts the batch's
    keys when their measured bytes allow it - persist and fill ``batch`` before,
    its cache then carries exact sizes - so the large seen set is scanned but
    not shuffled; otherwise both are shuffled.
    """
    keys = list(keys)
    hits = _null_safe_join(seen.select(*keys), batch.select(*keys), keys, "left_semi")
    return _null_safe_join(batch, hits, keys, "left_anti")

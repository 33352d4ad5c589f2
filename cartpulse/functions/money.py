"""Money and set-formatting helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money_sum(col: str | Column) -> Column:
    """Exact sum of a double amount: add as decimal(18,2), hand back a double.

    NULL when there are no rows (the original SQL ``sum`` behaviour).
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast(MONEY)).cast("double")


def sorted_csv(col: str | Column, sep: str = ",") -> Column:
    """Deterministic text of a string set/list: sorted, joined."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.array_sort(c), sep)

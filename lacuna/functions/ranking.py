"""Ranking with average ties (pandas ``rank(method='average')``)."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def average_rank(value: str, ascending: bool = True, partition_by: list[str] | None = None) -> Column:
    """rank() + (ties - 1) / 2; nulls get no rank.

    Meant for small result tables (one row per method); with ``partition_by``
    it also scales, since each partition is ranked on its own.
    """
    order = F.col(value).asc_nulls_last() if ascending else F.col(value).desc_nulls_last()
    w = Window.partitionBy(*(partition_by or [])).orderBy(order)
    tie = Window.partitionBy(*(partition_by or []), value)
    r = F.rank().over(w) + (F.count(F.lit(1)).over(tie) - 1) / 2.0
    return F.when(F.col(value).isNotNull(), r.cast("double"))

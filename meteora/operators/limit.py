"""Limits and top-k.  Every limit is taken after a total order, so the result
does not depend on partitioning; Spark plans it as TakeOrderedAndProject
(per-task top-k, then a merge of k rows per task)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def sample_rows(df: DataFrame, n: int | None, order: list[str | Column]) -> DataFrame:
    """First ``n`` rows by ``order`` for trial runs; ``None`` keeps all rows."""
    if n is None:
        return df
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, k: int, order: list[str | Column]) -> DataFrame:
    return df.orderBy(*order).limit(k)

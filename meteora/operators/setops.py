"""Set operations."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import DataFrame


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name of the given relations (one per year)."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_all needs at least one relation")
    return reduce(lambda a, b: a.unionByName(b), frames)

"""Window forms of the SQL models, in shapes that survive hot groups.

``avg(x) over (partition by k)`` and ``row_number() ... = 1`` are expressed
without a Window operator: a window sends every row of a partition key to
one task, so one hot station/day would land in a single task.  Here the
averages come from a partially aggregated groupBy that is joined back on
the key (AQE splits a skewed side of that join), and "keep the first row"
is a ``min_by`` aggregate, which also combines map-side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteora.functions.scalar import extract_year, trunc_year
from meteora.operators.aggregate import ORDER, ordered_rows, to_wide
from meteora.operators.pivot import explode_elements
from meteora.options import TransformOptions
from meteora.schemas import MEASURES


def partition_avg(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Every row of ``df`` with ``cols`` replaced by their average over ``keys``.

    Keys are matched null-safely, as a window partition groups nulls.
    """
    pk = {k: f"_pk_{i}" for i, k in enumerate(keys)}
    avgs = df.groupBy(*[F.col(k).alias(pk[k]) for k in keys]).agg(*[F.avg(c).alias(f"_avg_{c}") for c in cols])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(pk[k])) for k in keys])
    rest = [c for c in df.columns if c not in cols]
    return df.join(avgs, cond, "inner").select(*rest, *[F.col(f"_avg_{c}").alias(c) for c in cols])


def keep_first(df: DataFrame, keys: list[str], order: str, per_column: bool = False) -> DataFrame:
    """One row per key: the one with the smallest ``order`` (rn = 1).

    By default the row is taken whole (``min_by`` of a struct), which Spark
    runs as a sort-based aggregate.  ``per_column`` takes ``min_by`` of each
    column instead: with fixed-width columns that stays a hash aggregate, and
    it yields one consistent row when ``order`` is unique within a key (rows
    tied on ``order`` may then mix columns).
    """
    others = [c for c in df.columns if c not in keys and c != order]
    if per_column:
        return df.groupBy(*keys).agg(*[F.min_by(c, order).alias(c) for c in others])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*others), order).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in others])


def _rows(obs: DataFrame, opts: TransformOptions, yearly: bool) -> DataFrame:
    rows = explode_elements(ordered_rows(obs, opts), opts, keep=(ORDER,))
    if yearly:
        rows = rows.withColumn("_year", extract_year("date"))
    return rows


def window_avg(obs: DataFrame, opts: TransformOptions, yearly: bool = False) -> DataFrame:
    """Every cleaned row with the averages of its station/day (or station/year).

    Columns: id, date, m_flag, s_flag, tmax..snwd; for the yearly form
    ``date`` is the first day of the year, as in the yearly SQL model.
    """
    rows = _rows(obs, opts, yearly)
    keys = ["id", "_year"] if yearly else ["id", "date"]
    out = partition_avg(rows, keys, list(MEASURES))
    if yearly:
        out = out.withColumn("date", trunc_year("date"))
    return out.select("id", "date", "m_flag", "s_flag", *MEASURES)


def window_dedup(obs: DataFrame, opts: TransformOptions, yearly: bool = False) -> DataFrame:
    """Window averages, then one row per station/period (the rn = 1 row).

    All rows of a period carry the same averages, so averaging them and keeping
    the first is the grouped aggregate: one exchange, no join of the raw rows.
    """
    return to_wide(obs, opts, trunc_year("date") if yearly else F.col("date"))


def row_number_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """``row_number() over (partition by keys order by order) = 1``, skew-safe.

    Orders go through a struct, which Spark compares field by field in the given
    order: each key null last, then a hash of the row, so that the pick is the
    same in every run.
    """
    parts = [x for i, o in enumerate(order) for c in [o if isinstance(o, Column) else F.col(o)]
             for x in (c.isNull().alias(f"n{i}"), c.alias(f"v{i}"))]
    return keep_first(df.withColumn("_rn_order", F.struct(*parts, F.xxhash64(*df.columns).alias("tie"))), keys, "_rn_order")

"""Long (one row per element) to wide (one column per measure)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteora.functions.scalar import measure_value
from meteora.options import TransformOptions
from meteora.schemas import ELEMENTS, MEASURES


def measure_columns(opts: TransformOptions) -> dict[str, "F.Column"]:
    """One conditional column per measure; other elements give null in all."""
    return {m: measure_value("element", "value", e, opts) for e, m in zip(ELEMENTS, MEASURES)}


def explode_elements(obs: DataFrame, opts: TransformOptions, keep: tuple[str, ...] = ()) -> DataFrame:
    """id, date, tmax..snwd, m_flag, s_flag (+ ``keep``) for every raw row."""
    cols = measure_columns(opts)
    return obs.select(
        "id", "date", *[cols[m].alias(m) for m in MEASURES], "m_flag", "s_flag", *keep
    )


def element_measure(opts: TransformOptions) -> "F.Column":
    """The scaled (and clipped) value of whichever measure the row carries."""
    cols = measure_columns(opts)
    return F.coalesce(*[cols[m] for m in MEASURES])


def pivot_native(obs: DataFrame, opts: TransformOptions, keys: tuple[str, ...] = ("id", "date")) -> DataFrame:
    """Same averages through ``pivot`` with the element list given up front.

    Giving the values avoids the extra job Spark would run to find them, and
    groups holding only other elements still give a row of nulls.  Spark plans
    a pivot as two aggregates (by key and element, then by key), so two
    shuffles; ``to_daily`` writes the same pivot as conditional aggregates in
    one.  This form is kept for users of the pivot API and as a cross-check.
    """
    wide = (
        obs.withColumn("_measure", element_measure(opts))
        .groupBy(*keys)
        .pivot("element", list(ELEMENTS))
        .agg(F.avg("_measure"))
    )
    return wide.withColumnsRenamed(dict(zip(ELEMENTS, MEASURES)))

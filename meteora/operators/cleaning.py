"""Row cleaning: flag normalisation and the quality filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteora.options import TransformOptions
from meteora.schemas import FLAG_COLUMNS


def normalize_flags(obs: DataFrame) -> DataFrame:
    """Absent flags are the empty string, never null (CSV readers give null)."""
    present = [c for c in FLAG_COLUMNS if c in obs.columns]
    return obs.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in present})


def passed_quality() -> "F.Column":
    """Predicate of a row whose quality flag is empty (it passed every check)."""
    # Written as an OR of two simple predicates so it reaches the Parquet scan.
    return F.col("q_flag").isNull() | (F.col("q_flag") == F.lit(""))


def drop_flagged(obs: DataFrame) -> DataFrame:
    """Keep rows that passed quality control; pushed into the Parquet scan."""
    return obs.where(passed_quality())


def clean(obs: DataFrame, opts: TransformOptions) -> DataFrame:
    return drop_flagged(obs) if opts.drop_flagged else obs

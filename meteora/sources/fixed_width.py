"""Fixed-width text readers (station and country lists)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteora.schemas import COUNTRY_LAYOUT, STATION_LAYOUT


def slice_columns(layout) -> list:
    """Trimmed slices; empty text becomes null; numbers use try_cast, so a
    short line or blank field gives null instead of an error."""
    cols = []
    for name, pos, length, kind in layout:
        text = F.trim(F.substring(F.col("value"), pos, length))
        text = F.when(text != F.lit(""), text)
        cols.append((text if kind == "string" else text.try_cast(kind)).alias(name))
    return cols


def read_fixed_width(spark: SparkSession, paths: str | Iterable[str], layout) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.text(paths).select(*slice_columns(layout))


def read_stations(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    return read_fixed_width(spark, paths, STATION_LAYOUT)


def read_countries(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    return read_fixed_width(spark, paths, COUNTRY_LAYOUT)

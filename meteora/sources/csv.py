"""CSV readers.

Yearly observation files are headerless CSV with a fixed column order, either
plain (splittable) or gzip-compressed (``.csv.gz``, one task per file).
"""

from __future__ import annotations

from typing import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteora.functions.scalar import parse_date
from meteora.operators.cleaning import normalize_flags
from meteora.schemas import OBS_CSV_SCHEMA, OBS_SCHEMA
from meteora.sources.tables import path_exists

CSV_SUFFIXES = (".csv", ".csv.gz")
# exactly these endings: a checksum or a note beside a file is no observation
CSV_GLOB = "*.{csv,csv.gz}"


def _paths(paths: str | Iterable[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def check_csv_paths(paths: list[str]) -> None:
    """Only CSV inputs are accepted; anything else is an error, not a skip."""
    bad = [p for p in paths if not p.rstrip("/*").endswith(CSV_SUFFIXES) and "." in p.rstrip("/").rsplit("/", 1)[-1]]
    if bad:
        raise ValueError(f"only CSV sources are accepted (.csv or .csv.gz): {bad}")


def year_files(spark: SparkSession, base: str, start: int, end: int) -> list[str]:
    """The CSV of each year, plain or gzip.  A year without a file is an error, and so
    is one with both: its rows would count twice."""
    out = []
    for y in range(start, end + 1):
        there = [p for p in (f"{base.rstrip('/')}/{y}{x}" for x in CSV_SUFFIXES) if path_exists(spark, p)]
        if len(there) != 1:
            raise ValueError(f"year {y} under {base}: " + ("no file" if not there else f"both {there[0]} and {there[1]}"))
        out += there
    return out


def read_observations_csv(spark: SparkSession, paths: str | Iterable[str], file_column: str | None = None) -> DataFrame:
    """Headerless observation CSV -> typed observations.

    Columns: id, date (DATE from yyyyMMdd), element, value (long), m_flag,
    q_flag, s_flag ('' when absent) and obs_time (short, null when absent).
    A directory reads every ``*.csv`` / ``*.csv.gz`` file in it.  A field that does
    not parse, or a line with another number of fields, ends the read with an error.
    ``file_column`` names a further column with each row's file.
    """
    paths = _paths(paths)
    check_csv_paths(paths)
    try:
        raw = (
            spark.read.schema(OBS_CSV_SCHEMA)
            .option("header", False)
            .option("mode", "FAILFAST")
            .option("columnPruning", False)  # else a short line passes when few columns are read
            .option("pathGlobFilter", CSV_GLOB)
            .csv(paths)
        )
    except AnalysisException as exc:  # PATH_NOT_FOUND: a year file is missing
        raise ValueError(f"observation files not found: {exc}") from exc
    names = [f.name for f in OBS_SCHEMA.fields]
    if file_column:
        raw = raw.withColumn(file_column, F.col("_metadata.file_path"))
        names.append(file_column)
    return normalize_flags(raw.withColumn("date", parse_date("date"))).select(*names)


def read_csv_inferred(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Headered CSV with column types inferred from the data.

    Inference needs a pass over the data before the real read; use it for
    small files (the dimension tables), give a schema for big ones.
    """
    paths = _paths(paths)
    check_csv_paths(paths)
    return spark.read.option("header", True).option("inferSchema", True).option("pathGlobFilter", CSV_GLOB).csv(paths)


def read_csv_with_schema(spark: SparkSession, paths: str | Iterable[str], schema, header: bool = True) -> DataFrame:
    paths = _paths(paths)
    check_csv_paths(paths)
    return spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").option("pathGlobFilter", CSV_GLOB).csv(paths)


__all__ = ["read_observations_csv", "read_csv_inferred", "read_csv_with_schema", "check_csv_paths", "year_files"]

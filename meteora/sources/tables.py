"""Parquet, year-partitioned and catalog sources."""

from __future__ import annotations

from datetime import date
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_table(spark: SparkSession, fmt: str, path: str | None = None, **options) -> DataFrame:
    """Any data source by format name and options (a warehouse connector,
    ``parquet``, ``orc``, ...)."""
    reader = spark.read.format(fmt).options(**{k: str(v) for k, v in options.items()})
    return reader.load(path) if path is not None else reader.load()


def named_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view registered in the session catalog."""
    return spark.table(name)


def external_table(spark: SparkSession, name: str, path: str, source: str = "parquet") -> DataFrame:
    """Register files as an external catalog table and return it."""
    spark.catalog.createTable(name, path=path, source=source)
    return spark.table(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a file or folder; the new place must be free."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    src, dst = hadoop(old), hadoop(new)
    fs = src.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(dst) or not fs.rename(src, dst):
        raise OSError(f"{old} could not be moved to {new}")


def child_paths(spark: SparkSession, path: str) -> list[str]:
    """Everything directly below a folder, in order of name; nothing for a missing one."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in fs.listStatus(p)) if fs.exists(p) else []


def year_paths(base: str, start: int, end: int, column: str = "year") -> list[str]:
    if end < start:
        raise ValueError(f"empty year range {start}..{end}")
    return [f"{base.rstrip('/')}/{column}={y}" for y in range(start, end + 1)]


def read_years(spark: SparkSession, base: str, start: int, end: int, column: str = "year") -> DataFrame:
    """Years ``start..end`` (inclusive) of a table partitioned by ``column``.

    Only those partition folders are listed and read.  A folder of one
    ``<year>.parquet`` per year is read the same way.  A missing year is an
    error naming the range, not a silently shorter result.
    """
    paths = year_paths(base, start, end, column)
    files = [f"{base.rstrip('/')}/{y}.parquet" for y in range(start, end + 1)]
    if path_exists(spark, files[0]) and not path_exists(spark, paths[0]):
        missing = [f for f in files if not path_exists(spark, f)]
        if missing:
            raise ValueError(f"years {start}..{end} not all present: no {missing}")
        return spark.read.parquet(*files)
    try:
        return spark.read.option("basePath", base).parquet(*paths)
    except AnalysisException as exc:  # PATH_NOT_FOUND
        raise ValueError(f"years {start}..{end} not all present under {base}: {exc}") from exc


def between_dates(df: DataFrame, start: date | str, end: date | str, date_col: str = "date",
                  year_col: str | None = "year") -> DataFrame:
    """Rows with ``start <= date <= end``.

    A predicate on the date alone does not prune ``year=`` folders, so the
    matching year range is added when the table has a year column.
    """
    s, e = F.to_date(F.lit(str(start))), F.to_date(F.lit(str(end)))
    out = df.where(F.col(date_col).between(s, e))
    if year_col and year_col in df.columns:
        out = out.where(F.col(year_col).between(int(str(start)[:4]), int(str(end)[:4])))
    return out


__all__ = ["read_parquet", "read_table", "named_table", "external_table", "read_years", "between_dates", "year_paths"]

"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteora.schemas import OBS_CSV_COLUMNS, OBS_PARQUET_COLUMNS


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_csv_quoted(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headered CSV with every field in double quotes."""
    df.write.mode(mode).option("header", True).option("quoteAll", True).csv(path)


def write_observations_csv(obs: DataFrame, path: str, compression: str | None = None, mode: str = "overwrite",
                           partition_by: list[str] = ()) -> None:
    """Observations in the yearly headerless CSV layout (date as yyyyMMdd); columns of
    ``partition_by`` become folders."""
    out = obs.select(
        *[F.date_format("date", "yyyyMMdd").alias("date") if c == "date" else F.col(c) for c in OBS_CSV_COLUMNS], *partition_by
    )
    writer = out.write.mode(mode).option("header", False)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)


def write_year_files(obs: DataFrame, path: str, kind: str, csv_compression: dict[int, str] | None = None) -> list[int]:
    """One ``<year>.csv`` or ``<year>.parquet`` per year below ``path``; returns the years.

    The observations are read once: they are written partitioned by year, then each
    year's folder is moved to its name.  ``csv_compression`` names the codec of years whose CSV
    is compressed, at one more write for each codec.  Rows without a date have no year and are not written.
    """
    from meteora.sources.tables import child_paths, rename

    spark, codecs = obs.sparkSession, csv_compression or {}
    dated = obs.withColumn("_year", F.year("date")).where("_year IS NOT NULL")
    years = []
    for n, codec in enumerate([None, *sorted(set(codecs.values()))]):
        with_codec = [y for y, c in codecs.items() if c == codec]
        rows = dated.where(F.col("_year").isin(with_codec)) if codec else dated.where(~F.col("_year").isin(list(codecs)))
        parted = f"{path.rstrip('/')}/_parts{n}"
        if kind == "csv":
            write_observations_csv(rows, parted, codec, partition_by=["_year"])
        else:
            rows.write.partitionBy("_year").parquet(parted)
        for folder in child_paths(spark, parted):
            name = folder.rsplit("/", 1)[1]
            if name.startswith("_year="):
                rename(spark, folder, f"{path.rstrip('/')}/{name[6:]}.{kind}")
                years.append(int(name[6:]))
    return sorted(years)


def parquet_layout(obs: DataFrame) -> DataFrame:
    """Observation columns in the converted Parquet order (date last) plus a
    ``year`` partition column."""
    return obs.select(*OBS_PARQUET_COLUMNS).withColumn("year", F.year("date"))


def convert_observations(obs: DataFrame, path: str, mode: str = "overwrite", dynamic: bool = False, years=None) -> None:
    """Ingest conversion: typed observations -> Parquet, one folder per year.

    One read of the raw files and no shuffle: a task reads part of one
    year's file, sorts its rows by (year, id, date) and writes them into that
    year's folder, so files are sorted by station and day (row groups skip
    on id).  See ``write_sorted`` for why no range repartition is used here.
    ``dynamic`` replaces only the years present in ``obs`` (a refresh); with
    ``years`` a row of another year, or without a date, is an error.
    """
    from meteora.sinks.tables import only_years, refuse_streamed, write_sorted

    if dynamic:
        refuse_streamed(obs.sparkSession, path)
    rows = parquet_layout(obs)
    write_sorted(rows if years is None else only_years(rows, years), path, ["year"], ["id", "date"], mode=mode, dynamic=dynamic)

"""Partitioned and clustered table writes.

Layout: a ``year`` partition column and rows sorted by the cluster keys
inside each file, so scans prune folders by year and skip row groups by
Parquet min/max statistics on the cluster keys.  Rows are range-partitioned
on (partition keys, cluster keys) before the write: a big year is split over
many tasks by its cluster keys, and each task writes few folders.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteora.sources.tables import path_exists


def _layout(df: DataFrame, partition_by: list[str], cluster_by: list[str], num_files: int | None) -> DataFrame:
    keys = [*partition_by, *cluster_by]
    if not keys:
        return df
    # A hash of the whole row as last range key: rows sharing one hot key value
    # are spread over several tasks (range bounds can then fall inside that
    # value), deterministically, so a retried task writes the same rows.
    tie = F.xxhash64(*df.columns).alias("_tie")
    with_tie = df.withColumn("_tie", tie)
    ranged = with_tie.repartitionByRange(num_files, *keys, "_tie") if num_files else \
        with_tie.repartitionByRange(*keys, "_tie")
    return ranged.sortWithinPartitions(*keys).drop("_tie")


def _by_folder(df: DataFrame, partition_by: list[str], cluster_by: list[str] = ()) -> DataFrame:
    """A rebalance by the partition keys: one read and one shuffle, hot partitions are
    split and small ones joined, files sorted; a range layout would sample the input first."""
    return df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *cluster_by)


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], cluster_by: list[str] = (),
                      mode: str = "overwrite", num_files: int | None = None, dynamic: bool = False) -> None:
    """Write ``df`` as Parquet partitioned by ``partition_by`` and sorted by
    ``cluster_by`` inside each file.  ``dynamic`` replaces only the partitions
    present in ``df`` (with mode overwrite)."""
    writer = _layout(df, list(partition_by), list(cluster_by), num_files).write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def write_sorted(df: DataFrame, path: str, partition_by: list[str], sort_by: list[str] = (),
                 mode: str = "overwrite", dynamic: bool = False, options: dict[str, str] | None = None) -> None:
    """Partitioned Parquet write without a shuffle: every task sorts its own
    rows by (partition keys, ``sort_by``) and writes them.

    For input whose tasks already hold one partition value each (yearly
    source files: a task reads part of one year's file), this gives sorted
    files in few folders per task from a single read.  A range repartition
    would first run a sampling job over the whole input, i.e. read and parse
    the raw files twice (and a gzip file is one task, so the slowest task
    twice).  Input spread over all partition values (e.g. an aggregate's
    output) belongs in ``write_partitioned``, which bounds the files per task.
    """
    keys = [*partition_by, *sort_by]
    writer = (df.sortWithinPartitions(*keys) if keys else df).write.mode(mode).options(**(options or {}))
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def write_clustered(df: DataFrame, path: str, cluster_by: list[str], mode: str = "overwrite",
                    num_files: int | None = None) -> None:
    """Unpartitioned Parquet, range-clustered by ``cluster_by``."""
    _layout(df, [], list(cluster_by), num_files).write.mode(mode).parquet(path)


def with_year(fact: DataFrame, date_col: str = "date") -> DataFrame:
    return fact if "year" in fact.columns else fact.withColumn("year", F.year(date_col))


def write_fact_daily(fact: DataFrame, path: str, mode: str = "overwrite", num_files: int | None = None) -> None:
    """Daily fact: partitioned by year, clustered by country and station."""
    write_partitioned(with_year(fact), path, ["year"], ["country_code", "id"], mode, num_files)


def write_fact_yearly(fact: DataFrame, path: str, mode: str = "overwrite", num_files: int | None = None) -> None:
    """Yearly fact: partitioned by year, clustered by country and station."""
    write_partitioned(with_year(fact), path, ["year"], ["country_code", "id"], mode, num_files)


def only_years(df: DataFrame, years: Iterable[int], column: str = "year") -> DataFrame:
    """``df``, in which a row of another year (or of none) is an error when it is read."""
    asked = sorted(set(years))
    what = F.concat(F.lit(f"a row outside of the years {asked}: "), F.coalesce(F.col(column).cast("string"), F.lit("no date")))
    return df.withColumn(column, F.when(F.col(column).isin(asked), F.col(column)).otherwise(F.raise_error(what).cast("int")))


def refuse_streamed(spark, path: str) -> None:
    """A table that a stream appends to keeps a log of its files, and can't be read
    any more once a batch job replaces some of them."""
    log = f"{path.rstrip('/')}/_spark_metadata"
    if path_exists(spark, log):
        raise ValueError(f"{path} is written by a stream; refresh a table of its own")


def refresh_partitions(df: DataFrame, path: str, partition_by: list[str], cluster_by: list[str] = (),
                       years: Iterable[int] | None = None) -> None:
    """Replace only the partitions present in ``df`` (e.g. the current year),
    leaving the others untouched; re-running it does not duplicate rows.

    With ``years`` a row of another year fails the job before anything is replaced.
    """
    refuse_streamed(df.sparkSession, path)
    if years is not None:
        df = only_years(df, years)
    write_partitioned(df, path, partition_by, cluster_by, mode="overwrite", dynamic=True)


def write_table(df: DataFrame, fmt: str, mode: str = "append", path: str | None = None, **options) -> None:
    """Write to any data source by format name and options (a warehouse connector,
    ``parquet``, ``orc``, ...); the twin of ``sources.tables.read_table``."""
    writer = df.write.format(fmt).mode(mode).options(**{k: str(v) for k, v in options.items()})
    writer.save(path) if path is not None else writer.save()


def write_years(frames: Iterable[DataFrame], path: str, partition_by: list[str] = ("year",),
                cluster_by: list[str] = ()) -> None:
    """First relation overwrites the table, the following ones append."""
    for i, df in enumerate(frames):
        write_partitioned(df, path, list(partition_by), list(cluster_by), mode="overwrite" if i == 0 else "append")


def create_or_replace_table(df: DataFrame, name: str, path: str | None = None, partition_by: list[str] = (),
                            cluster_by: list[str] = (), fmt: str = "parquet") -> DataFrame:
    """CREATE OR REPLACE TABLE name AS SELECT ...; returns the new table."""
    if partition_by:
        laid = _by_folder(df, partition_by, cluster_by)
    else:
        laid = _layout(df, [], list(cluster_by), None)
    writer = laid.write.mode("overwrite").format(fmt)
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def conform(df: DataFrame, schema) -> DataFrame:
    """Columns of ``schema``, in its order, cast to its types (a typed table)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def create_typed_table(df: DataFrame, name: str, schema, path: str | None = None) -> DataFrame:
    """DROP + CREATE a table with a fixed schema, filled from ``df``."""
    return create_or_replace_table(conform(df, schema), name, path)


def append_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Append to a catalog table, creating it on the first call.

    Re-running an append loads the rows again; use ``refresh_partitions``
    for a load that must replace what it wrote before.
    """
    writer = df.write.mode("append").format(fmt)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)

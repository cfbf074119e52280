"""Hash-bucketed tables: clustered storage that the next read can use.

A table bucketed by station holds all rows of a station in one bucket of every year, so aggregates by
(station, period) and joins on the station read it without an exchange: the shuffle is paid once, when the table
is written.  Rows are dealt by the bucket columns before the write, so a task writes one file of its
bucket per partition folder, sorted by the bucket columns.

A bucket is read by one task, so its rows bound the memory of that task: ``plan_buckets`` counts the rows and takes
as many buckets as hold ``BUCKET_ROWS`` each.  It measures the largest key as well: where one station would
make its bucket many times larger than the others, the table is bucketed by (station, date), which keeps the daily
aggregate free of an exchange and deals the station's days over all buckets.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteora.sinks.tables import only_years

#: A bucket may be this many times the average one.
MOST = 4.0
#: Rows of a bucket, of all partitions together.  Sorting and aggregating a row takes up to 450 bytes of a task.
BUCKET_ROWS = 1 << 18


def buckets_for(table_bytes: int, bucket_bytes: int = 1 << 30, least: int = 8) -> int:
    """Number of buckets whose files of all partitions together hold about ``bucket_bytes``."""
    return max(least, -(-table_bytes // bucket_bytes))


def bucket_keys(df: DataFrame, keys: list[str], spread: list[str], buckets: int, most: float = MOST) -> list[str]:
    """``keys``, or ``spread`` when the rows of the largest key are ``most`` times an average bucket."""
    largest, total = _counts(df, keys)
    return list(spread) if largest > most * total / buckets else list(keys)


def plan_buckets(df: DataFrame, keys: list[str], spread: list[str], least: int = 8, bucket_rows: int | None = None,
                 most: float = MOST) -> tuple[list[str], int]:
    """The bucket columns (as ``bucket_keys``) and the number of buckets, which grows with the rows.

    Past Spark's own bound on buckets (``spark.sql.sources.bucketing.maxBuckets``) they get larger.
    """
    largest, total = _counts(df, keys)
    bound = int(df.sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    buckets = min(bound, max(least, -(-total // (bucket_rows or BUCKET_ROWS))))
    return list(spread) if largest > most * total / buckets else list(keys), buckets


def _counts(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """Rows of the largest key and of all; one row comes back."""
    counts = df.groupBy(*keys).count()
    r = counts.agg(F.max("count").alias("largest"), F.sum("count").alias("total")).first()
    return r["largest"] or 0, r["total"] or 0


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Rows that come from a table of the same buckets need no shuffle, and then are read bucket by bucket only without
#: this; else a task would get whatever files make up a split, of many buckets.
_AUTO_SCAN = "spark.sql.sources.bucketing.autoBucketedScan.enabled"


def create_bucketed_table(df: DataFrame, name: str, path: str, bucket_by: list[str], buckets: int,
                          sort_by: list[str] = (), partition_by: list[str] = ()) -> DataFrame:
    """CREATE TABLE ... PARTITIONED BY ... CLUSTERED BY ... SORTED BY ... INTO n BUCKETS AS SELECT ...

    A bucket column that is null puts its rows in a bucket like any other value.
    """
    writer = df.repartition(buckets, *bucket_by).write.mode("overwrite").format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by, *[c for c in sort_by if c not in bucket_by])
    with _setting(df.sparkSession, _AUTO_SCAN, "false"):
        writer.saveAsTable(name)
    return df.sparkSession.table(name)


def bucketing(spark: SparkSession, name: str) -> tuple[list[str], int]:
    """The bucket columns of a table and their number of buckets."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}  # a few rows
    if "Num Buckets" not in rows:
        raise ValueError(f"{name} is not bucketed")
    return [c.strip(" `") for c in rows["Bucket Columns"].strip("[]").split(",")], int(rows["Num Buckets"])


def refresh_bucketed(df: DataFrame, name: str, years: Iterable[int]) -> None:
    """Replace the year folders of a bucketed table; a row of another year fails the job."""
    spark = df.sparkSession
    by, buckets = bucketing(spark, name)
    rows = only_years(df, years).select(*spark.table(name).columns).repartition(buckets, *by)
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"), _setting(spark, _AUTO_SCAN, "false"):
        rows.write.insertInto(name, overwrite=True)

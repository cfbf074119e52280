"""Joins with a size check in front of every broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only up to this many bytes of values.  The station list has about
# 160 thousand rows of about 100 bytes.
MAX_BROADCAST_BYTES = 128 << 20
# Row and object overhead of a hashed row, on top of its values.
ROW_OVERHEAD = 64


def row_bytes(df: DataFrame):
    """Bytes of a row's values, with a row's overhead."""
    width = F.lit(ROW_OVERHEAD).cast("long")
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        width = width + (F.coalesce(F.octet_length(c), F.lit(0)) if kind in ("string", "binary") else F.lit(16))
    return width


# Sizes measured in this process, by what was measured.
_MEASURED: dict[tuple, int] = {}


def _measured_key(df: DataFrame) -> tuple | None:
    """What a size holds for: the plan, and path, length and modification time of every
    file it reads.  None when some of the input is not a set of files."""
    spark, plan = df.sparkSession, df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation" or leaf.relation().getClass().getSimpleName() != "HadoopFsRelation":
            return None
    files = []
    for f in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        files.append((f, status.getLen(), status.getModificationTime()))
    return spark.sparkContext.applicationId, plan.canonicalized().toString(), tuple(sorted(files))


def measured_bytes(frames: list[DataFrame]) -> list[int]:
    """Sizes of several frames in one job.

    The sums combine in the tasks; one number per frame comes back.  A frame that reads files alone is
    measured once for each state of them, and anew when a file has another length or time.
    """
    keys = [_measured_key(f) for f in frames]
    todo = [i for i, k in enumerate(keys) if k is None or k not in _MEASURED]
    found = {}
    if todo:
        parts = [frames[i].select(F.lit(i).alias("_side"), row_bytes(frames[i]).alias("_bytes")) for i in todo]
        sums = reduce(DataFrame.unionByName, parts).groupBy("_side").agg(F.sum("_bytes").alias("n"))
        found = dict.fromkeys(todo, 0) | {r["_side"]: r["n"] for r in sums.collect()}
        _MEASURED.update({keys[i]: n for i, n in found.items() if keys[i] is not None})
    return [found[i] if i in found else _MEASURED[keys[i]] for i in range(len(frames))]


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    return measured_bytes([df])[0] <= max_bytes


def checked_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when it passes the size check; otherwise ``df`` as is,
    which leaves a shuffle join (and AQE's runtime choice) to Spark."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df

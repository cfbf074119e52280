"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every plan in this package is written for.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcasts need a proven size.  The static planner's choice rests on an
    # estimate from compressed file sizes, so it is off; AQE still turns a
    # shuffle join into a broadcast when the finished stage measured at most
    # this much.  Explicit broadcasts (dimensions) pass a row-count check.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # The two-level aggregate map puts a small fast map in front of the main
    # one; station/day keys are mostly distinct within a task, so the first
    # level mostly misses.  Measured 20-25% faster without it (daily and yearly).
    "spark.sql.codegen.aggregate.map.twolevel.enabled": "false",
    # PySpark records the Python call site of every column function for error
    # messages, at several JVM round trips per call.  Building one fact plan
    # makes a few hundred such calls: off, plan building on the driver took
    # 0.06-0.2 s instead of 0.3-0.6 s per query.  Errors still name the
    # failing expression, only without the Python line.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "meteora",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "8g",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def unset_base_conf(submitted) -> dict[str, str]:
    """The ``BASE_CONF`` settings that the submitted configuration (a
    ``SparkConf``) does not set: ``--conf`` wins."""
    return {k: v for k, v in BASE_CONF.items() if not submitted.contains(k)}


def base_session(app: str) -> SparkSession:
    """The session of a submitted job (``spark-submit``): the base settings the
    submitter did not set are given to the builder before the session exists,
    so the static ones (the UI, PySpark's call-site capture) apply too."""
    from pyspark import SparkConf

    builder = SparkSession.builder.appName(app)
    for k, v in unset_base_conf(SparkConf()).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20, combined_share: float = 0.1) -> dict[str, str]:
    """Settings sized for a large input (e.g. 100 TB on a thousand executors).

    Shuffle partitions are sized so each holds about ``target_partition_bytes`` of
    what is left after the map-side combine (``combined_share`` of the input: the
    rows of a station and day become one) before AQE coalesces the small ones.
    Scans are split at 1 GB.  The driver keeps one map status per map task, with an entry per
    reducer: for 100 TB 102,400 map tasks times 40,960 reducers are 4.2e9 blocks, whose
    statuses (compressed above 2,000 reducers to an average and the large ones) take
    about 102,400 x 5 KB = 0.5 GB of the driver.
    """
    parts = max(200, int(input_bytes * combined_share // target_partition_bytes))
    conf = dict(BASE_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(1 << 30),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        # coalesce small shuffle partitions up to the advisory size, not only to
        # 1 MB: a small stage (the yearly roll-up, a fact write) then runs few
        # tasks of useful size and writes few, large files
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.files.maxRecordsPerFile": "50000000",
        # fact tables are stored for years: zstd wrote the sf0.1 daily fact 10%
        # smaller than snappy in the same time
        "spark.sql.parquet.compression.codec": "zstd",
    })
    return conf


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder (``spark.checkpoint.dir``).

    It is read from the session.  Only a local session without one gets a
    fresh folder; a cluster session must name a shared folder itself.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(base)
        return base
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    base = tempfile.mkdtemp(prefix="meteora-ckpt-")
    spark.conf.set("spark.checkpoint.dir", base)
    spark.sparkContext.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/meteora/{name}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


_UNITS = {"K": 1 << 10, "M": 1 << 20, "G": 1 << 30, "T": 1 << 40, "P": 1 << 50}


def parse_size(text: str) -> int:
    """'100T', '750G', '123456' -> bytes."""
    t = text.strip().upper().rstrip("B")
    if t and t[-1] in _UNITS:
        return int(float(t[:-1]) * _UNITS[t[-1]])
    return int(t)


def submit_flags(input_bytes: int) -> str:
    """``cluster_conf`` as ``--conf`` flags for spark-submit.  The folder in
    ``spark.checkpoint.dir`` must still be given (a shared one)."""
    return " ".join(f"--conf {k}={v}" for k, v in cluster_conf(input_bytes).items())


__all__ = ["local_session", "base_session", "cluster_conf", "ensure_checkpoint_dir", "scratch_path", "unique_name"]


if __name__ == "__main__":
    # python -m meteora.session 100T  ->  --conf flags sized for that input
    import sys

    print(submit_flags(parse_size(sys.argv[1])))

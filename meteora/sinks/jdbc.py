"""Relational-database sink through Spark's JDBC writer.

Each task writes its own partition in batches of ``batchsize`` rows, so the
load is parallel; ``numPartitions`` caps concurrent connections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

MODES = ("append", "overwrite", "ignore", "error", "errorifexists")


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 batchsize: int = 1000, num_partitions: int | None = None, truncate: bool = False,
                 create_table_column_types: str | None = None) -> dict[str, str]:
    if not url.startswith("jdbc:"):
        raise ValueError(f"not a JDBC url: {url!r}")
    if batchsize < 1:
        raise ValueError("batchsize must be positive")
    opts = {"url": url, "dbtable": table, "batchsize": str(batchsize)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if num_partitions is not None:
        opts["numPartitions"] = str(num_partitions)
    if truncate:
        opts["truncate"] = "true"
    if create_table_column_types:
        opts["createTableColumnTypes"] = create_table_column_types
    return opts


def write_jdbc(df: DataFrame, mode: str = "append", **kwargs) -> None:
    """Append (the ingestion default) or replace a database table."""
    if mode not in MODES:
        raise ValueError(f"unknown save mode {mode!r}")
    df.write.format("jdbc").options(**jdbc_options(**kwargs)).mode(mode).save()

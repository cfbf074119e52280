"""Tables with membership filters: a station's rows found without reading the rest.

A fact kept in order of date has every country in every row group, so the minimum and
maximum of ``id`` exclude none of them.  A Parquet Bloom filter for each row group tells which
ones cannot hold a station; the reader asks it for predicates of equality.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from meteora.sinks.tables import write_sorted


def membership_options(columns: list[str], distinct: int, row_group_bytes: int | None = None) -> dict[str, str]:
    """Parquet writer options for Bloom filters on ``columns``, for about ``distinct`` values in a
    row group.  A column that is dictionary-encoded throughout would get none, so these are not."""
    if distinct < 1:
        raise ValueError("distinct must be positive")
    options = {}
    for c in columns:
        options[f"parquet.bloom.filter.enabled#{c}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{c}"] = str(distinct)
        options[f"parquet.enable.dictionary#{c}"] = "false"
    if row_group_bytes is not None:
        options["parquet.block.size"] = str(row_group_bytes)
    return options


def write_with_membership(df: DataFrame, path: str, columns: list[str], distinct: int, partition_by: list[str] = (),
                          sort_by: list[str] = (), mode: str = "overwrite", row_group_bytes: int | None = None) -> None:
    """``write_sorted`` with membership filters on ``columns``: every task sorts and writes its own rows."""
    write_sorted(df, path, list(partition_by), list(sort_by), mode,
                 options=membership_options(columns, distinct, row_group_bytes))

"""Writers: files, catalog tables, partitioned fact tables, JDBC options."""

from meteora.sinks.files import write_csv_quoted, write_observations_csv, write_parquet
from meteora.sinks.jdbc import jdbc_options, write_jdbc
from meteora.sinks.tables import (
    create_or_replace_table,
    refresh_partitions,
    write_clustered,
    write_fact_daily,
    write_fact_yearly,
    write_partitioned,
    write_sorted,
    write_years,
)

__all__ = [
    "write_csv_quoted", "write_observations_csv", "write_parquet", "jdbc_options", "write_jdbc",
    "create_or_replace_table", "refresh_partitions", "write_clustered", "write_fact_daily", "write_fact_yearly",
    "write_partitioned", "write_sorted", "write_years",
]

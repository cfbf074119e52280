"""Readers: headerless and headered CSV, fixed-width text, Parquet, tables."""

from meteora.sources.csv import read_csv_inferred, read_observations_csv
from meteora.sources.fixed_width import read_countries, read_fixed_width, read_stations
from meteora.sources.tables import (
    between_dates,
    external_table,
    named_table,
    read_parquet,
    read_table,
    read_years,
)

__all__ = [
    "read_csv_inferred", "read_observations_csv", "read_countries", "read_fixed_width", "read_stations",
    "between_dates", "external_table", "named_table", "read_parquet", "read_table", "read_years",
]

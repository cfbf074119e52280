"""Column expressions built only from pyspark.sql.functions (JVM side)."""

from meteora.functions.scalar import (
    cast_numeric,
    clip_raw,
    country_code,
    extract_year,
    format_year,
    int_div,
    int_to_date,
    measure_value,
    parse_date,
    quote_join,
    scale,
    trunc_year,
    trunc_year_ts,
)

__all__ = [
    "cast_numeric", "clip_raw", "country_code", "extract_year", "format_year", "int_div",
    "int_to_date", "measure_value", "parse_date", "quote_join", "scale", "trunc_year", "trunc_year_ts",
]

"""Schemas, fixed-width layouts and column lists of the observation data."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

# ---------------------------------------------------------------------------
# Fixed values of the daily observation format (public dataset description).
# They must stay exactly as written for results to match.
# ---------------------------------------------------------------------------

# Elements that become measure columns, and the column each one feeds.
ELEMENTS = ("TMAX", "TMIN", "PRCP", "SNOW", "SNWD")
MEASURES = ("tmax", "tmin", "prcp", "snow", "snwd")
# Elements measured in tenths (of degrees C or of mm).
TENTHS_ELEMENTS = ("TMAX", "TMIN", "PRCP")
# Elements whose raw value is nulled outside [-CLIP_RAW, CLIP_RAW].
CLIPPED_ELEMENTS = ("TMAX", "TMIN")
CLIP_RAW = 700

# Column order of the headerless yearly CSV files.
OBS_CSV_COLUMNS = ("id", "date", "element", "value", "m_flag", "q_flag", "s_flag", "obs_time")
# Column order after conversion to Parquet (date moved last).
OBS_PARQUET_COLUMNS = ("id", "element", "value", "m_flag", "q_flag", "s_flag", "obs_time", "date")
FLAG_COLUMNS = ("m_flag", "q_flag", "s_flag")

# Stations text file: (column, 1-based start, length, type).
STATION_LAYOUT = (
    ("id", 1, 11, "string"),
    ("latitude", 13, 8, "double"),
    ("longitude", 22, 9, "double"),
    ("elevation", 32, 6, "double"),
    ("state", 39, 2, "string"),
    ("name", 42, 30, "string"),
    ("gsn_flag", 73, 3, "string"),
    ("hcn_crn_flag", 77, 3, "string"),
    ("wmo_id", 81, 5, "string"),
)

# Countries text file.
COUNTRY_LAYOUT = (
    ("code", 1, 2, "string"),
    ("name", 4, 47, "string"),
)

# Fact column order of the SQL models (daily and yearly are the same).
FACT_COLUMNS = (
    "id", "date", "tmax", "tmin", "prcp", "snow", "snwd", "m_flag", "s_flag",
    "station_name", "latitude", "longitude", "elevation", "country_code", "country_name",
)
# Fact column order written by the batch job variant.
JOB_FACT_COLUMNS = (
    "id", "date", "tmax", "tmin", "prcp", "snow", "snwd", "m_flag", "s_flag",
    "latitude", "longitude", "elevation", "station_name", "country_code", "country_name",
)
# Station columns the fact tables do not carry.
STATION_DROPPED = ("state", "gsn_flag", "hcn_crn_flag", "wmo_id")

# ---------------------------------------------------------------------------

OBS_CSV_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("date", StringType()),
        StructField("element", StringType()),
        StructField("value", LongType()),
        StructField("m_flag", StringType()),
        StructField("q_flag", StringType()),
        StructField("s_flag", StringType()),
        StructField("obs_time", ShortType()),
    ]
)

OBS_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("date", DateType()),
        StructField("element", StringType()),
        StructField("value", LongType()),
        StructField("m_flag", StringType()),
        StructField("q_flag", StringType()),
        StructField("s_flag", StringType()),
        StructField("obs_time", ShortType()),
    ]
)

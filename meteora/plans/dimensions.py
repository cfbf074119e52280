"""Station and country dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteora.functions.scalar import country_code
from meteora.operators.join import MAX_BROADCAST_BYTES, measured_bytes
from meteora.schemas import STATION_DROPPED


def stations_view(raw: DataFrame) -> DataFrame:
    """All station columns plus ``country_code`` (first two characters of id)."""
    if "country_code" in raw.columns:
        return raw
    return raw.withColumn("country_code", country_code("id"))


def stations_dim(raw: DataFrame) -> DataFrame:
    """Station columns the facts carry: id, latitude, longitude, elevation,
    station_name, country_code."""
    kept = stations_view(raw).drop(*STATION_DROPPED).withColumnsRenamed({"name": "station_name"})
    return kept.select("id", "latitude", "longitude", "elevation", "station_name", "country_code")


def countries_view(raw: DataFrame) -> DataFrame:
    return raw.select("code", "name")


def countries_dim(raw: DataFrame) -> DataFrame:
    return countries_view(raw).withColumnsRenamed({"name": "country_name"})


def station_country(stations_raw: DataFrame, countries_raw: DataFrame,
                    max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Stations with their country name (snowflake flattened).

    Inner join: a station whose country code is not listed disappears, as it
    does from the facts.  Joining the two small dimensions first leaves one
    hash lookup per fact row instead of two.
    """
    return checked_station_country(stations_raw, countries_raw, max_broadcast_bytes)[0]


def checked_station_country(stations_raw: DataFrame, countries_raw: DataFrame,
                            max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """The flattened station dimension and whether it may be broadcast.

    One small job measures the countries and the joined stations; each side is
    broadcast only when its size is within the bound.
    """
    st, co = stations_dim(stations_raw), countries_dim(countries_raw)

    def joined(co_side: DataFrame) -> DataFrame:
        return st.join(co_side, st["country_code"] == co_side["code"], "inner").drop("code")

    n_co, n_joined = measured_bytes([co, joined(co)])
    dim = joined(F.broadcast(co) if n_co <= max_broadcast_bytes else co)
    return dim, n_joined <= max_broadcast_bytes

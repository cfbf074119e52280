"""The analytic questions asked of the facts.

* maximum daily temperature of a country in a year
* yearly comparison of two places (mean daily minimum temperature)
* hottest days at a place
* record counts per year

Place predicates are written on the station dimension's columns, so a
question about one place can also be given to the fact builders
(``facts.fact_daily(..., stations_where=place)``), which then aggregate only
that place's observations.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteora.operators.join import checked_broadcast
from meteora.operators.limit import top_k
from meteora.sinks.tables import with_year

#: Most stations of a place that a scan is given as equalities.
MOST_STATIONS = 64


def in_country(name: str) -> Column:
    """Place predicate: every station of a country (by country name)."""
    return F.col("country_name") == F.lit(name)


def station_named(pattern: str) -> Column:
    """Place predicate: stations whose name matches a SQL LIKE pattern,
    case-insensitively (e.g. '%MADRID%')."""
    return F.upper(F.col("station_name")).like(pattern.upper())


def any_place(places: dict[str, Column]) -> Column:
    """Predicate of a station belonging to at least one of ``places``."""
    if not places:
        raise ValueError("no place given")
    return reduce(operator.or_, places.values())


def at_place(fact: DataFrame, stations: DataFrame, place: Column) -> DataFrame:
    """Rows of a stored fact at a place, found through the station dimension.

    ``place`` is a predicate on the dimension's columns (``stations`` is the
    flattened station dimension: id, station_name, country_code, ...).  The
    matching stations meet the fact in a semi join on the station id, broadcast after
    a size check; nothing else of the dimension has to agree with the fact.
    """
    return fact.join(checked_broadcast(stations.where(place).select("id")), "id", "left_semi")


def at_few_stations(fact: DataFrame, stations: DataFrame, place: Column, most: int = MOST_STATIONS) -> DataFrame:
    """``at_place`` for a place of at most ``most`` stations, as equalities that reach the scan.

    Their ids (no more than ``most`` + 1 come to the driver) become a balanced
    disjunction of ``id = ...``, which Parquet answers from row-group statistics and, on a
    table of ``sinks.membership``, from Bloom filters.  A larger place takes the semi join; the rows are the same.
    """
    ids = [r[0] for r in stations.where(place & F.col("id").isNotNull()).select("id").distinct().limit(most + 1).collect()]
    if len(ids) > most:
        return at_place(fact, stations, place)
    tests = [F.col("id") == F.lit(i) for i in sorted(ids)]
    while len(tests) > 1:
        tests = [reduce(operator.or_, tests[i:i + 2]) for i in range(0, len(tests), 2)]
    return fact.where(tests[0] if tests else F.lit(False))


def max_by_country_year(fact: DataFrame, country: str | None = None, year: int | None = None,
                        measure: str = "tmax") -> DataFrame:
    """Maximum of ``measure`` per country and year (optionally one of each).

    On a stored fact the ``year`` partition column is used as it is, so a
    year filter reads only that year's folder and the country filter reaches
    the Parquet scan (files are sorted by country, row groups are skipped).
    """
    rows = with_year(fact)
    if country is not None:
        rows = rows.where(F.col("country_name") == country)
    if year is not None:
        rows = rows.where(F.col("year") == year)
    return rows.groupBy("country_code", "country_name", "year").agg(F.max(measure).alias(f"max_{measure}"))


def compare_yearly(fact: DataFrame, places: dict[str, Column], measure: str = "tmin") -> DataFrame:
    """Mean of ``measure`` per year for each named place, side by side.

    ``places`` maps an output column to a predicate (a country, a station
    name pattern, ...).  Rows matching no place are dropped before the
    aggregate, and the places are pivoted with their names given up front.
    A year where a place has no value gets null for it.
    """
    if not places:
        raise ValueError("compare_yearly needs at least one place")
    label = F.lit(None).cast("string")
    for name, pred in reversed(list(places.items())):
        label = F.when(pred, F.lit(name)).otherwise(label)
    rows = with_year(fact).select("year", label.alias("_place"), F.col(measure)).where(
        F.col("_place").isNotNull()
    )
    return rows.groupBy("year").pivot("_place", list(places)).agg(F.avg(measure))


def top_hottest(fact: DataFrame, place: Column | None = None, k: int = 10, measure: str = "tmax") -> DataFrame:
    """The ``k`` days with the highest ``measure`` at a place; ties by date, id."""
    rows = fact.where(F.col(measure).isNotNull())
    if place is not None:
        rows = rows.where(place)
    return top_k(rows, k, [F.col(measure).desc(), F.col("date").asc(), F.col("id").asc()])


def record_counts(fact: DataFrame) -> DataFrame:
    """Number of fact rows per year."""
    return with_year(fact).groupBy("year").agg(F.count(F.lit(1)).alias("n_records"))

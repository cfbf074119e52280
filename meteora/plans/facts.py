"""Fact tables: wide observations enriched with station and country data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteora.operators.aggregate import daily_parts, finish_parts, roll_up_parts, to_daily, to_yearly, year_start
from meteora.operators.cleaning import clean
from meteora.operators.join import MAX_BROADCAST_BYTES, fits_broadcast
from meteora.operators.limit import sample_rows
from meteora.options import CANONICAL, TransformOptions
from meteora.plans.dimensions import checked_station_country
from meteora.schemas import FACT_COLUMNS, JOB_FACT_COLUMNS


def fact_columns(opts: TransformOptions) -> tuple[str, ...]:
    return JOB_FACT_COLUMNS if opts.column_order == "job" else FACT_COLUMNS


def _dimension(stations_raw: DataFrame, countries_raw: DataFrame, where: Column | None,
               max_broadcast_bytes: int) -> tuple[DataFrame, bool]:
    """The flattened station dimension (restricted by ``where``) and whether
    it passed the broadcast size check.  A restricted dimension is measured
    again when the whole one is too big: one place may still be small."""
    dim, small = checked_station_country(stations_raw, countries_raw, max_broadcast_bytes)
    if where is None:
        return dim, small
    dim = dim.where(where)
    return dim, small or fits_broadcast(dim, max_broadcast_bytes)


def _join_dim(wide: DataFrame, dim: DataFrame, small: bool, columns: tuple[str, ...]) -> DataFrame:
    return wide.join(F.broadcast(dim) if small else dim, "id", "inner").select(*columns)


def restrict_to_stations(obs: DataFrame, dim: DataFrame, small: bool) -> DataFrame:
    """Observations of the stations in ``dim`` only, before any aggregate.

    A fact restricted to some stations (one country, a station name) equals
    the aggregate of those stations' observations joined with them, because
    the aggregate groups by station.  So the observations are cut first, by a
    broadcast left-semi join on ``id``, and the aggregate and its shuffle only
    see the rows that can reach the result.  The broadcast side is the
    restricted dimension, after it passed the size check; when it did not,
    the observations are left whole (a semi join would then need a shuffle of
    the raw rows) and the inner join after the aggregate restricts.
    """
    return obs.join(F.broadcast(dim.select("id")), "id", "left_semi") if small else obs


def enrich(wide: DataFrame, stations_raw: DataFrame, countries_raw: DataFrame,
           columns: tuple[str, ...] = FACT_COLUMNS, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
           stations_where: Column | None = None) -> DataFrame:
    """Join wide rows with their station and country; rows without either go.

    The flattened station dimension is broadcast after a size check;
    above the bound the join is left to a shuffle (or AQE's runtime choice).
    The aggregate is computed before the join, so only one row per
    station/period meets the dimension.  ``stations_where`` (a predicate on
    the dimension's columns) keeps only the matching stations.
    """
    dim, small = _dimension(stations_raw, countries_raw, stations_where, max_broadcast_bytes)
    return _join_dim(wide, dim, small, columns)


def _fact(obs: DataFrame, stations_raw: DataFrame, countries_raw: DataFrame, opts: TransformOptions,
          stations_where: Column | None, transform, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    dim, small = _dimension(stations_raw, countries_raw, stations_where, max_broadcast_bytes)
    if stations_where is not None:
        obs = restrict_to_stations(obs, dim, small)
    return _join_dim(transform(obs, opts), dim, small, fact_columns(opts))


# Days (or years) of a station are told apart by their number modulo this.
_RESIDUES = 256


def _enough_stations(obs: DataFrame, dim: DataFrame, small: bool, opts: TransformOptions, n: int, yearly: bool) -> str | None:
    """The last station that the first ``n`` fact rows by station can reach, or None for all.

    Every station has at least as many rows as its days (years) have residues; one pass with a few longs
    per station counts those, and the first ``n`` stations come back at most.
    """
    period = F.year("date") if yearly else F.unix_date("date")
    rows = clean(restrict_to_stations(obs, dim, small), opts).select("id", F.pmod(period, F.lit(_RESIDUES)).alias("r"))
    seen = [F.bit_or(F.when(F.floor(F.col("r") / 64) == i, F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("r") % 64).cast("int")))
                     .otherwise(F.lit(0).cast("long"))).alias(f"s{i}") for i in range(_RESIDUES // 64)]
    least = F.greatest(sum((F.bit_count(f"s{i}") for i in range(_RESIDUES // 64)), F.lit(0)), F.lit(1))
    by_station = rows.where("id IS NOT NULL").groupBy("id").agg(*seen).select("id", least.alias("least"))
    if not small:
        by_station = by_station.join(dim.select("id"), "id", "left_semi")
    total = 0
    for r in by_station.orderBy("id").limit(n).collect():
        total += r["least"]
        if total >= n:
            return r["id"]
    return None


def first_fact_rows(obs: DataFrame, stations_raw: DataFrame, countries_raw: DataFrame, opts: TransformOptions,
                    n: int, yearly: bool = False) -> DataFrame:
    """The first ``n`` rows of the daily (or yearly) fact by (id, date): a trial
    run is the ordered limit of the whole fact, at every scale.

    Only the stations those rows can belong to are aggregated; the bound on the station id
    reaches the scan, which skips what files sorted by station hold of others.
    """
    dim, small = _dimension(stations_raw, countries_raw, None, MAX_BROADCAST_BYTES)
    last = _enough_stations(obs, dim, small, opts, n, yearly) if n else None
    if last is not None:
        obs = obs.where(F.col("id") <= last)
    fact = (fact_yearly if yearly else fact_daily)(obs, stations_raw, countries_raw, opts)
    return sample_rows(fact, n, ["id", "date"])


def fact_daily(obs: DataFrame, stations_raw: DataFrame, countries_raw: DataFrame,
               opts: TransformOptions = CANONICAL, stations_where: Column | None = None) -> DataFrame:
    """Daily fact; ``stations_where`` restricts it to the stations matching a
    predicate on station or country columns (e.g. ``country_name = 'FRANCE'``),
    and the restriction is applied before the aggregate."""
    return _fact(obs, stations_raw, countries_raw, opts, stations_where, to_daily)


def fact_yearly(obs: DataFrame, stations_raw: DataFrame, countries_raw: DataFrame,
                opts: TransformOptions = CANONICAL, stations_where: Column | None = None) -> DataFrame:
    """Yearly fact; ``stations_where`` as in ``fact_daily``."""
    return _fact(obs, stations_raw, countries_raw, opts, stations_where, to_yearly)


def both_facts(obs: DataFrame, stations_raw: DataFrame, countries_raw: DataFrame, opts: TransformOptions,
               parts_path: str) -> tuple[DataFrame, DataFrame]:
    """Daily and yearly facts from one scan of the raw observations.

    The daily partial aggregates are written once to ``parts_path`` (a folder
    every executor can read, e.g. below spark.checkpoint.dir).  That cuts the
    lineage: a lost executor re-reads the written partials instead of
    re-running the raw aggregation, and the yearly fact reads the partials
    (a fraction of the raw rows) instead of scanning the raw data again.
    """
    daily_parts(obs, opts).write.mode("overwrite").parquet(parts_path)
    parts = obs.sparkSession.read.parquet(parts_path)
    columns = fact_columns(opts)
    daily = enrich(finish_parts(parts, opts), stations_raw, countries_raw, columns)
    yearly = enrich(finish_parts(roll_up_parts(parts, year_start(opts)), opts), stations_raw, countries_raw, columns)
    return daily, yearly

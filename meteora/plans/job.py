"""Batch job: observations of a year range -> daily and yearly fact tables.

    spark-submit meteora/plans/job.py START_YEAR END_YEAR \\
        --observations gs://bucket/obs  --stations .../ghcnd-stations.txt \\
        --countries .../ghcnd-countries.txt  --daily-out ... --yearly-out ...

Observations are either a Parquet table partitioned by ``year`` (default) or
a folder of yearly headerless CSV files (``--observations-format csv``,
files ``<year>.csv`` or ``<year>.csv.gz``).  All years are read in one plan,
not one job per year.  ``--refresh`` replaces only the years written (the
daily run over the current year); otherwise the fact tables are replaced.
With ``--store FOLDER`` both facts go into one versioned store (``sinks.store``) and
change in one commit: a run that dies leaves the facts as they were.
"""

from __future__ import annotations

import argparse
import os
import sys
from dataclasses import replace

if __package__ in (None, ""):
    # Run as a script (spark-submit meteora/plans/job.py ...): the package
    # root must be importable on the driver.  Executors never import it, since
    # every expression is a built-in (JVM-side) function.
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from meteora.operators.limit import sample_rows  # noqa: E402
from meteora.options import CANONICAL, JOB, LOCAL  # noqa: E402
from meteora.plans.facts import both_facts  # noqa: E402
from meteora.session import base_session, ensure_checkpoint_dir  # noqa: E402
from meteora.sinks.store import Store  # noqa: E402
from meteora.sinks.tables import refresh_partitions, with_year, write_clustered, write_fact_daily, write_fact_yearly  # noqa: E402
from meteora.sources.csv import read_observations_csv, year_files  # noqa: E402
from meteora.sources.fixed_width import read_countries, read_stations  # noqa: E402
from meteora.sources.tables import between_dates, named_table, read_years  # noqa: E402

VARIANTS = {"canonical": CANONICAL, "local": LOCAL, "job": JOB}


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="meteora-job", description=__doc__.split("\n\n")[0])
    p.add_argument("start_year", type=int)
    p.add_argument("end_year", type=int)
    p.add_argument("--observations", required=True)
    p.add_argument("--observations-format", choices=("parquet", "csv", "table"), default="parquet",
                   help="year= folders or <year>.parquet files, yearly CSV files, or a catalog table")
    p.add_argument("--stations", required=True, help="fixed-width text, or Parquet with --dims-format parquet")
    p.add_argument("--countries", required=True)
    p.add_argument("--dims-format", choices=("text", "parquet"), default="text")
    p.add_argument("--daily-out")
    p.add_argument("--yearly-out")
    p.add_argument("--store", default=None, help="versioned store for both facts, in place of the two folders")
    p.add_argument("--variant", choices=sorted(VARIANTS), default="canonical")
    p.add_argument("--order-by", nargs="*", default=None, help="columns ordering rows when flags are picked")
    p.add_argument("--refresh", action="store_true", help="replace only the years written")
    p.add_argument("--sample-rows", type=int, default=None,
                   help="trial run: first N fact rows by id, date, into <out>_trial; stored facts stay as they are")
    p.add_argument("--yearly-layout", choices=("year", "clustered"), default="year",
                   help="yearly fact: year= folders, or unpartitioned and clustered by date and country")
    a = p.parse_args(argv)
    if not a.store and not (a.daily_out and a.yearly_out):
        p.error("give --daily-out and --yearly-out, or --store")
    if a.store and (a.sample_rows is not None or a.yearly_layout == "clustered"):
        p.error("--store holds whole facts in year folders: leave out --sample-rows and --yearly-layout clustered")
    if a.refresh and a.sample_rows is not None:
        p.error("a trial run (--sample-rows) replaces nothing: leave out --refresh")
    if a.refresh and a.yearly_layout == "clustered":
        p.error("--refresh needs the yearly fact in year= folders")
    if a.end_year < a.start_year:
        p.error("end_year is before start_year")
    return a


def read_observations(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if a.observations_format == "parquet":
        return read_years(spark, a.observations, a.start_year, a.end_year)
    if a.observations_format == "table":
        return between_dates(named_table(spark, a.observations), f"{a.start_year}-01-01", f"{a.end_year}-12-31")
    return read_observations_csv(spark, year_files(spark, a.observations, a.start_year, a.end_year))


def read_dims(spark: SparkSession, a: argparse.Namespace) -> tuple[DataFrame, DataFrame]:
    if a.dims_format == "parquet":
        return spark.read.parquet(a.stations), spark.read.parquet(a.countries)
    return read_stations(spark, a.stations), read_countries(spark, a.countries)


def parts_path(spark: SparkSession, a: argparse.Namespace) -> str:
    """Folder of the run's daily partials, below the shared checkpoint folder.

    One fixed folder per kind of run, variant and year range, replaced by every run: the
    daily refresh of the current year reuses its folder instead of leaving one
    behind per day.  Two runs over the same years and variant must therefore
    not run at the same time (a scheduler runs them one after the other).
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    kind = "full" if a.sample_rows is None else "trial"
    return f"{base}/meteora/daily_parts-{kind}-{a.variant}-{a.start_year}-{a.end_year}"


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    ensure_checkpoint_dir(spark)
    opts = VARIANTS[a.variant]
    if a.order_by:
        opts = replace(opts, order_by=tuple(a.order_by))
    obs = read_observations(spark, a)
    stations, countries = read_dims(spark, a)
    daily, yearly = both_facts(obs, stations, countries, opts, parts_path(spark, a))
    if a.sample_rows is not None:
        daily = sample_rows(daily, a.sample_rows, ["id", "date"])
        yearly = sample_rows(yearly, a.sample_rows, ["id", "date"])
    if a.store:
        change = Store(spark, a.store).begin()
        for name, fact in (("fact_daily", daily), ("fact_yearly", yearly)):
            keys = [f"year={y}" for y in range(a.start_year, a.end_year + 1)] if a.refresh and name in change.tables else None
            change.write(name, with_year(fact), ["year"], ["country_code", "id"], keys=keys)
        change.commit()
        return
    if a.refresh:
        years = range(a.start_year, a.end_year + 1)
        refresh_partitions(with_year(daily), a.daily_out, ["year"], ["country_code", "id"], years)
        refresh_partitions(with_year(yearly), a.yearly_out, ["year"], ["country_code", "id"], years)
        return
    trial = "" if a.sample_rows is None else "_trial"
    write_fact_daily(daily, a.daily_out.rstrip("/") + trial)
    if a.yearly_layout == "clustered":
        write_clustered(yearly, a.yearly_out.rstrip("/") + trial, ["date", "country_code"])
    else:
        write_fact_yearly(yearly, a.yearly_out.rstrip("/") + trial)


def main(argv: list[str] | None = None) -> None:
    a = parse_args(sys.argv[1:] if argv is None else argv)
    run(base_session("meteora-facts"), a)


if __name__ == "__main__":
    main()

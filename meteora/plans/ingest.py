"""Ingest jobs: raw files -> Parquet tables the batch job reads.

    spark-submit meteora/plans/ingest.py observations START_YEAR END_YEAR \\
        --csv <folder of <year>.csv or <year>.csv.gz>  --out <table path>  [--refresh]
    spark-submit meteora/plans/ingest.py dimensions \\
        --stations ghcnd-stations.txt --countries ghcnd-countries.txt --out <folder>

Observations: without ``--refresh`` the table is replaced by the years read
(a backfill).  With it, only those years' folders are replaced (dynamic
partition overwrite), which is the daily re-ingest of the current year:
running it again replaces the year again and never duplicates rows.

Dimensions: the fixed-width station and country lists become typed Parquet
tables ``<out>/stations`` and ``<out>/countries`` (the job's
``--dims-format parquet``).

    spark-submit meteora/plans/ingest.py stream --source <landing folder> \\
        --out <table path> --checkpoint <folder kept between runs>

Stream: every CSV file that landed since the last run is appended to the
table, exactly once (Structured Streaming file source, ``availableNow``).
The checkpoint remembers which files were taken, so it must persist.

    spark-submit meteora/plans/ingest.py ledger --source <landing folder> --out <store path>

Ledger: every file that is new or was published again is loaded into the versioned store, in
one commit with the note that it is loaded (``sinks.ledger``); nothing is loaded twice.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    # run as a script: make the package importable on the driver
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

from meteora.session import base_session  # noqa: E402
from meteora.sinks import ledger  # noqa: E402
from meteora.sinks.files import convert_observations, write_parquet  # noqa: E402
from meteora.sources.csv import read_observations_csv, year_files  # noqa: E402
from meteora.sources.fixed_width import read_countries, read_stations  # noqa: E402
from meteora.streaming.ingest import ingest_available  # noqa: E402


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="meteora-ingest", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="what", required=True)
    o = sub.add_parser("observations", help="yearly CSV files -> table partitioned by year")
    o.add_argument("start_year", type=int)
    o.add_argument("end_year", type=int)
    o.add_argument("--csv", required=True, help="folder holding <year>.csv or <year>.csv.gz")
    o.add_argument("--out", required=True, help="Parquet table partitioned by year")
    o.add_argument("--refresh", action="store_true", help="replace only the years read")
    d = sub.add_parser("dimensions", help="fixed-width station and country lists -> Parquet tables")
    d.add_argument("--stations", required=True)
    d.add_argument("--countries", required=True)
    d.add_argument("--out", required=True, help="folder for the stations and countries tables")
    st = sub.add_parser("stream", help="append newly landed CSV files, exactly once")
    st.add_argument("--source", required=True, help="landing folder (or glob) of the CSV files")
    st.add_argument("--out", required=True, help="Parquet table partitioned by year")
    st.add_argument("--checkpoint", required=True, help="folder that remembers the files taken; keep it")
    st.add_argument("--max-files-per-trigger", type=int, default=None)
    le = sub.add_parser("ledger", help="load new and re-published CSV files into a versioned store")
    le.add_argument("--source", required=True, help="landing folder of the CSV files")
    le.add_argument("--out", required=True, help="folder of the store")
    a = p.parse_args(argv)
    if a.what == "observations" and a.end_year < a.start_year:
        p.error("end_year is before start_year")
    return a


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.what == "stream":
        ingest_available(spark, a.source, a.out, a.checkpoint, a.max_files_per_trigger)
        return
    if a.what == "ledger":
        done = ledger.load(spark, a.source, a.out)
        print(", ".join(f"{len(names)} {what}" for what, names in done.items()))
        return
    if a.what == "dimensions":
        out = a.out.rstrip("/")
        write_parquet(read_stations(spark, a.stations), f"{out}/stations")
        write_parquet(read_countries(spark, a.countries), f"{out}/countries")
        return
    base = a.csv.rstrip("/")
    obs = read_observations_csv(spark, year_files(spark, base, a.start_year, a.end_year))
    convert_observations(obs, a.out, mode="overwrite", dynamic=a.refresh, years=range(a.start_year, a.end_year + 1))


def main(argv: list[str] | None = None) -> None:
    a = parse_args(sys.argv[1:] if argv is None else argv)
    run(base_session("meteora-ingest"), a)


if __name__ == "__main__":
    main()

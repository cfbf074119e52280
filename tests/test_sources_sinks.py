"""Readers and writers: edge cases and write -> read round trips."""

from __future__ import annotations

import gzip
import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from meteora.sinks import jdbc
from meteora.sinks.tables import refresh_partitions, write_partitioned, write_years
from meteora.sources.csv import read_csv_inferred, read_observations_csv
from meteora.sources.fixed_width import read_countries, read_stations
from meteora.sources.tables import between_dates, read_years

# Station lines laid out by the published column positions.
STATIONS = [
    "ACW00011604  17.1167  -61.7833   10.1    ST JOHNS COOLIDGE FLD                       ",
    "AE000041196  25.3330   55.5170   34.0    SHARJAH INTER. AIRP            GSN     41196",
    "AG000060390  36.7167    3.2500   24.0    ALGER-DAR EL BEIDA, TOWN       GSN     01234",
    "US1AKAB0015  61.3770 -149.6030  120.4 AK ANCHORAGE 5.3 NW",
]
COUNTRIES = ["AC Antigua and Barbuda                            ", "AE United Arab Emirates"]


def test_fixed_width_stations(spark, tmp_path):
    (tmp_path / "stations.txt").write_text("\n".join(STATIONS) + "\n")
    rows = {r["id"]: r for r in read_stations(spark, str(tmp_path / "stations.txt")).collect()}
    a = rows["ACW00011604"]
    assert a["latitude"] == pytest.approx(17.1167) and a["longitude"] == pytest.approx(-61.7833)
    assert a["state"] is None and a["gsn_flag"] is None and a["wmo_id"] is None
    assert a["name"] == "ST JOHNS COOLIDGE FLD"
    assert rows["AG000060390"]["name"] == "ALGER-DAR EL BEIDA, TOWN"
    assert rows["AG000060390"]["wmo_id"] == "01234"  # leading zero kept
    short = rows["US1AKAB0015"]  # line ends before the flag columns
    assert short["state"] == "AK" and short["elevation"] == pytest.approx(120.4)
    assert short["gsn_flag"] is None and short["wmo_id"] is None


def test_fixed_width_countries(spark, tmp_path):
    (tmp_path / "countries.txt").write_text("\n".join(COUNTRIES) + "\n")
    rows = dict((r["code"], r["name"]) for r in read_countries(spark, str(tmp_path / "countries.txt")).collect())
    assert rows == {"AC": "Antigua and Barbuda", "AE": "United Arab Emirates"}


def test_non_csv_source_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        read_observations_csv(spark, str(tmp_path / "2020.parquet"))
    with pytest.raises(ValueError):
        read_csv_inferred(spark, str(tmp_path / "stations.txt"))


def test_gzip_csv(spark, tmp_path):
    with gzip.open(tmp_path / "1788.csv.gz", "wt") as f:
        f.write("AA000000001,17880101,TMAX,-12,,,E,\nAA000000001,17880102,PRCP,0,P,,E,0700\n")
    rows = read_observations_csv(spark, str(tmp_path)).orderBy("date").collect()
    assert [r["value"] for r in rows] == [-12, 0]
    assert rows[1]["m_flag"] == "P" and rows[0]["q_flag"] == ""


def _obs_years(spark):
    return spark.createDataFrame(
        [(f"S{i % 3}", f"{y}-0{1 + i % 9}-15", y, i) for y in (2019, 2020, 2021) for i in range(6)],
        "id string, d string, year int, v int",
    ).withColumn("date", F.to_date("d")).drop("d")


def test_year_range_and_missing_year(spark, scratch):
    path = scratch("years")
    write_partitioned(_obs_years(spark), path, ["year"], ["id", "date"])
    got = read_years(spark, path, 2020, 2021)
    assert sorted({r["year"] for r in got.collect()}) == [2020, 2021]
    assert got.count() == 12
    with pytest.raises(ValueError):
        read_years(spark, path, 2018, 2020).count()


def test_between_dates_prunes_year_folders(spark, scratch):
    path = scratch("years_prune")
    write_partitioned(_obs_years(spark), path, ["year"], ["id"])
    df = between_dates(spark.read.parquet(path), "2020-01-01", "2020-12-31")
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(year" in plan and "2020" in plan
    assert df.count() == 6


def test_refresh_replaces_only_its_partition(spark, scratch):
    path = scratch("refresh")
    obs = _obs_years(spark)
    write_partitioned(obs.where("year < 2021 or v < 3"), path, ["year"], ["id"])
    for _ in range(2):  # repeated refresh: no duplicates
        refresh_partitions(obs.where("year = 2021"), path, ["year"], ["id"])
    back = spark.read.parquet(path)
    assert back.count() == 18
    assert back.groupBy("year").count().orderBy("year").collect()[2]["count"] == 6


def test_overwrite_then_append(spark, scratch):
    path = scratch("append")
    obs = _obs_years(spark)
    write_years([obs.where("year = 2019"), obs.where("year = 2020"), obs.where("year = 2021")], path)
    assert spark.read.parquet(path).count() == 18
    write_years([obs.where("year = 2019")], path)  # first write overwrites
    assert spark.read.parquet(path).count() == 6


def test_jdbc_options():
    o = jdbc.jdbc_options("jdbc:postgresql://db:5432/obs", "stations", user="u", password="p", batchsize=1000,
                          num_partitions=8, truncate=True)
    assert o == {"url": "jdbc:postgresql://db:5432/obs", "dbtable": "stations", "batchsize": "1000", "user": "u",
                 "password": "p", "numPartitions": "8", "truncate": "true"}
    with pytest.raises(ValueError):
        jdbc.jdbc_options("postgresql://db", "t")
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x:y", "t", batchsize=0)


def test_ingest_conversion_sorted_files_one_folder_per_year(spark, scratch):
    import glob

    import pyarrow.parquet as pq

    from meteora.plans.catalog import OBS_COLS
    from meteora.plans.testmap import DriverTables
    from meteora.session import local_path
    from meteora.sinks.files import convert_observations, write_observations_csv

    from paths import SF_SMALL

    obs = DriverTables(spark, SF_SMALL).lineitem_obs()
    src, out = scratch("ingest_src"), scratch("ingest_out")
    # one CSV folder per year, as the yearly source files
    for y in (1995, 1996, 1997):
        write_observations_csv(obs.where(F.year("date") == y), f"{src}/{y}")
    convert_observations(read_observations_csv(spark, f"{src}/*"), out)
    back = spark.read.parquet(out)
    want = obs.where(F.year("date").between(1995, 1997)).select(*OBS_COLS)
    assert sorted(back.select(*OBS_COLS).collect()) == sorted(want.collect())
    folders = sorted(p.rsplit("/", 1)[-1] for p in glob.glob(local_path(out) + "/year=*"))
    assert folders == ["year=1995", "year=1996", "year=1997"]
    # date is the last column (converted layout); every file is sorted by id, date
    for f in glob.glob(local_path(out) + "/year=*/*.parquet"):
        t = pq.ParquetFile(f).read()  # the file alone (no column from the folder name)
        assert t.column_names[-1] == "date"
        keys = list(zip(t.column("id").to_pylist(), t.column("date").to_pylist()))
        assert keys == sorted(keys)


def test_hot_cluster_key_is_spread_over_write_tasks(spark, scratch):
    """A third of the rows share one (year, id): the row-hash tie-break lets
    the range bounds fall inside that key, so several tasks write it."""
    import glob

    import pyarrow.parquet as pq

    from meteora.session import local_path

    rows = spark.range(0, 30000).select(
        F.lit(2020).alias("year"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(
            F.concat(F.lit("S"), F.lpad((F.col("id") % 1000).cast("string"), 4, "0"))).alias("id"),
        F.col("id").alias("v"),
    )
    path = scratch("hot_write")
    write_partitioned(rows, path, ["year"], ["id"], num_files=6)
    files = glob.glob(local_path(path) + "/year=2020/*.parquet")
    with_hot = [f for f in files if "HOT" in set(pq.ParquetFile(f).read(columns=["id"]).column("id").to_pylist())]
    assert len(with_hot) >= 2
    back = spark.read.parquet(path)
    assert back.count() == 30000 and back.where(F.col("id") == "HOT").count() == 10000


@pytest.mark.parametrize("name, folder", [("src_year_files", "year_files"), ("src_csv_strict", "strict_csv")])
def test_every_year_has_its_file(spark, tmp_path, monkeypatch, name, folder):
    import re

    from meteora.plans import catalog

    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: str(tmp_path / name))
    sf = "/root/testdata/sf0.001"
    read = getattr(catalog, name)(spark, sf)
    years = {r[0] for r in catalog._t(spark, sf).lineitem_obs().selectExpr("year(date)").where("date is not null").distinct().collect()}
    assert len(years) > 3
    assert {int(p.name[:4]) for p in (tmp_path / folder).iterdir() if re.fullmatch(r"\d{4}\.(parquet|csv|csv\.gz)", p.name)} == years
    read_years = {r[0] for r in read.selectExpr("year(date)").distinct().collect()}
    assert read_years == (years if name == "src_csv_strict" else {1996, 1997, 1998})  # strict reading has no range

"""What must end in an error, or leave stored data as it is."""

from __future__ import annotations

import os

import pytest

from paths import SF_SMALL
from meteora.plans import job
from meteora.plans.testmap import DriverTables
from meteora.sinks.files import convert_observations, write_observations_csv
from meteora.sinks.tables import refresh_partitions, write_partitioned, write_table
from meteora.sources.csv import read_observations_csv, year_files
from meteora.sources.tables import read_table, read_years
from pyspark.sql import functions as F

GOOD = "USW00094728,20200101,TMAX,10,,,S,0700\n"


def _file(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)
    return f"file:{folder}/{name}"


@pytest.mark.parametrize("line", ["USW00094728,20200102,TMAX,abc,,,S,0700\n", "USW00094728,20200102,TMAX\n"])
def test_malformed_line_ends_the_read(spark, tmp_path, line):
    path = _file(tmp_path, "2020.csv", GOOD + line)
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_observations_csv(spark, path).select("id", "value").collect()


def test_files_that_only_look_like_csv_are_not_read(spark, tmp_path):
    _file(tmp_path, "2020.csv", GOOD)
    _file(tmp_path, "2020.csv.md5", "d41d8cd98f00b204e9800998ecf8427e\n")
    assert read_observations_csv(spark, f"file:{tmp_path}").count() == 1
    assert [p.rsplit("/", 1)[1] for p in year_files(spark, f"file:{tmp_path}", 2020, 2020)] == ["2020.csv"]


def test_both_forms_of_a_year_and_no_form_are_errors(spark, tmp_path):
    _file(tmp_path, "2020.csv", GOOD)
    _file(tmp_path, "2020.csv.gz", "")
    with pytest.raises(ValueError, match="both"):
        year_files(spark, f"file:{tmp_path}", 2020, 2020)
    with pytest.raises(ValueError, match="no file"):
        year_files(spark, f"file:{tmp_path}", 2021, 2021)


def _obs(spark):
    return DriverTables(spark, SF_SMALL).lineitem_obs().withColumn("year", F.year("date"))


def test_refresh_refuses_rows_of_other_years_and_without_date(spark, scratch):
    path = scratch("refresh")
    obs = _obs(spark)
    write_partitioned(obs, path, ["year"], ["id"])
    before = dict(spark.read.parquet(path).groupBy("year").count().collect())
    for stray in (obs.where("year = 2000").limit(1), obs.limit(1).withColumn("year", F.lit(None).cast("int"))):
        with pytest.raises(Exception, match="outside of the years"):
            refresh_partitions(obs.where("year = 2001").unionByName(stray), path, ["year"], ["id"], years=[2001])
        assert dict(spark.read.parquet(path).groupBy("year").count().collect()) == before
    refresh_partitions(obs.where("year = 2001"), path, ["year"], ["id"], years=[2001])
    assert dict(spark.read.parquet(path).groupBy("year").count().collect()) == before


def test_a_streamed_table_is_not_refreshed(spark, scratch):
    from meteora.streaming import ingest_available

    src, out = scratch("landing"), scratch("streamed")
    write_observations_csv(_obs(spark).where("year = 1996"), src)
    ingest_available(spark, src, out, scratch("ckpt"))
    n = spark.read.parquet(out).count()
    with pytest.raises(ValueError, match="stream"):
        convert_observations(_obs(spark).where("year = 1996"), out, dynamic=True)
    assert spark.read.parquet(out).count() == n > 0


def _job(spark, scratch, *extra, start=1995, end=1996):
    t = DriverTables(spark, SF_SMALL)
    base = scratch("job")
    write_partitioned(_obs(spark), f"{base}/obs", ["year"], ["id", "date"])
    t.supplier_stations().write.parquet(f"{base}/st")
    t.countries().write.parquet(f"{base}/co")

    def run(*extra):
        job.run(spark, job.parse_args([str(start), str(end), "--observations", f"{base}/obs", "--stations", f"{base}/st", "--countries", f"{base}/co",
                                       "--dims-format", "parquet", "--daily-out", f"{base}/daily", "--yearly-out", f"{base}/yearly", *extra]))
    return base, run


def test_a_trial_run_leaves_the_stored_facts(spark, scratch):
    base, run = _job(spark, scratch)
    run()
    daily, yearly = spark.read.parquet(f"{base}/daily").count(), spark.read.parquet(f"{base}/yearly").count()
    run("--sample-rows", "25")
    assert spark.read.parquet(f"{base}/daily").count() == daily and spark.read.parquet(f"{base}/yearly").count() == yearly
    assert spark.read.parquet(f"{base}/daily_trial").count() == 25
    with pytest.raises(SystemExit):
        run("--sample-rows", "25", "--refresh")


def test_clustered_yearly_layout_and_a_catalog_table(spark, scratch):
    base, run = _job(spark, scratch)
    run()
    want = spark.read.parquet(f"{base}/yearly").drop("year")
    spark.read.parquet(f"{base}/obs").createOrReplaceTempView("job_obs_table")
    run("--observations", "job_obs_table", "--observations-format", "table", "--yearly-layout", "clustered", "--yearly-out", f"{base}/clustered")
    got = spark.read.parquet(f"{base}/clustered")
    assert got.count() == want.count() and got.select(*want.columns).exceptAll(want).count() == 0 and "year" not in got.columns


def test_both_facts_in_one_store(spark, scratch):
    from meteora.sinks.store import Store

    base, run = _job(spark, scratch)
    run()
    daily, yearly = (spark.read.parquet(f"{base}/{x}") for x in ("daily", "yearly"))
    run("--store", f"{base}/store")
    run("--store", f"{base}/store", "--refresh")
    store = Store(spark, f"{base}/store")
    assert store.versions() == [1, 2]
    for name, want in (("fact_daily", daily), ("fact_yearly", yearly)):
        got = store.read(name).select(*want.columns)
        assert got.count() == want.count() > 0 and got.select("id", "date", "year", "m_flag").exceptAll(want.select("id", "date", "year", "m_flag")).count() == 0
    with pytest.raises(SystemExit):
        run("--store", f"{base}/store", "--sample-rows", "5")


def test_ledger_from_the_command_line(spark, tmp_path, scratch, capsys):
    from meteora.plans import ingest
    from meteora.sinks import ledger

    _file(tmp_path, "2020.csv", GOOD)
    args = ingest.parse_args(["ledger", "--source", f"file:{tmp_path}", "--out", scratch("loaded")])
    ingest.run(spark, args)
    ingest.run(spark, args)
    assert capsys.readouterr().out.splitlines() == ["1 added, 0 replaced, 0 touched", "0 added, 0 replaced, 0 touched"]
    assert ledger.loaded(spark, args.out).count() == 1


def test_year_files_of_parquet(spark, scratch):
    path = scratch("files")
    for y in (1996, 1997):
        write_table(_obs(spark).where(F.col("year") == y).drop("year"), "parquet", "overwrite", f"{path}/{y}.parquet")
    assert read_years(spark, path, 1996, 1997).count() == _obs(spark).where("year in (1996, 1997)").count()
    with pytest.raises(ValueError, match="1998"):
        read_years(spark, path, 1996, 1998)


def test_write_table_round_trip(spark, scratch):
    path = scratch("orc")
    write_table(spark.range(5), "orc", "append", path, compression="zlib")
    write_table(spark.range(5), "orc", "append", path)
    assert read_table(spark, "orc", path).count() == 10

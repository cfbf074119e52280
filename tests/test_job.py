"""The batch job end to end on the smallest tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from meteora.options import CANONICAL
from meteora.plans import facts
from meteora.plans.catalog import OBS_COLS, _fixed_width_lines
from meteora.plans.job import parse_args, run
from meteora.plans.testmap import DriverTables
from meteora.schemas import COUNTRY_LAYOUT, MEASURES, STATION_LAYOUT
from meteora.sinks.files import write_observations_csv
from meteora.sinks.tables import write_partitioned

from paths import SF_SMALL

OPTS = CANONICAL.with_order("seq")


def _key(df):
    cols = ["id", "date", *MEASURES, "m_flag", "s_flag", "station_name", "country_name"]
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                  for r in df.select(*cols).collect())


def _obs_with_country_ids(t):
    """Observations whose station ids start with the country code, as the
    real station ids do (test-only: a join to look the country up)."""
    sup = t.table("supplier").select(
        F.lpad(F.col("s_suppkey").cast("string"), 11, "0").alias("id"),
        F.concat(F.lpad(F.col("s_nationkey").cast("string"), 2, "0"),
                 F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("new_id"))
    return t.lineitem_obs().join(sup, "id").drop("id").withColumnRenamed("new_id", "id")


def _job_inputs(spark, scratch, t):
    """Observations as a year-partitioned Parquet table, stations and countries
    as fixed-width text; returns the paths and the observations."""
    obs_path, st_path, co_path = scratch("job_obs"), scratch("job_st"), scratch("job_co")
    obs_c = _obs_with_country_ids(t)
    obs = obs_c.select(*OBS_COLS, "seq").withColumn("year", F.year("date"))
    write_partitioned(obs, obs_path, ["year"], ["id", "date"])
    stations = t.supplier_stations(embed_country=True)
    _fixed_width_lines(stations, STATION_LAYOUT).write.text(st_path)
    _fixed_width_lines(t.countries(), COUNTRY_LAYOUT).write.text(co_path)
    return obs_path, st_path, co_path, obs_c


def _check_job_output(spark, t, obs_c, st_path, co_path, daily_out, yearly_out):
    # the text dimensions carry no country column: it comes from the id, so
    # compare against the same dimension read back from text
    from meteora.sources.fixed_width import read_countries, read_stations
    st_txt, co_txt = read_stations(spark, st_path), read_countries(spark, co_path)
    want_daily = facts.fact_daily(obs_c, st_txt, co_txt, OPTS)
    want_yearly = facts.fact_yearly(obs_c, st_txt, co_txt, OPTS)
    # every observation keeps its station and country
    assert want_daily.count() == facts.fact_daily(t.lineitem_obs(), t.supplier_stations(), t.countries(), OPTS).count()
    got_daily, got_yearly = spark.read.parquet(daily_out), spark.read.parquet(yearly_out)
    assert _key(got_daily) == _key(want_daily)
    assert _key(got_yearly) == _key(want_yearly)
    assert sorted(r["year"] for r in got_yearly.select("year").distinct().collect()) == list(range(1995, 2002))


def test_job_parquet_and_text_dims(spark, scratch):
    t = DriverTables(spark, SF_SMALL)
    obs_path, st_path, co_path, obs_c = _job_inputs(spark, scratch, t)
    daily_out, yearly_out = scratch("job_daily"), scratch("job_yearly")
    args = parse_args([
        "1995", "2001", "--observations", obs_path, "--stations", st_path, "--countries", co_path,
        "--daily-out", daily_out, "--yearly-out", yearly_out, "--order-by", "seq",
    ])
    run(spark, args)
    _check_job_output(spark, t, obs_c, st_path, co_path, daily_out, yearly_out)


def test_job_runs_as_a_script(spark, scratch):
    """``spark-submit meteora/plans/job.py ...``: a separate driver process
    that only has the script path."""
    import os
    import subprocess
    import sys

    from meteora.session import local_path

    t = DriverTables(spark, SF_SMALL)
    obs_path, st_path, co_path, obs_c = _job_inputs(spark, scratch, t)
    daily_out, yearly_out = scratch("script_daily"), scratch("script_yearly")
    script = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "meteora", "plans", "job.py")
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS=(
        f"--master local[2] --conf spark.ui.enabled=false --conf spark.checkpoint.dir={scratch('script_ckpt')} "
        "pyspark-shell"))
    done = subprocess.run(
        [sys.executable, script, "1995", "2001", "--observations", obs_path, "--stations", st_path,
         "--countries", co_path, "--daily-out", daily_out, "--yearly-out", yearly_out, "--order-by", "seq"],
        cwd=local_path(scratch("script_cwd")).rsplit("/", 1)[0], env=env, capture_output=True, text=True, timeout=900,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    _check_job_output(spark, t, obs_c, st_path, co_path, daily_out, yearly_out)


def test_job_csv_refresh_of_one_year(spark, scratch, tmp_path):
    t = DriverTables(spark, SF_SMALL)
    obs = t.lineitem_obs()
    csv_dir = tmp_path / "csv"
    for y in (2000, 2001):
        part = scratch(f"csv_{y}")
        write_observations_csv(obs.where(F.year("date") == y).coalesce(1), part)
        # one file per year, named as the yearly files are
        rows = spark.read.text(part).collect()
        csv_dir.mkdir(exist_ok=True)
        (csv_dir / f"{y}.csv").write_text("".join(r["value"] + "\n" for r in rows))
    st_path, co_path = scratch("r_st"), scratch("r_co")
    _fixed_width_lines(t.supplier_stations(), STATION_LAYOUT).write.text(st_path)
    _fixed_width_lines(t.countries(), COUNTRY_LAYOUT).write.text(co_path)
    daily_out, yearly_out = scratch("r_daily"), scratch("r_yearly")
    common = ["--observations", str(csv_dir), "--observations-format", "csv", "--stations", st_path,
              "--countries", co_path, "--daily-out", daily_out, "--yearly-out", yearly_out]
    run(spark, parse_args(["2000", "2001", *common]))
    before = spark.read.parquet(daily_out).count()
    run(spark, parse_args(["2001", "2001", *common, "--refresh"]))
    run(spark, parse_args(["2001", "2001", *common, "--refresh"]))
    assert spark.read.parquet(daily_out).count() == before
    assert spark.read.parquet(yearly_out).groupBy("year").count().count() == 2


def test_ingest_backfill_then_refresh_of_the_current_year(spark, scratch, tmp_path):
    from meteora.plans import ingest

    t = DriverTables(spark, SF_SMALL)
    obs = t.lineitem_obs()
    csv_dir = tmp_path / "yearly_csv"
    csv_dir.mkdir()
    for y in (1999, 2000, 2001):
        part = scratch(f"ingest_csv_{y}")
        write_observations_csv(obs.where(F.year("date") == y).coalesce(1), part)
        rows = spark.read.text(part).collect()
        (csv_dir / f"{y}.csv").write_text("".join(r["value"] + "\n" for r in rows))
    out = scratch("ingested_table")
    ingest.run(spark, ingest.parse_args(["observations", "1999", "2001", "--csv", str(csv_dir), "--out", out]))
    want = sorted(obs.where(F.year("date").between(1999, 2001)).select(*OBS_COLS).collect())
    assert sorted(spark.read.parquet(out).select(*OBS_COLS).collect()) == want
    # the current year is re-published and re-ingested, twice: no duplicates,
    # the other years untouched
    for _ in range(2):
        ingest.run(spark, ingest.parse_args(["observations", "2001", "2001", "--csv", str(csv_dir), "--out", out,
                                             "--refresh"]))
    assert sorted(spark.read.parquet(out).select(*OBS_COLS).collect()) == want


def test_ingested_dimensions_feed_the_job(spark, scratch):
    """Text dimensions -> Parquet tables -> the job with --dims-format parquet
    gives the same facts as the job reading the text."""
    from meteora.plans import ingest

    t = DriverTables(spark, SF_SMALL)
    obs_path, st_path, co_path, obs_c = _job_inputs(spark, scratch, t)
    dims = scratch("dims_tables")
    ingest.run(spark, ingest.parse_args(["dimensions", "--stations", st_path, "--countries", co_path, "--out", dims]))
    assert spark.read.parquet(f"{dims}/stations").count() == t.table("supplier").count()
    daily_out, yearly_out = scratch("pq_daily"), scratch("pq_yearly")
    run(spark, parse_args([
        "1995", "2001", "--observations", obs_path, "--stations", f"{dims}/stations", "--countries", f"{dims}/countries",
        "--dims-format", "parquet", "--daily-out", daily_out, "--yearly-out", yearly_out, "--order-by", "seq",
    ]))
    _check_job_output(spark, t, obs_c, st_path, co_path, daily_out, yearly_out)


def test_partials_folder_is_reused_by_the_same_run(spark):
    from meteora.plans.job import parts_path

    common = ["--observations", "o", "--stations", "s", "--countries", "c", "--daily-out", "d", "--yearly-out", "y"]
    a = parts_path(spark, parse_args(["2024", "2024", *common, "--refresh"]))
    assert a == parts_path(spark, parse_args(["2024", "2024", *common]))
    assert a != parts_path(spark, parse_args(["2023", "2024", *common]))
    assert a != parts_path(spark, parse_args(["2024", "2024", *common, "--variant", "job"]))
    assert a.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/") + "/")


def test_stream_ingest_takes_each_file_once(spark, scratch):
    from meteora.plans import ingest

    obs = DriverTables(spark, SF_SMALL).lineitem_obs()
    landing, out, ckpt = scratch("landing"), scratch("streamed"), scratch("stream_ckpt")
    args = ingest.parse_args(["stream", "--source", f"{landing}/*", "--out", out, "--checkpoint", ckpt])
    write_observations_csv(obs.where(F.year("date") <= 1997), f"{landing}/a")
    ingest.run(spark, args)
    write_observations_csv(obs.where(F.year("date") > 1997), f"{landing}/b")
    ingest.run(spark, args)
    ingest.run(spark, args)  # nothing new: nothing appended
    assert sorted(spark.read.parquet(out).select(*OBS_COLS).collect()) == sorted(obs.select(*OBS_COLS).collect())


def test_ingested_observations_feed_the_job(spark, scratch, tmp_path):
    """Yearly CSV -> ingest -> job on the Parquet table gives the same facts
    as the job reading the CSV files itself."""
    from meteora.plans import ingest

    t = DriverTables(spark, SF_SMALL)
    obs = t.lineitem_obs()
    csv_dir = tmp_path / "csv_for_job"
    csv_dir.mkdir()
    for y in (2000, 2001):
        part = scratch(f"chain_csv_{y}")
        write_observations_csv(obs.where(F.year("date") == y).coalesce(1), part)
        (csv_dir / f"{y}.csv").write_text("".join(r["value"] + "\n" for r in spark.read.text(part).collect()))
    table = scratch("chain_table")
    ingest.run(spark, ingest.parse_args(["observations", "2000", "2001", "--csv", str(csv_dir), "--out", table]))
    st_path, co_path = scratch("chain_st"), scratch("chain_co")
    _fixed_width_lines(t.supplier_stations(), STATION_LAYOUT).write.text(st_path)
    _fixed_width_lines(t.countries(), COUNTRY_LAYOUT).write.text(co_path)
    outs = {}
    for fmt, src in (("parquet", table), ("csv", str(csv_dir))):
        daily, yearly = scratch(f"chain_daily_{fmt}"), scratch(f"chain_yearly_{fmt}")
        run(spark, parse_args(["2000", "2001", "--observations", src, "--observations-format", fmt,
                               "--stations", st_path, "--countries", co_path, "--daily-out", daily,
                               "--yearly-out", yearly]))
        outs[fmt] = (_key(spark.read.parquet(daily)), _key(spark.read.parquet(yearly)))
    assert outs["parquet"] == outs["csv"] and len(outs["csv"][0]) > 0


def test_job_trial_run_gives_the_first_rows(spark, scratch):
    from meteora.operators.limit import sample_rows
    from meteora.sources.fixed_width import read_countries, read_stations

    t = DriverTables(spark, SF_SMALL)
    obs_path, st_path, co_path, obs_c = _job_inputs(spark, scratch, t)
    daily_out, yearly_out = scratch("trial_daily"), scratch("trial_yearly")
    run(spark, parse_args([
        "1995", "2001", "--observations", obs_path, "--stations", st_path, "--countries", co_path,
        "--daily-out", daily_out, "--yearly-out", yearly_out, "--order-by", "seq", "--sample-rows", "25",
    ]))
    st_txt, co_txt = read_stations(spark, st_path), read_countries(spark, co_path)
    for out, build in ((daily_out, facts.fact_daily), (yearly_out, facts.fact_yearly)):
        got = spark.read.parquet(f"{out}_trial")
        assert got.count() == 25
        assert _key(got) == _key(sample_rows(build(obs_c, st_txt, co_txt, OPTS), 25, ["id", "date"]))

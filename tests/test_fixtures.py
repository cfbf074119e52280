"""Expected values of FIXTURES.md section 1 for the three transform variants."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meteora.options import CANONICAL, JOB, LOCAL
from meteora.operators.aggregate import to_daily, to_yearly
from meteora.plans.facts import fact_daily
from meteora.sources.csv import read_observations_csv

OBS_LINES = """\
AA000000001,20200101,TMAX,251,,,S,0700
AA000000001,20200101,TMAX,253,,,S,
AA000000001,20200101,TMIN,-15,,,S,
AA000000001,20200101,PRCP,7,T,,S,
AA000000001,20200102,TMAX,701,,,S,
AA000000001,20200102,TMIN,-700,,,S,
AA000000001,20200102,TMAX,300,,I,S,
BB000000002,20200101,WSFG,55,,,S,
ZZ000000009,20200101,TMAX,100,,,S,
"""


@pytest.fixture()
def obs(spark, tmp_path):
    (tmp_path / "2020.csv").write_text(OBS_LINES)
    return read_observations_csv(spark, str(tmp_path / "2020.csv"))


def _rows(df):
    return {(r["id"], r["date"].isoformat()): r.asDict() for r in df.collect()}


def test_reader_types_and_flags(obs):
    assert [f.name for f in obs.schema.fields] == ["id", "date", "element", "value", "m_flag", "q_flag", "s_flag", "obs_time"]
    rows = obs.collect()
    assert len(rows) == 9
    first = rows[0]
    assert first["date"] == dt.date(2020, 1, 1)
    assert first["obs_time"] == 700  # "0700" read as a number
    assert first["m_flag"] == "" and first["q_flag"] == ""  # empty, not null
    assert rows[1]["obs_time"] is None


def test_canonical_daily(obs):
    out = _rows(to_daily(obs, CANONICAL))
    a1 = out[("AA000000001", "2020-01-01")]
    assert a1["tmax"] == pytest.approx(25.2) and a1["tmin"] == pytest.approx(-1.5) and a1["prcp"] == pytest.approx(0.7)
    assert a1["snow"] is None and a1["snwd"] is None
    a2 = out[("AA000000001", "2020-01-02")]
    assert a2["tmax"] is None and a2["tmin"] == pytest.approx(-70.0) and a2["prcp"] is None
    b = out[("BB000000002", "2020-01-01")]
    assert all(b[m] is None for m in ("tmax", "tmin", "prcp", "snow", "snwd"))
    assert out[("ZZ000000009", "2020-01-01")]["tmax"] == pytest.approx(10.0)


def test_local_variant(obs):
    out = _rows(to_daily(obs, LOCAL))
    a1 = out[("AA000000001", "2020-01-01")]
    assert float(a1["tmax"]) == 25.0 and float(a1["tmin"]) == -1.0 and float(a1["prcp"]) == 0.0
    a2 = out[("AA000000001", "2020-01-02")]
    assert float(a2["tmax"]) == 70.0 and float(a2["tmin"]) == -70.0


def test_job_variant(obs):
    out = _rows(to_daily(obs, JOB))
    a1 = out[("AA000000001", "2020-01-01")]
    assert a1["tmax"] == pytest.approx(25.2) and a1["tmin"] == pytest.approx(-1.5) and a1["prcp"] == pytest.approx(7.0)
    a2 = out[("AA000000001", "2020-01-02")]
    assert a2["tmax"] == pytest.approx(30.0) and a2["tmin"] == pytest.approx(-70.0)


def test_fact_join_drops_unknown_station_and_country(spark, obs):
    stations = spark.createDataFrame(
        [("AA000000001", 1.0, 2.0, 3.0, None, "ALPHA", None, None, None),
         ("BB000000002", -1.5, -2.5, 10.0, "XY", "BETA, TOWN", "GSN", None, "01234"),
         ("ZZ000000009", 0.0, 0.0, 0.0, None, "NOWHERE", None, None, None)],
        "id string, latitude double, longitude double, elevation double, state string, name string, "
        "gsn_flag string, hcn_crn_flag string, wmo_id string",
    )
    countries = spark.createDataFrame([("AA", "Country A"), ("BB", "Country B")], "code string, name string")
    fact = fact_daily(obs, stations, countries, CANONICAL)
    keys = {(r["id"], r["date"].isoformat()) for r in fact.collect()}
    assert keys == {("AA000000001", "2020-01-01"), ("AA000000001", "2020-01-02"), ("BB000000002", "2020-01-01")}
    assert fact.columns[:2] == ["id", "date"] and len(fact.columns) == 15
    row = fact.where(F.col("id") == "BB000000002").first()
    assert row["country_name"] == "Country B" and row["station_name"] == "BETA, TOWN"


def test_yearly_averages_raw_rows_not_daily_means(spark):
    rows = [("S1", dt.date(2020, 1, 1), "TMAX", 100, "", "", "", None, 1),
            ("S1", dt.date(2020, 1, 1), "TMAX", 200, "", "", "", None, 2),
            ("S1", dt.date(2020, 1, 1), "TMAX", 300, "", "", "", None, 3),
            ("S1", dt.date(2020, 6, 1), "TMAX", 600, "", "", "", None, 4)]
    obs = spark.createDataFrame(
        rows, "id string, date date, element string, value long, m_flag string, q_flag string, s_flag string, "
              "obs_time short, seq long")
    y = to_yearly(obs, CANONICAL.with_order("seq")).first()
    assert y["date"] == dt.date(2020, 1, 1)
    assert y["tmax"] == pytest.approx(30.0)  # (10+20+30+60)/4, not mean(20, 60) = 40


def test_flags_come_from_first_row(spark):
    rows = [("S1", dt.date(2020, 1, 1), "TMAX", 1, "B", "", "7", None, 2),
            ("S1", dt.date(2020, 1, 1), "TMIN", 1, "", "", "S", None, 1),
            ("S1", dt.date(2020, 1, 1), "PRCP", 1, "T", "", "", None, 3)]
    obs = spark.createDataFrame(
        rows, "id string, date date, element string, value long, m_flag string, q_flag string, s_flag string, "
              "obs_time short, seq long")
    r = to_daily(obs, CANONICAL.with_order("seq")).first()
    assert (r["m_flag"], r["s_flag"]) == ("", "S")


def test_job_variant_column_order(spark, obs):
    stations = spark.createDataFrame(
        [("AA000000001", 1.0, 2.0, 3.0, None, "ALPHA", None, None, None)],
        "id string, latitude double, longitude double, elevation double, state string, name string, "
        "gsn_flag string, hcn_crn_flag string, wmo_id string")
    countries = spark.createDataFrame([("AA", "Country A")], "code string, name string")
    fact = fact_daily(obs, stations, countries, JOB.with_order("obs_time"))
    assert fact.columns[9:13] == ["latitude", "longitude", "elevation", "station_name"]
    assert fact_daily(obs, stations, countries, CANONICAL).columns[9] == "station_name"

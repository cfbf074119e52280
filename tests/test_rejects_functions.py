"""Rejected lines, and the transforms as SQL table functions."""

from __future__ import annotations

import gzip
import os

import pytest
from pyspark.sql import functions as F

from meteora.operators.aggregate import to_daily, to_yearly
from meteora.options import CANONICAL, JOB, LOCAL
from meteora.plans import table_functions
from meteora.plans.testmap import DriverTables
from meteora.sources.csv import read_observations_csv
from meteora.sources.rejects import TooManyRejected, check_sources, split_observations
from paths import SF_SMALL

GOOD = "USW00094728,20200101,TMAX,10,,,S,0700"


def _file(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    opener = gzip.open if name.endswith(".gz") else open
    with opener(f"{folder}/{name}", "wt", encoding="utf-8") as f:
        f.write("".join(f"{x}\n" for x in lines))


def test_every_line_is_accepted_or_rejected_with_its_reason(spark, tmp_path, scratch):
    bad = {"USW1,20200102,TMAX": "number of fields", GOOD + ",x": "number of fields", "USW1,20200102,TMAX,abc,,,S,0700": "value",
           "USW1,20201302,TMAX,1,,,S,0700": "date", "USW1,2020-01-02,TMAX,1,,,S,0700": "date", ",20200102,TMAX,1,,,S,0700": "station",
           "USW1,20200102,TMAX,1,,,S,7 am": "value"}
    _file(tmp_path, "2020.csv", [GOOD, *list(bad)[:4], "", GOOD])
    _file(tmp_path, "2021.csv.gz", [*list(bad)[4:], GOOD.replace("2020", "2021")])
    _file(tmp_path, "readme.md", ["hello"])
    split = split_observations(spark, f"file:{tmp_path}", scratch("split"), most_rejected=0.9)
    assert (split.n_lines, split.n_rejected) == (10, 7)
    got = {r["line"]: (r["reason"], r["file"].rsplit("/", 1)[1]) for r in split.rejected.collect()}
    assert got.pop(None) == ("only .csv and .csv.gz files are read", "readme.md")
    assert {k: v[0] for k, v in got.items()} == bad
    assert {v[1] for v in got.values()} == {"2020.csv", "2021.csv.gz"}
    _file(f"{tmp_path}/clean", "2020.csv", [GOOD, GOOD, GOOD.replace("2020", "2021")])
    want = read_observations_csv(spark, f"file:{tmp_path}/clean")
    assert split.accepted.dtypes == want.dtypes
    assert sorted(map(str, split.accepted.collect())) == sorted(map(str, want.collect()))


def test_too_many_rejected_lines_end_the_load(spark, tmp_path, scratch):
    _file(tmp_path, "2020.csv", [GOOD] * 8 + ["x"] * 2)
    staging = scratch("split")
    with pytest.raises(TooManyRejected, match="2 of 10"):
        split_observations(spark, f"file:{tmp_path}", staging, most_rejected=0.1)
    assert spark.read.parquet(staging).where("NOT accepted").count() == 2  # they stay readable
    assert split_observations(spark, f"file:{tmp_path}", scratch("again"), most_rejected=0.2).n_rejected == 2


def test_folders_without_csv(spark, tmp_path, scratch):
    _file(tmp_path, "a.txt", ["x"])
    assert check_sources(spark, f"file:{tmp_path}")[0] == []
    with pytest.raises(ValueError, match="no CSV"):
        split_observations(spark, f"file:{tmp_path}", scratch("none"))
    _file(tmp_path, "empty.csv", [])
    split = split_observations(spark, f"file:{tmp_path}", scratch("empty"))
    assert (split.n_lines, split.accepted.count(), split.rejected.count()) == (0, 0, 1)


@pytest.mark.parametrize("base", [CANONICAL, LOCAL, JOB])
def test_table_functions_give_the_transforms(spark, base):
    opts = base.with_order("seq")
    obs = DriverTables(spark, SF_SMALL).lineitem_obs().withColumn("year", F.year("date"))
    table_functions.register(obs, "tf_obs", opts)
    some = obs.where("year IN (1996, 1999)")
    for name, transform in ((table_functions.DAILY, to_daily), (table_functions.YEARLY, to_yearly)):
        got, want = table_functions.for_years(spark, [1999, 1996, 1996], name), transform(some, opts)
        assert got.dtypes == want.dtypes
        rows = [sorted(str([round(float(x), 6) if x is not None and c in ("tmax", "tmin", "prcp", "snow", "snwd") else x for c, x in r.asDict().items()])
                       for r in df.collect()) for df in (got, want)]
        assert rows[0] == rows[1] and len(rows[0]) > 0
    assert spark.sql("SELECT * FROM process_year_table(1888)").count() == 0


def test_a_table_function_reads_its_year(spark, scratch):
    path = scratch("tf")
    obs = DriverTables(spark, SF_SMALL).lineitem_obs().withColumn("year", F.year("date"))
    obs.write.partitionBy("year").parquet(path)
    table_functions.register(spark.read.parquet(path), "tf_stored", CANONICAL)
    plan = spark.sql("SELECT * FROM process_year_table(1996)")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year#" in plan and "= 1996)" in plan
    lateral = table_functions.for_years(spark, [1996, 1997])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in lateral and "Cartesian" not in lateral
    with pytest.raises(ValueError, match="year"):
        table_functions.register(spark.range(1), "tf_none")

"""Membership filters on stored facts: fewer row groups are read for a station."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meteora.plans import analytics
from meteora.sinks import membership


def scanned(df) -> int:
    """Rows that the scan of ``df`` gave out, after row groups were excluded."""
    plan = df._jdf.queryExecution()
    df._jdf.collectToPython()
    found = []

    def walk(node):
        if node.nodeName().startswith("Scan"):
            found.append(node.metrics().apply("numOutputRows").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan.executedPlan())
    return sum(found)


@pytest.fixture()
def fact(spark, scratch):
    """2,000 stations, every tenth one in each file, in order of date: ids span every row group."""
    path = scratch("membership")
    rows = spark.range(0, 200_000, 1, 10).select(
        (F.pmod(F.col("id"), F.lit(200)) * 10 + F.spark_partition_id()).alias("n"), "id")
    rows = rows.select(F.format_string("S%05d", "n").alias("id"), F.date_add(F.lit("2000-01-01").cast("date"), F.pmod("id", F.lit(365)).cast("int")).alias("date"),
                       F.lit(2000).alias("year"), (F.col("id") % 97).cast("double").alias("tmax"))
    membership.write_with_membership(rows, path, ["id"], 2_000, ["year"], ["date"])
    return path


STATIONS = [("S00003", "A"), ("S00013", "A"), ("S00500", "B"), (None, "A"), ("S09999", "C")]


def test_row_groups_without_the_station_are_not_read(spark, fact):
    stations = spark.createDataFrame(STATIONS, "id string, station_name string")
    rows = lambda on: analytics.at_few_stations(
        spark.read.option("parquet.filter.bloom.enabled", on).parquet(fact), stations, F.col("station_name") == "A")
    assert rows("true").count() == rows("false").count() == 200
    with_filter, without = scanned(rows("true")), scanned(rows("false"))
    assert with_filter == 20_000 and without == 200_000  # one file of ten holds them


@pytest.mark.parametrize("name", ["A", "B", "C", "nowhere"])
def test_same_rows_as_the_semi_join(spark, fact, name):
    stations = spark.createDataFrame([*STATIONS, *STATIONS], "id string, station_name string")
    table, place = spark.read.parquet(fact), F.col("station_name") == name
    want = sorted(map(str, analytics.at_place(table, stations, place).select(*table.columns).collect()))
    for most in (64, 1, 0):
        got = analytics.at_few_stations(table, stations, place, most).select(*table.columns)
        assert sorted(map(str, got.collect())) == want


def test_options_name_each_column():
    options = membership.membership_options(["id", "country_code"], 5, 1 << 20)
    assert options["parquet.bloom.filter.enabled#country_code"] == "true" and options["parquet.block.size"] == str(1 << 20)
    with pytest.raises(ValueError):
        membership.membership_options(["id"], 0)

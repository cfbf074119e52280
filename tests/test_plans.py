"""Physical plan shape and equivalence of the alternative forms."""

from __future__ import annotations

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from meteora.operators.aggregate import to_daily, to_yearly
from meteora.operators.pivot import pivot_native
from meteora.operators.cleaning import clean
from meteora.operators.setops import union_all
from meteora.operators.window import window_avg, window_dedup
from meteora.options import CANONICAL
from meteora.plans.catalog import OBS_COLS
from meteora.plans.facts import fact_daily
from meteora.plans.testmap import DriverTables

import pytest

from paths import SF_SMALL

OPTS = CANONICAL.with_order("seq")


def plan_text(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_fact_plan_shape(spark, scratch):
    t = DriverTables(spark, SF_SMALL)
    path = scratch("obs_for_plan")
    t.lineitem_obs().select(*OBS_COLS).write.parquet(path)
    fact = fact_daily(spark.read.parquet(path), t.supplier_stations(), t.countries(), OPTS.with_order("value"))
    plan = plan_text(fact)
    # quality filter reaches the scan; only one shuffle (the aggregate)
    assert "PushedFilters: [Or(IsNull(q_flag),EqualTo(q_flag,))" in plan
    assert len(re.findall(r"^\(\d+\) Exchange$", plan, re.M)) == 1 and "hashpartitioning(id" in plan
    # hash aggregation with partial (map-side) combine, no sort-based aggregate
    assert "partial_sum" in plan and "SortAggregate" not in plan
    # both dimensions broadcast after the size check
    assert len(re.findall(r"^\(\d+\) BroadcastHashJoin$", plan, re.M)) == 2
    assert "Window" not in plan


def test_window_forms_have_no_window_operator(spark):
    obs = DriverTables(spark, SF_SMALL).events_obs()
    for df in (window_avg(obs, OPTS), window_dedup(obs, OPTS, yearly=True)):
        plan = plan_text(df)
        assert "Window" not in plan and "SortAggregate" not in plan


def _sorted(df, cols):
    return sorted(tuple(None if v is None else (round(v, 6) if isinstance(v, float) else v) for v in r)
                  for r in df.select(*cols).collect())


def test_window_dedup_equals_grouped(spark):
    t = DriverTables(spark, SF_SMALL)
    cols = ["id", "date", "tmax", "tmin", "prcp", "snow", "snwd", "m_flag", "s_flag"]
    for obs, yearly in ((t.events_obs(), False), (t.lineitem_obs(), True)):
        grouped = to_yearly(obs, OPTS) if yearly else to_daily(obs, OPTS)
        assert _sorted(window_dedup(obs, OPTS, yearly), cols) == _sorted(grouped, cols)


def test_native_pivot_equals_case_pivot(spark):
    obs = DriverTables(spark, SF_SMALL).events_obs()
    cols = ["id", "date", "tmax", "tmin", "prcp", "snow", "snwd"]
    assert _sorted(pivot_native(clean(obs, OPTS), OPTS), cols) == _sorted(to_daily(obs, OPTS), cols)


def test_union_of_years_equals_one_read(spark):
    obs = DriverTables(spark, SF_SMALL).lineitem_obs()
    years = [obs.where(F.year("date") == y) for y in range(1995, 2002)]
    cols = ["id", "date", "tmax", "tmin", "prcp", "snow", "snwd", "m_flag", "s_flag"]
    assert _sorted(union_all(to_daily(o, OPTS) for o in years), cols) == _sorted(to_daily(obs, OPTS), cols)


def test_hot_station_day_is_combined_map_side(spark):
    """A third of all rows on one station/day: result stays exact."""
    hot = spark.range(0, 30000).select(
        F.lit("HOT00000001").alias("id"), F.to_date(F.lit("2020-01-01")).alias("date"), F.lit("TMAX").alias("element"),
        (F.col("id") % 100).alias("value"), F.lit("").alias("m_flag"), F.lit("").alias("q_flag"),
        F.lit("S").alias("s_flag"), F.lit(None).cast("short").alias("obs_time"), F.col("id").alias("seq"))
    rest = spark.range(0, 60000).select(
        F.concat(F.lit("ST"), F.lpad((F.col("id") % 1000).cast("string"), 9, "0")).alias("id"),
        F.to_date(F.lit("2020-01-01")).alias("date"), F.lit("TMIN").alias("element"), F.lit(10).cast("long").alias("value"),
        F.lit("").alias("m_flag"), F.lit("").alias("q_flag"), F.lit("S").alias("s_flag"),
        F.lit(None).cast("short").alias("obs_time"), (F.col("id") + 100000).alias("seq"))
    daily = to_daily(hot.unionByName(rest.withColumn("value", F.col("value").cast("long"))).repartition(8), OPTS)
    r = daily.where(F.col("id") == "HOT00000001").first()
    assert abs(r["tmax"] - 4.95) < 1e-9 and r["s_flag"] == "S"
    assert daily.count() == 1001
    w = window_avg(hot.repartition(8), OPTS).agg(F.count("*").alias("n"), F.max("tmax").alias("m")).first()
    assert w["n"] == 30000 and abs(w["m"] - 4.95) < 1e-9


def test_place_restriction_cuts_observations_before_the_aggregate(spark):
    from meteora.plans import analytics
    from meteora.plans.facts import fact_yearly

    t = DriverTables(spark, SF_SMALL)
    place = analytics.in_country("NATION_3") | analytics.station_named("%#000000001")
    args = (t.lineitem_obs(), t.supplier_stations(), t.countries(), OPTS)
    cols = ["id", "date", "tmax", "tmin", "prcp", "snow", "snwd", "m_flag", "s_flag", "station_name", "country_name"]
    for build in (fact_daily, fact_yearly):
        restricted = build(*args, stations_where=place)
        assert _sorted(restricted, cols) == _sorted(build(*args).where(place), cols)
        assert restricted.count() > 0
        plan = plan_text(restricted)
        # broadcast semi join on the raw rows, below the partial aggregate
        assert "LeftSemi" in plan
        assert plan.index("BroadcastHashJoin LeftSemi") > plan.index("HashAggregate")  # deeper in the tree


def test_hot_station_day_is_split_in_the_window_join(spark):
    """A third of all rows on one station/day: AQE splits that key's join
    partition in the window form (rows must differ, as real rows do, for
    the shuffle block to be large after compression)."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        # at scale the per-key averages are far too big to broadcast
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 150000
        rows = spark.range(0, n).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT00000001"))
            .otherwise(F.concat(F.lit("ST"), F.lpad((F.col("id") % 5000).cast("string"), 9, "0"))).alias("id"),
            F.to_date(F.lit("2020-01-01")).alias("date"), F.lit("TMAX").alias("element"),
            (F.col("id") % 100).alias("value"),
            F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 24).alias("m_flag"), F.lit("").alias("q_flag"),
            F.lit("S").alias("s_flag"), F.lit(None).cast("short").alias("obs_time"), F.col("id").alias("seq"),
        ).repartition(8)
        # m_flag stays in the aggregate, so column pruning keeps whole rows in the join
        out = window_avg(rows, OPTS).groupBy("id").agg(F.count("*").alias("n"), F.max("tmax").alias("m"),
                                                       F.max("m_flag").alias("f"))
        hot = {r["id"]: (r["n"], r["m"]) for r in out.collect()}["HOT00000001"]
        assert hot[0] == n // 3 and abs(hot[1] - 4.95) < 1e-9
        assert "SortMergeJoin(skew=true)" in plan_text(out)  # the executed, final adaptive plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_question_on_stored_fact_prunes_year_and_pushes_country(spark, scratch):
    from meteora.plans import analytics
    from meteora.sinks.tables import write_fact_daily

    t = DriverTables(spark, SF_SMALL)
    path = scratch("served_fact")
    write_fact_daily(fact_daily(t.lineitem_obs(), t.supplier_stations(), t.countries(), OPTS), path)
    stored = spark.read.parquet(path)
    q = analytics.max_by_country_year(stored, "NATION_3", 1996)
    plan = plan_text(q)
    assert re.search(r"PartitionFilters: \[.*\(year#\d+ = 1996\)", plan)
    assert "EqualTo(country_name,NATION_3)" in plan
    assert q.count() == 1


def test_place_by_name_on_stored_fact_is_one_checked_semi_join(spark, scratch):
    from pyspark.sql import functions as F

    from meteora.plans import analytics
    from meteora.plans.dimensions import station_country
    from meteora.sinks.tables import write_fact_daily

    t = DriverTables(spark, SF_SMALL)
    path = scratch("served_fact_by_name")
    write_fact_daily(fact_daily(t.lineitem_obs(), t.supplier_stations(), t.countries(), OPTS), path)
    stored = spark.read.parquet(path)
    stations = station_country(t.supplier_stations(), t.countries())
    place = analytics.station_named("%#00000000_")
    listed = analytics.at_place(stored, stations, place)
    assert "BroadcastHashJoin LeftSemi" in plan_text(listed) or "LeftSemi" in plan_text(listed)
    cols = ["id", "date", "tmax", "m_flag", "station_name"]
    assert _sorted(listed, cols) == _sorted(stored.where(place), cols) and listed.count() > 0
    # a re-published station list with another country code finds the same rows
    moved = stations.withColumn("country_code", F.lit("ZZ"))
    assert _sorted(analytics.at_place(stored, moved, place), cols) == _sorted(listed, cols)


def test_size_check_measures_anew(spark, scratch):
    from meteora.operators.join import fits_broadcast, measured_bytes

    path = scratch("dim")
    spark.range(5).selectExpr("id", "repeat('x', 10) s").write.parquet(path)
    assert fits_broadcast(spark.read.parquet(path), 1000)
    spark.range(5000).selectExpr("id", "repeat('x', 10) s").write.mode("overwrite").parquet(path)
    assert not fits_broadcast(spark.read.parquet(path), 1000)
    assert measured_bytes([spark.range(0), spark.range(3)]) == [0, 3 * 80]


def test_window_dedup_has_one_scan_and_one_exchange(spark):
    from meteora.operators.window import window_dedup

    plan = plan_text(window_dedup(DriverTables(spark, SF_SMALL).events_obs(), OPTS))
    plan = plan[plan.index("== Physical"):] if "== Physical" in plan else plan
    tree = plan.split("\n\n")[0]
    assert len(re.findall(r"\bExchange \(\d+\)", tree)) == 1 and len(re.findall(r"\bScan ", tree)) == 1 and "Join" not in tree


def test_null_order_key_still_picks_a_row(spark):
    from meteora.operators.aggregate import first_flags
    from meteora.schemas import OBS_SCHEMA

    import datetime as dt

    d = dt.date(2020, 1, 1)
    rows = [("a", d, "TMAX", 1, "T", "", "S", None), ("a", d, "TMIN", 2, "P", "", "7", None),
            ("b", d, "TMAX", 1, "T", "", "S", 5), ("b", d, "TMIN", 2, "P", "", "7", None),
            ("c", d, "TMAX", 1, "X", "", None, 3), ("c", d, "TMIN", 2, "Y", "", "Z", 3)]
    obs = spark.createDataFrame(rows, OBS_SCHEMA)
    for order in (("obs_time",), ("obs_time", "element"), ("date", "obs_time")):
        got = {r["id"]: (r["m_flag"], r["s_flag"]) for r in first_flags(obs, OPTS.with_order(*order)).collect()}
        assert got["a"] in {("T", "S"), ("P", "7")} and got["b"] == ("T", "S") and got["c"] in {("X", ""), ("Y", "Z")}
        again = {r["id"]: (r["m_flag"], r["s_flag"]) for r in first_flags(obs.repartition(5, "value"), OPTS.with_order(*order)).collect()}
        assert got == again


def test_small_place_of_a_big_dimension_is_still_cut_early(spark):
    from meteora.plans import analytics
    from meteora.plans.facts import _fact
    from meteora.operators.aggregate import to_daily

    t = DriverTables(spark, SF_SMALL)
    args = (t.lineitem_obs(), t.supplier_stations(), t.countries(), OPTS)
    one = analytics.station_named("%#000000003")  # one station; the dimension has ten
    # a bound of one row: the whole dimension fails the check, the one-station place passes it
    restricted = _fact(*args, one, to_daily, max_broadcast_bytes=250)
    assert "BroadcastHashJoin LeftSemi" in plan_text(restricted)
    cols = ["id", "date", "tmax", "tmin", "m_flag", "station_name"]
    assert _sorted(restricted, cols) == _sorted(fact_daily(*args).where(one), cols)
    # a place too big for the bound is not cut early, and the result is the same
    many = analytics.station_named("%SUPPLIER%")
    whole = _fact(*args, many, to_daily, max_broadcast_bytes=250)
    assert "LeftSemi" not in plan_text(whole)
    assert _sorted(whole, cols) == _sorted(fact_daily(*args).where(many), cols)


def test_trial_run_rows_equal_the_ordered_limit_of_the_whole_fact(spark):
    from meteora.options import JOB, LOCAL
    from meteora.operators.limit import sample_rows
    from meteora.plans.facts import fact_yearly, first_fact_rows

    t = DriverTables(spark, SF_SMALL)
    args = (t.lineitem_obs(), t.supplier_stations(), t.countries())
    cols = ["id", "date", "tmax", "tmin", "prcp", "m_flag", "s_flag", "station_name"]
    for opts in (OPTS, LOCAL.with_order("seq"), JOB.with_order("seq")):
        for n, yearly in ((7, False), (500, False), (3, True), (10 ** 6, False)):
            whole = sample_rows((fact_yearly if yearly else fact_daily)(*args, opts), n, ["id", "date"])
            head = first_fact_rows(*args, opts, n, yearly=yearly)
            assert _sorted(head, cols) == _sorted(whole, cols)


def test_results_do_not_depend_on_partitioning(spark):
    """Flag picks, ordered limits and top-k give the same rows with any
    number of shuffle partitions."""
    import __spark_entry__ as entry

    qs = entry.queries()
    keys = ["fact_daily", "fact_yearly", "agg_first_flags", "win_dedup_yearly", "limit_sample", "q_compare_yearly",
            "q_max_by_country_year"]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    got = {}
    try:
        for parts in ("1", "5"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got[parts] = {k: sorted(map(tuple, qs[k](spark, SF_SMALL).collect()), key=repr) for k in keys}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for k in keys:
        assert got["1"][k] == got["5"][k], k
        assert got["1"][k], k


@pytest.mark.parametrize("yearly", [False, True])
@pytest.mark.parametrize("n", [0, 1, 37, 100_000])
def test_trial_rows_are_the_first_of_the_whole_fact(spark, n, yearly):
    from meteora.plans import facts

    t = DriverTables(spark, SF_SMALL)
    args = (t.lineitem_obs(), t.supplier_stations().where("id != '00000000001'"), t.countries(), OPTS)
    whole = (facts.fact_yearly if yearly else facts.fact_daily)(*args).orderBy("id", "date").limit(n)
    got = facts.first_fact_rows(*args, n, yearly)
    assert [(r["id"], r["date"]) for r in got.collect()] == [(r["id"], r["date"]) for r in whole.collect()]


def test_trial_rows_aggregate_few_stations(spark):
    from meteora.plans import facts

    t = DriverTables(spark, SF_SMALL)
    plan = plan_text(facts.first_fact_rows(t.lineitem_obs(), t.supplier_stations(), t.countries(), OPTS, 20))
    assert re.search(r"lpad\(.*<= 0000000000[0-2]\)", plan)


def test_size_is_measured_once_per_state_of_the_files(spark, scratch, monkeypatch):
    from meteora.operators import join

    path = scratch("dim_once")
    spark.range(5).write.parquet(path)
    first = join.measured_bytes([spark.read.parquet(path)])
    monkeypatch.setattr(join, "row_bytes", lambda df: 1 / 0)  # another job would fail here
    assert join.measured_bytes([spark.read.parquet(path)]) == first
    with pytest.raises(ZeroDivisionError):
        join.measured_bytes([spark.read.parquet(path).where("id > 3")])


def test_unique_order_key_is_one_long(spark):
    from meteora.operators.aggregate import order_key, to_yearly

    obs = DriverTables(spark, SF_SMALL).lineitem_obs()
    assert obs.select(order_key(OPTS.with_order("seq", unique=True), obs).alias("k")).dtypes == [("k", "bigint")]
    cols = ["id", "date", "m_flag", "s_flag", "tmax"]
    assert _sorted(to_yearly(obs, OPTS.with_order("seq", unique=True)), cols) == _sorted(to_yearly(obs, OPTS.with_order("seq")), cols)
    with pytest.raises(ValueError, match="exactly one"):
        OPTS.with_order("seq", "date", unique=True)

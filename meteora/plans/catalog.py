"""Registered queries: one per operator of the inventory, over the test tables.

Every query reads the given tables (through the mapping of
``meteora.plans.testmap``) in full.  Source and sink queries first write
data derived from those tables into a fresh folder below the session's
shared checkpoint folder, then read it back with the operator under test.
Measures are rounded to 6 decimals, as in the SQL oracles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteora import functions as fn
from meteora.operators import aggregate, cleaning, pivot, setops, window
from meteora.operators.join import checked_broadcast
from meteora.options import CANONICAL, JOB, LOCAL
from meteora.plans import analytics, dimensions, facts, table_functions
from meteora.plans.incremental import IncrementalFacts, touched_days
from meteora.plans.testmap import DriverTables
from meteora.schemas import COUNTRY_LAYOUT, MEASURES, OBS_SCHEMA, STATION_LAYOUT
from meteora.session import scratch_path, unique_name
from meteora.sinks import bucketed, ledger, membership
from meteora.sinks import files as file_sinks
from meteora.sinks import tables as table_sinks
from meteora.sinks.store import Store
from meteora.sources import csv as csv_sources
from meteora.sources import fixed_width, rejects, tables as table_sources

OBS_COLS = [f.name for f in OBS_SCHEMA.fields]
EV_OPTS = CANONICAL.with_order("seq", unique=True)


def _opts(base=CANONICAL):
    return base.with_order("seq", unique=True)


def rounded(df: DataFrame, cols=MEASURES) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in cols if c in df.columns})


def _t(spark: SparkSession, sf_dir: str) -> DriverTables:
    return DriverTables(spark, sf_dir)


# -- fixed-width text written from a table (input for the text readers) -----
def _fixed_width_lines(df: DataFrame, layout) -> DataFrame:
    """Render rows in a fixed-width layout; trailing blanks are cut, so a row
    whose last fields are empty gives a short line."""
    parts, pos = [], 1
    for name, start, length, kind in layout:
        if start > pos:
            parts.append(F.lit(" " * (start - pos)))
        c = F.col(name)
        if kind == "double":
            text = F.format_string(f"%{length}.2f", c)
        else:
            text = F.rpad(F.coalesce(c, F.lit("")), length, " ")
        parts.append(F.coalesce(text, F.lit(" " * length)))
        pos = start + length
    return df.select(F.rtrim(F.concat(*parts)).alias("value"))


# -- sources -------------------------------------------------------------------
def src_parquet(spark, sf_dir):
    return _t(spark, sf_dir).events_obs().select(*OBS_COLS)


def src_csv_headerless(spark, sf_dir):
    path = scratch_path(spark, "obs_csv")
    file_sinks.write_observations_csv(_t(spark, sf_dir).events_obs(), path)
    return csv_sources.read_observations_csv(spark, path)


def src_csv_gzip(spark, sf_dir):
    path = scratch_path(spark, "obs_csv_gz")
    file_sinks.write_observations_csv(_t(spark, sf_dir).lineitem_obs(), path, compression="gzip")
    return csv_sources.read_observations_csv(spark, path)


def src_csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "supplier_csv")
    file_sinks.write_csv_quoted(_t(spark, sf_dir).table("supplier"), path)
    return csv_sources.read_csv_inferred(spark, path)


def src_fixed_width(spark, sf_dir):
    path = scratch_path(spark, "stations_txt")
    st = _t(spark, sf_dir).customer_stations()
    _fixed_width_lines(st, STATION_LAYOUT).write.mode("overwrite").text(path)
    return fixed_width.read_stations(spark, path)


def src_fixed_width_countries(spark, sf_dir):
    path = scratch_path(spark, "countries_txt")
    _fixed_width_lines(_t(spark, sf_dir).countries(), COUNTRY_LAYOUT).write.mode("overwrite").text(path)
    return fixed_width.read_countries(spark, path)


def src_external_table(spark, sf_dir):
    path = scratch_path(spark, "obs_parquet")
    file_sinks.write_parquet(_t(spark, sf_dir).events_obs().select(*OBS_COLS), path)
    return table_sources.external_table(spark, unique_name("obs_ext"), path)


def src_format_options(spark, sf_dir):
    path = scratch_path(spark, "obs_fmt")
    file_sinks.write_parquet(_t(spark, sf_dir).lineitem_obs().select(*OBS_COLS), path)
    return table_sources.read_table(spark, "parquet", path, mergeSchema=False)


def src_year_range(spark, sf_dir):
    path = scratch_path(spark, "obs_years")
    obs = _t(spark, sf_dir).lineitem_obs().select(*OBS_COLS).withColumn("year", F.year("date"))
    table_sinks.write_partitioned(obs, path, ["year"], ["id", "date"])
    return table_sources.read_years(spark, path, 1996, 1998)


def ingest_csv_to_parquet(spark, sf_dir):
    """Yearly CSV files -> typed observations -> Parquet folders per year."""
    src, out = scratch_path(spark, "raw_csv"), scratch_path(spark, "converted")
    file_sinks.write_observations_csv(_t(spark, sf_dir).lineitem_obs(), src)
    file_sinks.convert_observations(csv_sources.read_observations_csv(spark, src), out)
    return spark.read.parquet(out)


def stream_ingest(spark, sf_dir):
    """New yearly CSV files -> Parquet, incrementally (two arrivals)."""
    from meteora.streaming import ingest_available

    obs = _t(spark, sf_dir).lineitem_obs()
    src, target = scratch_path(spark, "landing"), scratch_path(spark, "ingested")
    ckpt = scratch_path(spark, "ingest_ckpt")
    # first arrival: years up to 1998; second: the rest (a second run picks up
    # only the new files)
    early = F.coalesce(F.year("date") <= 1998, F.lit(False))
    file_sinks.write_observations_csv(obs.where(early), f"{src}/early")
    ingest_available(spark, f"{src}/*", target, ckpt)
    file_sinks.write_observations_csv(obs.where(~early), f"{src}/late")
    ingest_available(spark, f"{src}/*", target, ckpt)
    return spark.read.parquet(target)


# -- sinks -------------------------------------------------------------------
def sink_parquet(spark, sf_dir):
    path = scratch_path(spark, "daily_parquet")
    file_sinks.write_parquet(rounded(aggregate.to_daily(_t(spark, sf_dir).events_obs(), EV_OPTS)), path)
    return spark.read.parquet(path)


def sink_csv_quoted(spark, sf_dir):
    path = scratch_path(spark, "stations_csv")
    st = _t(spark, sf_dir).supplier_stations().drop("country_code")
    file_sinks.write_csv_quoted(st, path)
    return csv_sources.read_csv_with_schema(spark, path, st.schema)


def sink_ctas_plain(spark, sf_dir):
    t = _t(spark, sf_dir)
    dim = dimensions.station_country(t.customer_stations(), t.countries())
    return table_sinks.create_or_replace_table(dim, unique_name("station_country"), scratch_path(spark, "ctas"))


def sink_ctas_partitioned(spark, sf_dir):
    obs = _t(spark, sf_dir).events_obs().select(*OBS_COLS)
    return table_sinks.create_or_replace_table(
        obs, unique_name("obs_by_day"), scratch_path(spark, "ctas_day"), partition_by=["date"], cluster_by=["id"]
    )


def _fact_daily_li(spark, sf_dir, opts=CANONICAL, stations_where=None):
    t = _t(spark, sf_dir)
    return rounded(facts.fact_daily(t.lineitem_obs(), t.supplier_stations(), t.countries(), _opts(opts),
                                    stations_where=stations_where))


def _fact_yearly_li(spark, sf_dir, opts=CANONICAL):
    t = _t(spark, sf_dir)
    return rounded(facts.fact_yearly(t.lineitem_obs(), t.supplier_stations(), t.countries(), _opts(opts)))


def sink_fact_daily(spark, sf_dir):
    path = scratch_path(spark, "fact_daily")
    table_sinks.write_fact_daily(_fact_daily_li(spark, sf_dir), path)
    return spark.read.parquet(path)


def sink_fact_yearly(spark, sf_dir):
    path = scratch_path(spark, "fact_yearly")
    table_sinks.write_fact_yearly(_fact_yearly_li(spark, sf_dir), path)
    return spark.read.parquet(path)


def sink_fact_yearly_clustered(spark, sf_dir):
    """The batch job's yearly layout: one table range-clustered by date and country."""
    path = scratch_path(spark, "fact_yearly_clustered")
    table_sinks.write_clustered(_fact_yearly_li(spark, sf_dir), path, ["date", "country_code"])
    return spark.read.parquet(path)


def sink_typed_table(spark, sf_dir):
    """Observations into a table with the fixed observation schema."""
    obs = _t(spark, sf_dir).events_obs()
    return table_sinks.create_typed_table(obs, unique_name("obs_typed"), OBS_SCHEMA, scratch_path(spark, "typed"))


def sink_create_append(spark, sf_dir):
    """Create-if-absent then append: two loads of different years."""
    obs = _t(spark, sf_dir).lineitem_obs().select(*OBS_COLS)
    name, path = unique_name("obs_appended"), scratch_path(spark, "appended")
    early = F.coalesce(F.year("date") < 1998, F.lit(False))  # a row without a date goes to the second load
    table_sinks.append_table(obs.where(early), name, path)
    return table_sinks.append_table(obs.where(~early), name, path)


def sink_overwrite_append(spark, sf_dir):
    path = scratch_path(spark, "fact_yearly_append")
    fact = table_sinks.with_year(_fact_yearly_li(spark, sf_dir))
    early = F.coalesce(F.col("year") <= 1997, F.lit(False))
    table_sinks.write_years([fact.where(early), fact.where(~early)], path,
                            cluster_by=["country_code", "id"])
    return spark.read.parquet(path)


def sink_refresh_year(spark, sf_dir):
    path = scratch_path(spark, "obs_refresh")
    obs = _t(spark, sf_dir).lineitem_obs().select(*OBS_COLS).withColumn("year", F.year("date"))
    # First load: the last year is only half there (a snapshot taken mid-year).
    snapshot = obs.where((F.col("year") < 2001) | (F.col("date") < F.lit("2001-07-01").cast("date")))
    table_sinks.write_partitioned(snapshot, path, ["year"], ["id", "date"])
    # Daily refresh: the whole current year replaces its partition, twice.
    for _ in range(2):
        table_sinks.refresh_partitions(obs.where(F.col("year") == 2001), path, ["year"], ["id", "date"], years=[2001])
    return spark.read.parquet(path)


def sink_format_options(spark, sf_dir):
    """Any format by name and options, written and read back."""
    path = scratch_path(spark, "fact_orc")
    table_sinks.write_table(_fact_yearly_li(spark, sf_dir), "orc", "overwrite", path, compression="zlib")
    return table_sources.read_table(spark, "orc", path)


def src_year_files(spark, sf_dir):
    """A folder of one <year>.parquet per year, read for a range of years."""
    path = scratch_path(spark, "year_files")
    file_sinks.write_year_files(_t(spark, sf_dir).lineitem_obs().select(*OBS_COLS), path, "parquet")
    return table_sources.read_years(spark, path, 1996, 1998)


def src_csv_strict(spark, sf_dir):
    """Yearly CSV files beside a file that is none; the strict reader takes each year's one file.

    Rows without a date belong to no year and so to no file."""
    path = scratch_path(spark, "strict_csv")
    obs = _t(spark, sf_dir).lineitem_obs()
    years = file_sinks.write_year_files(obs, path, "csv", csv_compression={1997: "gzip"})
    obs.select("id").write.text(f"{path}/1996.csv.md5")
    return csv_sources.read_observations_csv(spark, csv_sources.year_files(spark, path, min(years), max(years)))


def _bucketed_obs(spark, sf_dir):
    """The name of a table of the observations (with their order column) in year folders, bucketed by station into
    as many buckets as its rows need."""
    obs = _t(spark, sf_dir).lineitem_obs().withColumn("year", F.year("date"))
    by, buckets = bucketed.plan_buckets(obs, ["id"], ["id", "date"])
    name = unique_name("obs_bucketed")
    bucketed.create_bucketed_table(obs, name, scratch_path(spark, "obs_bucketed"), by, buckets, ["date"], ["year"])
    return name


def sink_bucketed(spark, sf_dir):
    """A table in year folders, bucketed by station, of which the last year is refreshed."""
    source = _bucketed_obs(spark, sf_dir)
    table, name = spark.table(source), unique_name("obs_bucketed")
    half = table.where("year < 2001 OR year IS NULL OR month(date) < 7")
    by, buckets = bucketed.bucketing(spark, source)
    bucketed.create_bucketed_table(half, name, scratch_path(spark, "obs_bucketed"), by, buckets, ["date"], ["year"])
    bucketed.refresh_bucketed(table.where("year = 2001"), name, [2001])
    return spark.table(name).select(*OBS_COLS, "year")


def agg_daily_bucketed(spark, sf_dir):
    """The daily average of a bucketed table: no exchange."""
    return rounded(aggregate.to_daily(spark.table(_bucketed_obs(spark, sf_dir)), EV_OPTS))


def agg_yearly_bucketed(spark, sf_dir):
    """The yearly average of a bucketed table: no exchange."""
    return rounded(aggregate.to_yearly(spark.table(_bucketed_obs(spark, sf_dir)), EV_OPTS))


def join_bucketed(spark, sf_dir):
    """Daily averages and stations, both bucketed by station: neither the aggregate nor the join has an exchange."""
    obs = _bucketed_obs(spark, sf_dir)
    st = dimensions.stations_dim(_t(spark, sf_dir).supplier_stations())
    st = bucketed.create_bucketed_table(st, unique_name("stations_bucketed"), scratch_path(spark, "stations_bucketed"),
                                        ["id"], bucketed.bucketing(spark, obs)[1])
    return rounded(aggregate.to_daily(spark.table(obs), EV_OPTS)).join(st, "id", "inner")


def sink_store_refresh(spark, sf_dir):
    """A versioned table: a full write, a refresh of the current year that fails, and one that succeeds twice."""
    obs = _t(spark, sf_dir).lineitem_obs().select(*OBS_COLS).withColumn("year", F.year("date"))
    store = Store(spark, scratch_path(spark, "store"))
    store.replace("obs", obs.where("year IS NULL OR year < 2001 OR month(date) < 7"), ["year"], ["id", "date"])
    try:
        store.refresh("obs", obs.where("year >= 2000"), ["year=2001"], ["id", "date"])  # rows of another year
    except Exception as exc:
        if "outside of the keys" not in str(exc):
            raise
    for _ in range(2):
        store.refresh("obs", obs.where("year = 2001"), ["year=2001"], ["id", "date"])
    store.clean(keep=1, older_than_ms=0)
    return store.read("obs")


def _republished(spark, sf_dir, load):
    """Yearly CSV files, the last year's only half there; loaded, published again whole, loaded twice more."""
    obs = _t(spark, sf_dir).lineitem_obs()
    src = scratch_path(spark, "landing")
    years = file_sinks.write_year_files(obs.where("year(date) < 2001 OR month(date) < 7"), src, "csv")
    load(src)
    file_sinks.write_observations_csv(obs.where(F.year("date") == max(years)), f"{src}/{max(years)}.csv")
    load(src)
    load(src)


def sink_ledger(spark, sf_dir):
    """Files loaded once each; a year published again replaces its rows."""
    target = scratch_path(spark, "loaded")
    _republished(spark, sf_dir, lambda src: ledger.load(spark, src, target))
    return ledger.loaded(spark, target)


def stream_ledger(spark, sf_dir):
    """The same through a stream of file names."""
    from meteora.streaming import ingest_with_ledger

    target, ckpt = scratch_path(spark, "loaded"), scratch_path(spark, "ledger_ckpt")
    _republished(spark, sf_dir, lambda src: ingest_with_ledger(spark, src, target, ckpt))
    return ledger.loaded(spark, target)


def _incremental(spark, sf_dir, opts=CANONICAL):
    """Facts built from an early state of the observations, then changed by late, corrected and removed rows."""
    t = _t(spark, sf_dir)
    now = t.lineitem_obs()
    late = F.col("seq") % 13 == 0
    wrong = F.col("seq") % 17 == 0
    extra = now.where("seq % 19 = 0").withColumns({"seq": -F.col("seq") - 1, "value": F.col("value") + 400})
    before = now.where(~late).withColumn("value", F.when(wrong, F.col("value") - 7).otherwise(F.col("value"))).unionByName(extra)
    facts_ = IncrementalFacts(spark, scratch_path(spark, "incremental"), _opts(opts))
    dims = (t.supplier_stations(), t.countries())
    facts_.build(before, *dims)
    facts_.apply(now, touched_days(now.where(late), now.where(wrong), extra), *dims)
    return facts_


def fact_daily_incremental(spark, sf_dir):
    """The daily fact after a change, from stored partials."""
    return rounded(_incremental(spark, sf_dir).daily())


def fact_yearly_incremental(spark, sf_dir):
    """The yearly fact after a change, from stored partials."""
    return rounded(_incremental(spark, sf_dir).yearly())


def _mixed_files(spark, sf_dir):
    """CSV lines some of which are broken, beside a file that is no CSV."""
    path = scratch_path(spark, "mixed")
    obs = _t(spark, sf_dir).lineitem_obs()
    seq, text = F.col("seq"), lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    date = F.when(seq % 107 == 0, F.lit("20011399")).otherwise(F.coalesce(F.date_format("date", "yyyyMMdd"), F.lit("")))
    value = F.when(seq % 103 == 0, F.lit("n/a")).otherwise(text("value"))
    line = F.concat_ws(",", "id", date, "element", value, text("m_flag"), text("q_flag"), text("s_flag"), text("obs_time"))
    obs.select(F.when(seq % 101 == 0, F.substring_index(line, ",", 5)).otherwise(line)).write.text(f"{path}/all.csv")
    obs.select("id").write.text(f"{path}/notes.txt")
    return rejects.split_observations(spark, path, scratch_path(spark, "split"), most_rejected=0.05)


def src_accepted(spark, sf_dir):
    """The observations of files with broken lines."""
    return _mixed_files(spark, sf_dir).accepted


def src_rejected(spark, sf_dir):
    """The lines and files that are no observations, with the reason."""
    return _mixed_files(spark, sf_dir).rejected.select("line", "reason")


# -- views and projections ---------------------------------------------------
def view_stations(spark, sf_dir):
    name = unique_name("staged_stations")
    dimensions.stations_view(_t(spark, sf_dir).customer_stations(embed_country=True)).createOrReplaceTempView(name)
    return spark.table(name)


def view_countries(spark, sf_dir):
    name = unique_name("staged_countries")
    dimensions.countries_view(_t(spark, sf_dir).countries()).createOrReplaceTempView(name)
    return spark.table(name)


def proj_parse_date(spark, sf_dir):
    obs = _t(spark, sf_dir).events_obs().withColumn("date", F.date_format("date", "yyyyMMdd"))
    return obs.withColumn("parsed_date", fn.parse_date("date")).drop("date").withColumnsRenamed(
        {"parsed_date": "date"}
    ).select(*OBS_COLS)


def proj_dims(spark, sf_dir):
    return dimensions.stations_dim(_t(spark, sf_dir).customer_stations())


def proj_todf(spark, sf_dir):
    """The job's positional rename of default aggregate names."""
    rows = pivot.explode_elements(cleaning.clean(_t(spark, sf_dir).events_obs(), JOB), JOB, keep=("seq",))
    raw = rows.withColumns(aggregate.pack_flags()).groupBy("id", "date").agg(
        *[F.avg(m) for m in MEASURES], *[F.min_by(c, "seq") for c in aggregate.FLAGS]
    )
    named = raw.toDF("id", "date", *MEASURES, *aggregate.FLAGS)
    return rounded(named.select("id", "date", *MEASURES, *aggregate.unpack_flags()))


def filter_quality(spark, sf_dir):
    return cleaning.drop_flagged(_t(spark, sf_dir).events_obs()).select(*OBS_COLS)


def clip_range(spark, sf_dir):
    obs = _t(spark, sf_dir).events_obs()
    return obs.select("id", "date", "element", "value", fn.clip_raw("value", 700).alias("clipped"))


def pivot_case(spark, sf_dir):
    obs = cleaning.clean(_t(spark, sf_dir).events_obs(), EV_OPTS)
    return rounded(pivot.explode_elements(obs, EV_OPTS))


def pivot_native(spark, sf_dir):
    obs = cleaning.clean(_t(spark, sf_dir).events_obs(), EV_OPTS)
    return rounded(pivot.pivot_native(obs, EV_OPTS))


# -- joins -------------------------------------------------------------------
def join_stations(spark, sf_dir):
    t = _t(spark, sf_dir)
    daily = rounded(aggregate.to_daily(t.events_obs(), EV_OPTS))
    st = checked_broadcast(dimensions.stations_dim(t.customer_stations()))
    return daily.join(st, "id", "inner")


def join_snowflake(spark, sf_dir):
    t = _t(spark, sf_dir)
    return dimensions.station_country(t.supplier_stations(), t.countries())


# -- aggregates ----------------------------------------------------------------
def agg_daily(spark, sf_dir):
    return rounded(aggregate.to_daily(_t(spark, sf_dir).events_obs(), EV_OPTS))


def agg_yearly(spark, sf_dir):
    return rounded(aggregate.to_yearly(_t(spark, sf_dir).lineitem_obs(), EV_OPTS))


def agg_first_flags(spark, sf_dir):
    return aggregate.first_flags(_t(spark, sf_dir).events_obs(), EV_OPTS)


def agg_first_flags_nulls(spark, sf_dir):
    """Null, longer and non-ASCII flags, and an order column that is null in some rows."""
    obs = _t(spark, sf_dir).events_obs_odd_flags()
    return aggregate.first_flags(obs, CANONICAL.with_order("seq", "seq0"))


# -- windows -------------------------------------------------------------------
def win_avg_daily(spark, sf_dir):
    return rounded(window.window_avg(_t(spark, sf_dir).events_obs(), EV_OPTS))


def win_avg_yearly(spark, sf_dir):
    return rounded(window.window_avg(_t(spark, sf_dir).lineitem_obs(), EV_OPTS, yearly=True))


def win_dedup_daily(spark, sf_dir):
    return rounded(window.window_dedup(_t(spark, sf_dir).events_obs(), EV_OPTS))


def win_dedup_yearly(spark, sf_dir):
    return rounded(window.window_dedup(_t(spark, sf_dir).lineitem_obs(), EV_OPTS, yearly=True))


# -- limit, union ----------------------------------------------------------------
def limit_sample(spark, sf_dir):
    """Trial run: the first 500 fact rows by station and day."""
    t = _t(spark, sf_dir)
    return rounded(facts.first_fact_rows(t.lineitem_obs(), t.supplier_stations(), t.countries(), _opts(), 500))


def _year_tables(spark, sf_dir):
    """One relation per year, as the per-year tables: the observations are
    written once partitioned by year and each year reads only its folder."""
    path = scratch_path(spark, "obs_year_tables")
    obs = _t(spark, sf_dir).lineitem_obs().withColumn("year", F.year("date"))
    table_sinks.write_partitioned(obs, path, ["year"], ["id", "date"])
    years = sorted(r["year"] for r in spark.read.parquet(path).select("year").distinct().collect())
    return [table_sources.read_years(spark, path, y, y).drop("year") for y in years]


def union_years(spark, sf_dir):
    frames = _year_tables(spark, sf_dir)
    return rounded(setops.union_all(aggregate.to_daily(o, EV_OPTS) for o in frames))


def union_years_avg(spark, sf_dir):
    frames = _year_tables(spark, sf_dir)
    return rounded(setops.union_all(aggregate.to_yearly(o, EV_OPTS) for o in frames))


# -- scalar functions ------------------------------------------------------------
def fn_substring(spark, sf_dir):
    st = _t(spark, sf_dir).customer_stations(embed_country=True)
    # Position 0 is read as 1 by Spark's substring, as in the batch job.
    return st.select("id", F.substring("id", 0, 2).alias("country_code"))


def fn_concat_ws(spark, sf_dir):
    st = _t(spark, sf_dir).customer_stations()
    return st.select("id", fn.quote_join("id", "name", "country_code").alias("line"))


def fn_int_to_date(spark, sf_dir):
    obs = _t(spark, sf_dir).events_obs()
    as_int = (F.year("date") * 10000 + F.month("date") * 100 + F.dayofmonth("date")).cast("int")
    return obs.select("id", as_int.alias("date_int")).withColumn("date", fn.int_to_date("date_int"))


def fn_trunc_year(spark, sf_dir):
    return _t(spark, sf_dir).lineitem_obs().select("id", "date", fn.trunc_year("date").alias("year_start"))


def fn_trunc_year_ts(spark, sf_dir):
    return _t(spark, sf_dir).lineitem_obs().select("id", "date", fn.trunc_year_ts("date").alias("year_start"))


def fn_extract_year(spark, sf_dir):
    return _t(spark, sf_dir).lineitem_obs().select("id", "date", fn.extract_year("date").alias("year"))


def fn_scale_tenths(spark, sf_dir):
    return _t(spark, sf_dir).events_obs().select("id", "value", fn.scale("value", 10).alias("scaled"))


def fn_int_div(spark, sf_dir):
    return _t(spark, sf_dir).events_obs().select("id", "value", fn.int_div("value", 10).alias("tenths_div"))


def fn_cast_numeric(spark, sf_dir):
    obs = _t(spark, sf_dir).events_obs()
    return obs.select("id", "value", fn.cast_numeric(fn.scale("value", 10), "decimal(38,9)").alias("numeric_value"))


def fn_format_year(spark, sf_dir):
    return _t(spark, sf_dir).lineitem_obs().select("id", "date", fn.format_year("date").alias("year_text"))


def _year_functions(spark, sf_dir):
    obs = _t(spark, sf_dir).lineitem_obs().withColumn("year", F.year("date"))
    years = [r["year"] for r in obs.select("year").where("year IS NOT NULL").distinct().collect()]
    suffix = unique_name("t")
    table_functions.register(obs, f"obs_{suffix}", EV_OPTS, f"daily_{suffix}", f"yearly_{suffix}")
    return years, f"daily_{suffix}", f"yearly_{suffix}"


def fn_table_daily(spark, sf_dir):
    """The daily transform as a table function, joined laterally with all years."""
    years, name, _ = _year_functions(spark, sf_dir)
    return rounded(table_functions.for_years(spark, years, name))


def fn_table_yearly(spark, sf_dir):
    """The yearly transform as a table function, joined laterally with all years."""
    years, _, name = _year_functions(spark, sf_dir)
    return rounded(table_functions.for_years(spark, years, name))


# -- facts -------------------------------------------------------------------------
def fact_daily(spark, sf_dir, opts=CANONICAL):
    t = _t(spark, sf_dir)
    return rounded(facts.fact_daily(t.events_obs(), t.customer_stations(), t.countries(), _opts(opts)))


def fact_yearly(spark, sf_dir):
    return _fact_yearly_li(spark, sf_dir)


def fact_daily_local(spark, sf_dir):
    return fact_daily(spark, sf_dir, LOCAL)


def fact_daily_job(spark, sf_dir):
    return fact_daily(spark, sf_dir, JOB)


def fact_yearly_local(spark, sf_dir):
    return _fact_yearly_li(spark, sf_dir, LOCAL)


def fact_yearly_job(spark, sf_dir):
    return _fact_yearly_li(spark, sf_dir, JOB)


def _both_facts_li(spark, sf_dir):
    t = _t(spark, sf_dir)
    return facts.both_facts(t.lineitem_obs(), t.supplier_stations(), t.countries(), _opts(),
                            scratch_path(spark, "daily_parts"))


def fact_daily_default_order(spark, sf_dir):
    """The job's order (a hash of the row); flags that depend on station and day alone."""
    t = _t(spark, sf_dir)
    return rounded(facts.fact_daily(t.events_obs_odd_flags(by_group=True), t.customer_stations(), t.countries(), CANONICAL))


def _both_facts(spark, sf_dir, opts):
    t = _t(spark, sf_dir)
    return facts.both_facts(t.lineitem_obs(), t.supplier_stations(), t.countries(), _opts(opts), scratch_path(spark, "daily_parts"))


def _declared(df):
    """Decimal measures in units of their last digit, as text: compared unrounded."""
    return df.withColumns({m: (F.col(m) * 1_000_000_000).cast("decimal(38,0)").cast("string") for m in MEASURES})


def job_fact_daily_local(spark, sf_dir):
    return _declared(_both_facts(spark, sf_dir, LOCAL)[0])


def job_fact_yearly_local(spark, sf_dir):
    return _declared(_both_facts(spark, sf_dir, LOCAL)[1])


def job_fact_daily_job(spark, sf_dir):
    return rounded(_both_facts(spark, sf_dir, JOB)[0])


def job_fact_yearly_job(spark, sf_dir):
    return rounded(_both_facts(spark, sf_dir, JOB)[1])


def job_fact_daily(spark, sf_dir):
    """Daily fact of the one-scan job path (partials written once)."""
    return rounded(_both_facts_li(spark, sf_dir)[0])


def job_fact_yearly(spark, sf_dir):
    """Yearly fact rolled up from the written daily partials."""
    return rounded(_both_facts_li(spark, sf_dir)[1])


# -- analytic questions ----------------------------------------------------------
def q_max_by_country_year(spark, sf_dir):
    return analytics.max_by_country_year(_fact_daily_li(spark, sf_dir))


def q_compare_yearly(spark, sf_dir):
    places = {"place_a": analytics.in_country("NATION_3"), "place_b": analytics.in_country("NATION_7")}
    # only the two places' observations are aggregated
    fact = _fact_daily_li(spark, sf_dir, stations_where=analytics.any_place(places))
    return rounded(analytics.compare_yearly(fact, places, "tmin"), ["place_a", "place_b"])


def q_top_hottest(spark, sf_dir):
    place = analytics.in_country("NATION_5")
    return analytics.top_hottest(_fact_daily_li(spark, sf_dir, stations_where=place), place, 10)


def q_max_stored_fact(spark, sf_dir):
    """The question asked of the stored daily fact (partitioned by year,
    sorted by country and station): one year folder is read, the country
    filter is pushed into the scan."""
    path = scratch_path(spark, "fact_daily_served")
    table_sinks.write_fact_daily(_fact_daily_li(spark, sf_dir), path)
    return analytics.max_by_country_year(table_sources.read_parquet(spark, path), "NATION_3", 1996)


def q_top_hottest_stored(spark, sf_dir):
    """Hottest days at a place named by station name, asked of the stored
    daily fact: the place is resolved in the station dimension, and the fact
    scan reads only the row groups of those stations."""
    t = _t(spark, sf_dir)
    path = scratch_path(spark, "fact_daily_served")
    table_sinks.write_fact_daily(_fact_daily_li(spark, sf_dir), path)
    place = analytics.station_named("Supplier#00000001_")
    stations = dimensions.station_country(t.supplier_stations(), t.countries())
    rows = analytics.at_place(table_sources.read_parquet(spark, path), stations, place)
    return analytics.top_hottest(rows, None, 10).drop("year")


def q_top_hottest_membership(spark, sf_dir):
    """Hottest days at a place named by station name, asked of a daily fact kept in order of
    date: its row groups are excluded by Bloom filters on the station id."""
    t = _t(spark, sf_dir)
    path = scratch_path(spark, "fact_daily_membership")
    fact = table_sinks.with_year(_fact_daily_li(spark, sf_dir))
    membership.write_with_membership(fact, path, ["id"], 10_000, ["year"], ["date"])
    stations = dimensions.station_country(t.supplier_stations(), t.countries())
    rows = analytics.at_few_stations(table_sources.read_parquet(spark, path), stations, analytics.station_named("Supplier#00000001_"))
    return analytics.top_hottest(rows, None, 10).drop("year")


def q_compare_yearly_stored(spark, sf_dir):
    """Yearly comparison of two places named by station, asked of the stored
    daily fact: only the two places' stations are read."""
    t = _t(spark, sf_dir)
    path = scratch_path(spark, "fact_daily_served")
    table_sinks.write_fact_daily(_fact_daily_li(spark, sf_dir), path)
    places = {"place_a": analytics.station_named("Supplier#00000001_"),
              "place_b": analytics.station_named("Supplier#00000002_")}
    stations = dimensions.station_country(t.supplier_stations(), t.countries())
    rows = analytics.at_place(table_sources.read_parquet(spark, path), stations, analytics.any_place(places))
    return rounded(analytics.compare_yearly(rows, places, "tmin"), ["place_a", "place_b"])


def q_record_counts(spark, sf_dir):
    return analytics.record_counts(_fact_daily_li(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: obj
    for name, obj in list(globals().items())
    if callable(obj) and not name.startswith("_") and name.split("_")[0] in
    {"src", "sink", "view", "proj", "filter", "clip", "pivot", "join", "agg", "win", "limit", "union", "fn",
     "fact", "q", "job", "stream", "ingest"}
}

"""DuckDB SQL twins of the registered queries (the correctness oracles).

Written from the semantics of the SQL models: clean -> explode -> average
per station/period with the first row's flags -> inner joins with stations
and countries.  Measures are rounded to 6 decimals on both sides, so the
order of floating-point summation does not matter.
"""

from __future__ import annotations

from meteora.options import CANONICAL, JOB, LOCAL, TransformOptions
from meteora.plans.testmap import (
    SQL_COUNTRIES,
    SQL_EVENTS_OBS,
    SQL_LINEITEM_OBS,
    sql_events_obs_odd_flags,
    sql_customer_stations,
    sql_supplier_stations,
)
from meteora.schemas import CLIPPED_ELEMENTS, ELEMENTS, FACT_COLUMNS, JOB_FACT_COLUMNS, MEASURES, TENTHS_ELEMENTS

OBS_COLS = "id, date, element, value, m_flag, q_flag, s_flag, obs_time"


def r6(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {alias}"


def sql_measure(element: str, opts: TransformOptions) -> str:
    raw = "value"
    if element in CLIPPED_ELEMENTS and opts.clip_raw is not None:
        raw = f"CASE WHEN value BETWEEN -{opts.clip_raw} AND {opts.clip_raw} THEN value END"
    divisor = (opts.prcp_divisor if element == "PRCP" else 10) if element in TENTHS_ELEMENTS else 1
    if divisor == 1:
        scaled = f"CAST({raw} AS {opts.measure_type})"
    elif opts.integer_division:
        scaled = f"CAST(({raw}) // {divisor} AS {opts.measure_type})"
    else:
        scaled = f"CAST(CAST({raw} AS DOUBLE) / {divisor} AS {opts.measure_type})"
    return f"CASE WHEN element = '{element}' THEN {scaled} END"


def sql_cleaned(src: str, opts: TransformOptions) -> str:
    where = " WHERE q_flag = ''" if opts.drop_flagged else ""
    return f"SELECT * FROM ({src}) AS o{where}"


def sql_exploded(src: str, opts: TransformOptions, keep: str = "") -> str:
    ms = ",\n       ".join(f"{sql_measure(e, opts)} AS {m}" for e, m in zip(ELEMENTS, MEASURES))
    return f"SELECT id, date,\n       {ms},\n       m_flag, s_flag{keep}\nFROM ({sql_cleaned(src, opts)}) AS c"


def sql_wide(src: str, opts: TransformOptions, yearly: bool = False, rounded: bool = True) -> str:
    year_type = "TIMESTAMP" if opts.year_start == "timestamp" else "DATE"
    period = f"CAST(date_trunc('year', date) AS {year_type})" if yearly else "date"
    avgs = ", ".join((r6(f"avg({m})", m) if rounded else f"avg({m}) AS {m}") for m in MEASURES)
    return (
        f"SELECT id, {period} AS date, {avgs},\n"
        f"       arg_min(m_flag, seq) AS m_flag, arg_min(s_flag, seq) AS s_flag\n"
        f"FROM ({sql_exploded(src, opts, keep=', seq')}) AS x\nGROUP BY id, {period}"
    )


def sql_wide_exact(src: str, opts: TransformOptions, yearly: bool = False) -> str:
    """Decimal averages in units of their ninth digit, half away from zero, as text."""
    year_type = "TIMESTAMP" if opts.year_start == "timestamp" else "DATE"
    period = f"CAST(date_trunc('year', date) AS {year_type})" if yearly else "date"
    total = lambda m: f"CAST(sum({m}) AS HUGEINT)"
    avgs = ", ".join(
        f"CAST(sign({total(m)}) * ((abs({total(m)}) * 2000000000 + count({m})) // nullif(2 * count({m}), 0)) AS VARCHAR) AS {m}"
        for m in MEASURES)
    return (
        f"SELECT id, {period} AS date, {avgs}, arg_min(m_flag, seq) AS m_flag, arg_min(s_flag, seq) AS s_flag\n"
        f"FROM ({sql_exploded(src, opts, keep=', seq')}) AS x\nGROUP BY id, {period}"
    )


def sql_station_country(stations: str) -> str:
    return (
        f"SELECT st.id, st.latitude, st.longitude, st.elevation, st.name AS station_name, st.country_code, "
        f"co.name AS country_name\nFROM ({stations}) AS st JOIN ({SQL_COUNTRIES}) AS co ON st.country_code = co.code"
    )


def sql_enrich(wide: str, stations: str, columns=FACT_COLUMNS) -> str:
    cols = ", ".join(f"{'w' if c in ('id', 'date', *MEASURES, 'm_flag', 's_flag') else 'd'}.{c}" for c in columns)
    return f"SELECT {cols}\nFROM ({wide}) AS w JOIN ({sql_station_country(stations)}) AS d ON w.id = d.id"


def sql_fact(src: str, stations: str, opts: TransformOptions = CANONICAL, yearly: bool = False) -> str:
    columns = JOB_FACT_COLUMNS if opts.column_order == "job" else FACT_COLUMNS
    return sql_enrich(sql_wide(src, opts, yearly), stations, columns)


EV, LI = SQL_EVENTS_OBS, SQL_LINEITEM_OBS
ST_C, ST_S = sql_customer_stations(), sql_supplier_stations()
FACT_DAILY_EV = sql_fact(EV, ST_C)
FACT_DAILY_LI = sql_fact(LI, ST_S)
FACT_YEARLY_LI = sql_fact(LI, ST_S, yearly=True)
MEAS_R6 = ", ".join(r6(m, m) for m in MEASURES)


def _obs(src: str) -> str:
    return f"SELECT {OBS_COLS} FROM ({src}) AS o"


def _window_avg(src: str, yearly: bool) -> str:
    part = "id, year(date)" if yearly else "id, date"
    date = "CAST(date_trunc('year', date) AS DATE)" if yearly else "date"
    avgs = ", ".join(r6(f"avg({m}) OVER (PARTITION BY {part})", m) for m in MEASURES)
    return f"SELECT id, {date} AS date, m_flag, s_flag, {avgs}\nFROM ({sql_exploded(src, CANONICAL)}) AS x"


def _window_dedup(src: str, yearly: bool) -> str:
    part = "id, year(date)" if yearly else "id, date"
    date = "CAST(date_trunc('year', date) AS DATE)" if yearly else "date"
    avgs = ", ".join(f"avg({m}) OVER (PARTITION BY {part}) AS {m}" for m in MEASURES)
    inner = (
        f"SELECT id, {date} AS date, m_flag, s_flag, {avgs}, "
        f"row_number() OVER (PARTITION BY {part} ORDER BY seq) AS rn\n"
        f"FROM ({sql_exploded(src, CANONICAL, keep=', seq')}) AS x"
    )
    return f"SELECT id, date, {MEAS_R6}, m_flag, s_flag FROM ({inner}) AS a WHERE rn = 1"


def _year_int(expr: str = "date") -> str:
    return f"CAST(year({expr}) AS INTEGER)"


def oracles() -> dict[str, str]:
    fact_cols = ", ".join(FACT_COLUMNS)
    q: dict[str, str] = {}
    # sources ---------------------------------------------------------------
    q["src_parquet"] = _obs(EV)
    q["src_csv_headerless"] = _obs(EV)
    q["src_csv_gzip"] = _obs(LI)
    q["src_csv_inferred"] = (
        "SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"
    )
    q["src_fixed_width"] = f"SELECT * EXCLUDE (country_code) FROM ({ST_C}) AS s"
    q["src_fixed_width_countries"] = SQL_COUNTRIES
    q["src_external_table"] = _obs(EV)
    q["src_format_options"] = _obs(LI)
    q["src_year_files"] = f"{_obs(LI)} WHERE year(date) BETWEEN 1996 AND 1998"
    q["src_csv_strict"] = f"{_obs(LI)} WHERE date IS NOT NULL"
    q["sink_format_options"] = FACT_YEARLY_LI
    q["src_year_range"] = f"SELECT {OBS_COLS}, {_year_int()} AS year FROM ({LI}) AS o WHERE year(date) BETWEEN 1996 AND 1998"
    q["ingest_csv_to_parquet"] = f"SELECT {OBS_COLS}, {_year_int()} AS year FROM ({LI}) AS o"
    q["stream_ingest"] = f"SELECT {OBS_COLS}, {_year_int()} AS year FROM ({LI}) AS o"
    # sinks -----------------------------------------------------------------
    q["sink_parquet"] = sql_wide(EV, CANONICAL)
    q["sink_csv_quoted"] = f"SELECT * EXCLUDE (country_code) FROM ({ST_S}) AS s"
    q["sink_ctas_plain"] = sql_station_country(ST_C)
    q["sink_ctas_partitioned"] = _obs(EV)
    q["sink_fact_daily"] = f"SELECT *, {_year_int()} AS year FROM ({FACT_DAILY_LI}) AS f"
    q["sink_fact_yearly"] = f"SELECT *, {_year_int()} AS year FROM ({FACT_YEARLY_LI}) AS f"
    q["sink_overwrite_append"] = f"SELECT *, {_year_int()} AS year FROM ({FACT_YEARLY_LI}) AS f"
    q["sink_fact_yearly_clustered"] = FACT_YEARLY_LI
    q["sink_typed_table"] = _obs(EV)
    q["sink_create_append"] = _obs(LI)
    q["sink_refresh_year"] = f"SELECT {OBS_COLS}, {_year_int()} AS year FROM ({LI}) AS o"
    broken = "seq % 101 = 0 OR seq % 103 = 0 OR seq % 107 = 0"
    q["src_accepted"] = f"{_obs(LI)} WHERE NOT ({broken})"
    day = "CASE WHEN seq % 107 = 0 THEN '20011399' ELSE coalesce(strftime(date, '%Y%m%d'), '') END"
    head = f"id || ',' || {day} || ',' || element || ',' || CASE WHEN seq % 103 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END || ',' || m_flag"
    q["src_rejected"] = (
        f"SELECT CASE WHEN seq % 101 = 0 THEN {head} ELSE {head} || ',' || q_flag || ',' || s_flag || ',' END AS line, "
        "CASE WHEN seq % 101 = 0 THEN 'number of fields' WHEN seq % 103 = 0 THEN 'value' ELSE 'date' END AS reason "
        f"FROM ({LI}) AS o WHERE {broken} UNION ALL SELECT NULL, 'only .csv and .csv.gz files are read'"
    )
    q["fn_table_daily"] = f"SELECT * FROM ({sql_wide(LI, CANONICAL)}) AS w WHERE date IS NOT NULL"
    q["fn_table_yearly"] = f"SELECT * FROM ({sql_wide(LI, CANONICAL, yearly=True)}) AS w WHERE date IS NOT NULL"
    obs_year = f"SELECT {OBS_COLS}, {_year_int()} AS year FROM ({LI}) AS o"
    q["sink_bucketed"] = q["sink_store_refresh"] = obs_year
    q["sink_ledger"] = q["stream_ledger"] = f"{obs_year} WHERE date IS NOT NULL"
    q["agg_daily_bucketed"] = sql_wide(LI, CANONICAL)
    q["agg_yearly_bucketed"] = sql_wide(LI, CANONICAL, yearly=True)
    q["join_bucketed"] = (
        f"SELECT w.*, s.name AS station_name, s.latitude, s.longitude, s.elevation, s.country_code "
        f"FROM ({sql_wide(LI, CANONICAL)}) AS w JOIN ({ST_S}) AS s ON w.id = s.id"
    )
    q["fact_daily_incremental"] = f"SELECT *, {_year_int()} AS year FROM ({FACT_DAILY_LI}) AS f"
    q["fact_yearly_incremental"] = f"SELECT *, {_year_int()} AS year FROM ({FACT_YEARLY_LI}) AS f"
    # views and projections -------------------------------------------------
    q["view_stations"] = f"SELECT *, substr(id, 1, 2) AS country_code FROM ({sql_customer_stations(True)}) AS s"
    q["view_countries"] = SQL_COUNTRIES
    q["proj_parse_date"] = _obs(EV)
    q["proj_dims"] = (
        f"SELECT id, latitude, longitude, elevation, name AS station_name, country_code FROM ({ST_C}) AS s"
    )
    q["proj_todf"] = sql_wide(EV, JOB)
    q["filter_quality"] = f"SELECT {OBS_COLS} FROM ({EV}) AS o WHERE q_flag = ''"
    q["clip_range"] = (
        f"SELECT id, date, element, value, CASE WHEN value BETWEEN -700 AND 700 THEN value END AS clipped "
        f"FROM ({EV}) AS o"
    )
    q["pivot_case"] = f"SELECT id, date, {MEAS_R6}, m_flag, s_flag FROM ({sql_exploded(EV, CANONICAL)}) AS x"
    q["pivot_native"] = (
        f"SELECT id, date, {', '.join(r6(f'avg({m})', m) for m in MEASURES)} "
        f"FROM ({sql_exploded(EV, CANONICAL)}) AS x GROUP BY id, date"
    )
    # joins -----------------------------------------------------------------
    q["join_stations"] = (
        f"SELECT w.*, s.name AS station_name, s.latitude, s.longitude, s.elevation, s.country_code "
        f"FROM ({sql_wide(EV, CANONICAL)}) AS w JOIN ({ST_C}) AS s ON w.id = s.id"
    )
    q["join_snowflake"] = sql_station_country(ST_S)
    # aggregates ------------------------------------------------------------
    q["agg_daily"] = sql_wide(EV, CANONICAL)
    q["agg_yearly"] = sql_wide(LI, CANONICAL, yearly=True)
    q["agg_first_flags"] = (
        f"SELECT id, date, arg_min(m_flag, seq) AS m_flag, arg_min(s_flag, seq) AS s_flag "
        f"FROM ({EV}) AS o WHERE q_flag = '' GROUP BY id, date"
    )
    q["agg_first_flags_nulls"] = (
        "SELECT id, date, m_flag, s_flag FROM (SELECT *, row_number() OVER (PARTITION BY id, date ORDER BY seq NULLS LAST, seq0) AS rn "
        f"FROM ({sql_events_obs_odd_flags()}) AS o WHERE q_flag = '') AS a WHERE rn = 1"
    )
    # windows ---------------------------------------------------------------
    q["win_avg_daily"] = _window_avg(EV, yearly=False)
    q["win_avg_yearly"] = _window_avg(LI, yearly=True)
    q["win_dedup_daily"] = _window_dedup(EV, yearly=False)
    q["win_dedup_yearly"] = _window_dedup(LI, yearly=True)
    # limit, union ----------------------------------------------------------
    q["limit_sample"] = f"SELECT * FROM ({FACT_DAILY_LI}) AS f ORDER BY id, date LIMIT 500"
    q["union_years"] = sql_wide(LI, CANONICAL)
    q["union_years_avg"] = sql_wide(LI, CANONICAL, yearly=True)
    # scalar functions ------------------------------------------------------
    st_emb = sql_customer_stations(True)
    q["fn_substring"] = f"SELECT id, substr(id, 1, 2) AS country_code FROM ({st_emb}) AS s"
    q["fn_concat_ws"] = (
        "SELECT id, concat_ws(',', '\"' || id || '\"', '\"' || name || '\"', '\"' || country_code || '\"') AS line "
        f"FROM ({ST_C}) AS s"
    )
    q["fn_int_to_date"] = (
        "SELECT id, CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_int, date "
        f"FROM ({EV}) AS o"
    )
    q["fn_trunc_year"] = f"SELECT id, date, CAST(date_trunc('year', date) AS DATE) AS year_start FROM ({LI}) AS o"
    q["fn_trunc_year_ts"] = f"SELECT id, date, CAST(date_trunc('year', date) AS TIMESTAMP) AS year_start FROM ({LI}) AS o"
    q["fn_extract_year"] = f"SELECT id, date, {_year_int()} AS year FROM ({LI}) AS o"
    q["fn_scale_tenths"] = f"SELECT id, value, CAST(value AS DOUBLE) / 10 AS scaled FROM ({EV}) AS o"
    q["fn_int_div"] = f"SELECT id, value, value // 10 AS tenths_div FROM ({EV}) AS o"
    q["fn_cast_numeric"] = (
        f"SELECT id, value, CAST(CAST(value AS DOUBLE) / 10 AS DECIMAL(38,9)) AS numeric_value FROM ({EV}) AS o"
    )
    q["fn_format_year"] = f"SELECT id, date, strftime(date, '%Y') AS year_text FROM ({LI}) AS o"
    # facts -----------------------------------------------------------------
    q["fact_daily"] = FACT_DAILY_EV
    q["fact_yearly"] = FACT_YEARLY_LI
    q["fact_daily_local"] = sql_fact(EV, ST_C, LOCAL)
    q["fact_daily_job"] = sql_fact(EV, ST_C, JOB)
    q["fact_yearly_local"] = sql_fact(LI, ST_S, LOCAL, yearly=True)
    q["fact_yearly_job"] = sql_fact(LI, ST_S, JOB, yearly=True)
    q["job_fact_daily"] = FACT_DAILY_LI
    q["job_fact_yearly"] = FACT_YEARLY_LI
    grouped_flags = sql_events_obs_odd_flags(by_group=True).replace("CASE WHEN seq % 3 <> 0 THEN seq END AS seq", "seq")
    q["fact_daily_default_order"] = sql_fact(grouped_flags, ST_C)
    q["job_fact_daily_local"] = sql_enrich(sql_wide_exact(LI, LOCAL), ST_S)
    q["job_fact_yearly_local"] = sql_enrich(sql_wide_exact(LI, LOCAL, yearly=True), ST_S)
    q["job_fact_daily_job"] = sql_fact(LI, ST_S, JOB)
    q["job_fact_yearly_job"] = sql_fact(LI, ST_S, JOB, yearly=True)
    # analytic questions ----------------------------------------------------
    q["q_max_by_country_year"] = (
        f"SELECT country_code, country_name, {_year_int()} AS year, max(tmax) AS max_tmax "
        f"FROM ({FACT_DAILY_LI}) AS f GROUP BY country_code, country_name, year(date)"
    )
    q["q_compare_yearly"] = (
        f"SELECT {_year_int()} AS year, "
        "round(avg(CASE WHEN country_name = 'NATION_3' THEN tmin END), 6) AS place_a, "
        "round(avg(CASE WHEN country_name = 'NATION_7' THEN tmin END), 6) AS place_b "
        f"FROM ({FACT_DAILY_LI}) AS f WHERE country_name IN ('NATION_3', 'NATION_7') GROUP BY year(date)"
    )
    q["q_compare_yearly_stored"] = (
        f"SELECT {_year_int()} AS year, "
        "round(avg(CASE WHEN upper(station_name) LIKE 'SUPPLIER#00000001_' THEN tmin END), 6) AS place_a, "
        "round(avg(CASE WHEN upper(station_name) LIKE 'SUPPLIER#00000002_' THEN tmin END), 6) AS place_b "
        f"FROM ({FACT_DAILY_LI}) AS f "
        "WHERE upper(station_name) LIKE 'SUPPLIER#00000001_' OR upper(station_name) LIKE 'SUPPLIER#00000002_' "
        "GROUP BY year(date)"
    )
    q["q_top_hottest"] = (
        f"SELECT {fact_cols} FROM ({FACT_DAILY_LI}) AS f WHERE country_name = 'NATION_5' AND tmax IS NOT NULL "
        "ORDER BY tmax DESC, date, id LIMIT 10"
    )
    q["q_max_stored_fact"] = (
        f"SELECT country_code, country_name, {_year_int()} AS year, max(tmax) AS max_tmax "
        f"FROM ({FACT_DAILY_LI}) AS f WHERE country_name = 'NATION_3' AND year(date) = 1996 "
        "GROUP BY country_code, country_name, year(date)"
    )
    q["q_top_hottest_stored"] = (
        f"SELECT {fact_cols} FROM ({FACT_DAILY_LI}) AS f "
        "WHERE upper(station_name) LIKE upper('Supplier#00000001_') AND tmax IS NOT NULL "
        "ORDER BY tmax DESC, date, id LIMIT 10"
    )
    q["q_top_hottest_membership"] = q["q_top_hottest_stored"]
    q["q_record_counts"] = f"SELECT {_year_int()} AS year, count(*) AS n_records FROM ({FACT_DAILY_LI}) AS f GROUP BY year(date)"
    return q

"""The yearly transforms as SQL table functions.

``register`` makes two functions of the session, callable in a FROM clause and joined
laterally with a list of years:

    SELECT * FROM process_year_table(1996)
    SELECT f.* FROM VALUES (1996), (1997) AS y(year), LATERAL process_year_table_avg(y.year) AS f

They are SQL functions, so Spark inlines their bodies into the plan of the query: the year is a predicate on the scan, and a
lateral join over many years becomes one aggregate that is also grouped by year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from meteora.options import CANONICAL, TransformOptions
from meteora.schemas import CLIPPED_ELEMENTS, ELEMENTS, MEASURES, TENTHS_ELEMENTS

DAILY, YEARLY = "process_year_table", "process_year_table_avg"


def measure_sql(element: str, opts: TransformOptions) -> str:
    """One measure of a raw row, as ``functions.scalar.measure_value`` computes it."""
    value = "o.value"
    if element in CLIPPED_ELEMENTS and opts.clip_raw is not None:
        value = f"CASE WHEN o.value BETWEEN -{opts.clip_raw} AND {opts.clip_raw} THEN o.value END"
    divisor = (opts.prcp_divisor if element == "PRCP" else 10) if element in TENTHS_ELEMENTS else 1
    if divisor != 1:
        value = f"({value}) DIV {divisor}" if opts.integer_division else f"CAST({value} AS DOUBLE) / {divisor}"
    return f"CASE WHEN o.element = '{element}' THEN CAST({value} AS {opts.measure_type}) END"


def function_sql(name: str, table: str, opts: TransformOptions, yearly: bool) -> str:
    """The CREATE FUNCTION statement of one transform over ``table``, which has a column ``year``."""
    period_type = "TIMESTAMP_NTZ" if yearly and opts.year_start == "timestamp" else "DATE"
    period = f"CAST(trunc(o.date, 'YEAR') AS {period_type})" if yearly else "o.date"
    means = ", ".join(
        f"CAST(sum({measure_sql(e, opts)}) / count({measure_sql(e, opts)}) AS {opts.measure_type}) AS {m}" if opts.measure_type != "double" else
        f"avg({measure_sql(e, opts)}) AS {m}" for e, m in zip(ELEMENTS, MEASURES, strict=True))
    # the first row of a group: its order columns (null last), then a hash of the row
    parts = [x for c in opts.order_by or () for x in (f"o.{c} IS NULL", f"o.{c}")]
    order = f"struct({', '.join([*parts, 'xxhash64(o.element, o.value, o.m_flag, o.s_flag, o.obs_time, o.date)'])})"
    flags = ", ".join(f"min_by(coalesce(o.{f}, ''), {order}) AS {f}" for f in ("m_flag", "s_flag"))
    quality = " AND coalesce(o.q_flag, '') = ''" if opts.drop_flagged else ""
    columns = ", ".join([f"id STRING, date {period_type}", *[f"{m} {opts.measure_type.upper()}" for m in MEASURES], "m_flag STRING, s_flag STRING"])
    return (f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(wanted INT) RETURNS TABLE ({columns})\n"
            f"RETURN SELECT o.id, {period} AS date, {means}, {flags}\nFROM {table} AS o\n"
            f"WHERE o.year = {name}.wanted{quality}\nGROUP BY o.id, {period}")


def register(observations: DataFrame, view: str = "year_table_observations", opts: TransformOptions = CANONICAL,
             daily: str = DAILY, yearly: str = YEARLY) -> None:
    """Create both functions over ``observations`` (with a column ``year``), which becomes the view ``view``."""
    if "year" not in observations.columns:
        raise ValueError("the observations need a column year")
    observations.createOrReplaceTempView(view)
    for name, is_yearly in ((daily, False), (yearly, True)):
        observations.sparkSession.sql(function_sql(name, view, opts, is_yearly))


def for_years(spark, years: list[int], name: str = DAILY) -> DataFrame:
    """One of the functions joined laterally with a list of years."""
    values = ", ".join(f"({int(y)})" for y in sorted(set(years)))
    return spark.sql(f"SELECT f.* FROM VALUES {values} AS y(year), LATERAL {name}(y.year) AS f")

"""Scalar column functions of the observation transform.

All are compositions of built-in functions, so they stay inside whole-stage
code generation; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meteora.options import TransformOptions
from meteora.schemas import CLIPPED_ELEMENTS, TENTHS_ELEMENTS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def country_code(station_id: Column | str) -> Column:
    """First two characters of a station id (position 1; 0 behaves the same in Spark)."""
    return F.substring(_col(station_id), 1, 2)


def parse_date(text: Column | str, fmt: str = "yyyyMMdd") -> Column:
    """Parse 'yyyyMMdd' text into a DATE."""
    return F.to_date(_col(text), fmt)


def int_to_date(number: Column | str) -> Column:
    """An integer such as 20200131 into a DATE."""
    return F.to_date(_col(number).cast("string"), "yyyyMMdd")


def trunc_year(date: Column | str) -> Column:
    """First day of the year, as a DATE."""
    return F.trunc(_col(date), "year")


def trunc_year_ts(date: Column | str) -> Column:
    """First instant of the year as a timestamp without time zone."""
    return F.date_trunc("year", _col(date)).cast("timestamp_ntz")


def extract_year(date: Column | str) -> Column:
    return F.year(_col(date))


def format_year(date: Column | str) -> Column:
    """Year as four-digit text."""
    return F.date_format(_col(date), "yyyy")


def scale(value: Column | str, divisor: int) -> Column:
    """value / divisor as a fractional number (double)."""
    c = _col(value).cast("double")
    return c if divisor == 1 else c / F.lit(float(divisor))


def int_div(value: Column | str, divisor: int) -> Column:
    """Integer division truncating toward zero (as an INTEGER column divides)."""
    c = _col(value).cast("long")
    return c if divisor == 1 else _div(c, divisor)


def _div(c: Column, divisor: int) -> Column:
    # the SQL operator: whole numbers throughout, toward zero
    return F.call_function("div", c, F.lit(int(divisor)).cast("long"))


def cast_numeric(value: Column, measure_type: str) -> Column:
    return value.cast(measure_type)


def clip_raw(value: Column | str, bound: int | None) -> Column:
    """Null when the raw value lies outside [-bound, bound]; bounds are kept."""
    c = _col(value)
    if bound is None:
        return c
    return F.when(c.between(-bound, bound), c)


def measure_value(element: Column | str, value: Column | str, target: str, opts: TransformOptions) -> Column:
    """Value of measure ``target`` (an element name) for one raw row, else null."""
    e, v = _col(element), _col(value)
    raw = clip_raw(v, opts.clip_raw) if target in CLIPPED_ELEMENTS else v
    divisor = (opts.prcp_divisor if target == "PRCP" else 10) if target in TENTHS_ELEMENTS else 1
    if opts.integer_division:
        scaled = _div(raw.cast("long"), divisor) if divisor != 1 else raw
        scaled = scaled.cast(opts.measure_type)
    else:
        scaled = scale(raw, divisor).cast(opts.measure_type)
    return F.when(e == F.lit(target), scaled)


def quote_join(*cols: Column | str, sep: str = ",") -> Column:
    """Quote each field with double quotes and join them with ``sep``."""
    return F.concat_ws(sep, *[F.concat(F.lit('"'), F.coalesce(_col(c).cast("string"), F.lit("")), F.lit('"')) for c in cols])

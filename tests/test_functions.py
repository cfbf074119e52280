"""Scalar functions: properties checked against plain Python."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meteora import functions as fn
from meteora.operators.aggregate import pack_flags, unpack_flags
from meteora.options import CANONICAL, JOB, LOCAL
from meteora.plans.job import parse_args

import pytest

values = st.lists(st.integers(min_value=-99999, max_value=99999), min_size=1, max_size=200)


def _trunc_div(v: int, d: int) -> int:
    q = abs(v) // d
    return q if v >= 0 else -q


@settings(max_examples=8, deadline=None)
@given(values)
def test_int_div_truncates_toward_zero(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "v long")
    got = [r[0] for r in df.select(fn.int_div("v", 10)).collect()]
    assert got == [_trunc_div(x, 10) for x in xs]


@settings(max_examples=8, deadline=None)
@given(values)
def test_clip_keeps_bounds(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "v long")
    got = [r[0] for r in df.select(fn.clip_raw("v", 700)).collect()]
    assert got == [x if -700 <= x <= 700 else None for x in xs]


@settings(max_examples=8, deadline=None)
@given(values, st.sampled_from(["TMAX", "TMIN", "PRCP", "SNOW", "SNWD", "WSFG"]))
def test_measure_value_variants(spark, xs, element):
    df = spark.createDataFrame([(element, x) for x in xs], "e string, v long")
    for opts in (CANONICAL, LOCAL, JOB):
        got = [r[0] for r in df.select(fn.measure_value("e", "v", "TMAX", opts)).collect()]
        for x, g in zip(xs, got):
            if element != "TMAX" or (opts.clip_raw is not None and abs(x) > 700):
                assert g is None
            elif opts.integer_division:
                assert float(g) == _trunc_div(x, 10)
            else:
                assert g == pytest.approx(x / 10)


def test_flag_packing_round_trip(spark):
    chars = [None, "", "TQ", "é", "œ", "日本", "abcdefg", "\x00", "\x01a"] + [chr(c) for c in range(32, 127)]
    pairs = [(m, s) for m in chars[::2] for s in chars[::3]] + [(None, "S"), ("T", "œ"), ("T", None)]
    df = spark.createDataFrame(pairs, "m_flag string, s_flag string")
    back = df.select(*[c.alias(n) for n, c in pack_flags().items()]).select(*unpack_flags()).collect()
    assert [(r["m_flag"], r["s_flag"]) for r in back] == pairs


def test_a_flag_too_long_to_pack_is_an_error(spark):
    df = spark.createDataFrame([("eight by", "S")], "m_flag string, s_flag string")
    with pytest.raises(Exception, match="longer than 7 bytes"):
        df.select(*[c.alias(n) for n, c in pack_flags().items()]).collect()


def test_whole_division_is_exact(spark):
    big = 2 ** 60 + 7
    r = spark.createDataFrame([(big, -big)], "a long, b long").select(fn.int_div("a", 10).alias("a"), fn.int_div("b", 10).alias("b")).first()
    assert r["a"] == big // 10 and r["b"] == -(big // 10)


def test_dates(spark):
    df = spark.createDataFrame([(20200131, "19860529", dt.date(1992, 7, 14))], "i int, s string, d date")
    r = df.select(fn.int_to_date("i").alias("a"), fn.parse_date("s").alias("b"), fn.trunc_year("d").alias("c"),
                  fn.trunc_year_ts("d").alias("t"), fn.extract_year("d").alias("y"),
                  fn.format_year("d").alias("f")).first()
    assert r["a"] == dt.date(2020, 1, 31) and r["b"] == dt.date(1986, 5, 29) and r["c"] == dt.date(1992, 1, 1)
    assert r["t"] == dt.datetime(1992, 1, 1) and r["y"] == 1992 and r["f"] == "1992"
    assert df.select(F.substring(F.lit("ACW00011604"), 0, 2)).first()[0] == "AC"


def test_job_arguments():
    a = parse_args(["2007", "2008", "--observations", "o", "--stations", "s", "--countries", "c",
                    "--daily-out", "d", "--yearly-out", "y", "--variant", "local"])
    assert (a.start_year, a.end_year, a.variant, a.refresh, a.sample_rows) == (2007, 2008, "local", False, None)
    with pytest.raises(SystemExit):
        parse_args(["2008", "2007", "--observations", "o", "--stations", "s", "--countries", "c",
                    "--daily-out", "d", "--yearly-out", "y"])


@pytest.mark.parametrize("bad", [
    {"column_order": "jobs"}, {"year_start": "month"}, {"prcp_divisor": 0}, {"clip_raw": -1},
    {"measure_type": "float"}, {"order_by": ()},
])
def test_options_reject_unknown_values(bad):
    from meteora.options import TransformOptions

    with pytest.raises(ValueError):
        TransformOptions(**bad)

"""Daily and yearly averages of the measures, one row per station and period.

The grouped form is the production path: partial aggregation combines rows
map-side, so a station/day holding a large share of the input still sends
one row per map task through the shuffle.  The flags are picked from one
row per group with ``min_by`` on an order key.  Each is packed into a long
so the aggregation buffer is fixed-width and Spark keeps a code-generated
hash aggregate (string values in the buffer force a sort-based aggregate).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteora.functions.scalar import trunc_year, trunc_year_ts
from meteora.operators.cleaning import clean, normalize_flags
from meteora.operators.pivot import explode_elements
from meteora.options import TransformOptions
from meteora.schemas import MEASURES

ORDER = "_ord"
FLAGS = ("_m", "_s")
_FLAG_BYTES = 7
_NULL_FLAG = 15
# a decimal of 38 digits takes 126 bits: 64 of the key, 61 of the row's hash
_KEY_ROOM = 1 << 61
_LAST = (1 << 63) - 1
_WHOLE = {"tinyint", "smallint", "int", "bigint"}


def row_hash() -> Column:
    return F.xxhash64("element", "value", "m_flag", "s_flag", "obs_time", "date")


def order_key(opts: TransformOptions, rows: DataFrame) -> Column:
    """Column that orders rows inside a group; never null, and total up to equal rows.

    Without given columns it is a 64-bit hash of the row's content: deterministic
    across runs and task retries, but the chosen row is arbitrary, as the
    unordered row_number of the SQL models.  Given columns come first (null
    last), then that hash breaks ties.  One whole-number or date column that is
    unique in its group (``opts.order_unique``) needs no hash and is a plain long; one that
    is not packs with the hash into a decimal, which keeps the aggregate a hash aggregate
    but costs more; other columns go through a struct.
    """
    if not opts.order_by:
        return row_hash()
    kinds = dict(rows.dtypes)
    if len(opts.order_by) == 1 and (kind := kinds.get(opts.order_by[0])) in _WHOLE | {"date", "timestamp"}:
        c = F.col(opts.order_by[0])
        whole = F.unix_date(c) if kind == "date" else F.unix_micros(c) if kind == "timestamp" else c
        if opts.order_unique:
            return F.coalesce(whole.cast("long"), F.lit(_LAST))
        shifted = F.coalesce(whole.cast("decimal(20,0)"), F.lit(str(1 << 63)).cast("decimal(20,0)"))
        tie = F.shiftrightunsigned(row_hash(), 3).cast("decimal(19,0)")
        return (shifted * F.lit(_KEY_ROOM).cast("decimal(19,0)") + tie).cast("decimal(38,0)")
    parts = [x for c in opts.order_by for x in (F.col(c).isNull().alias(f"n_{c}"), F.col(c).alias(f"v_{c}"))]
    return F.struct(*parts, row_hash().alias("tie"))


def pack_flag(flag: str) -> Column:
    """A flag of up to 7 UTF-8 bytes, or null, as one long: its bytes, then its length.

    Nothing is cut: a longer flag is an error.
    """
    c = F.col(flag)
    size = F.octet_length(c)
    code = F.conv(F.hex(c.cast("binary")), 16, 10).cast("long") * 16 + size
    return (
        F.when(c.isNull(), F.lit(_NULL_FLAG).cast("long"))
        .when(c == "", F.lit(0).cast("long"))
        .when((size == 1), F.ascii(c).cast("long") * 16 + 1)
        .when(size <= _FLAG_BYTES, code)
        .otherwise(F.raise_error(F.concat(F.lit(f"{flag} is longer than {_FLAG_BYTES} bytes: "), c)).cast("long"))
    )


def unpack_flag(code: str, flag: str) -> Column:
    size, value = F.col(code) % 16, F.shiftright(F.col(code), 4)
    text = F.decode(F.unhex(F.lpad(F.hex(value), (size * 2).cast("int"), "0")), "UTF-8")
    return (
        F.when(size == 0, F.lit("")).when(size == 1, F.chr(value)).when(size < _NULL_FLAG, text).alias(flag)
    )


def pack_flags() -> dict[str, Column]:
    return {"_m": pack_flag("m_flag"), "_s": pack_flag("s_flag")}


def unpack_flags() -> tuple[Column, Column]:
    return unpack_flag("_m", "m_flag"), unpack_flag("_s", "s_flag")


def first_flag_aggs() -> list[Column]:
    """Both flags of the first row; the order has no ties between unlike rows."""
    return [F.min_by(c, ORDER).alias(c) for c in FLAGS]


def mean(total: Column, number: Column, opts: TransformOptions) -> Column:
    """The one average of all paths, of the declared type; null without a value."""
    if opts.measure_type == "double":
        value = total.cast("double") / number
    else:
        value = (total / number).cast(opts.measure_type)
    return F.when(number > 0, value)


def exploded_rows(obs: DataFrame, opts: TransformOptions) -> DataFrame:
    """Cleaned rows with their measures, the order key and the packed flags."""
    return explode_elements(ordered_rows(obs, opts), opts, keep=(ORDER, *FLAGS))


def ordered_rows(obs: DataFrame, opts: TransformOptions) -> DataFrame:
    """Cleaned rows with flags never null, the order key and the packed flags."""
    rows = normalize_flags(clean(obs, opts))
    return rows.withColumns({ORDER: order_key(opts, rows), **pack_flags()})


def to_wide(obs: DataFrame, opts: TransformOptions, period: Column, period_name: str = "date") -> DataFrame:
    """Average each measure over (id, period); flags from the first row."""
    grouped = (
        exploded_rows(obs, opts)
        .groupBy(F.col("id"), period.alias(period_name))
        .agg(*_sum_and_count(), *first_flag_aggs())
    )
    return grouped.select("id", period_name, *_means(opts), *unpack_flags())


def _sum_and_count() -> list[Column]:
    return [x for m in MEASURES for x in (F.sum(m).alias(f"_s_{m}"), F.count(m).alias(f"_n_{m}"))]


def _means(opts: TransformOptions) -> list[Column]:
    return [mean(F.col(f"_s_{m}"), F.col(f"_n_{m}"), opts).alias(m) for m in MEASURES]


def to_daily(obs: DataFrame, opts: TransformOptions) -> DataFrame:
    """One row per station and day: id, date, tmax..snwd, m_flag, s_flag."""
    return to_wide(obs, opts, F.col("date"))


def to_yearly(obs: DataFrame, opts: TransformOptions) -> DataFrame:
    """One row per station and year, averaged over the raw rows of the year.

    Not an average of daily averages: every raw observation weighs the same.
    ``date`` is the first day of the year.
    """
    return to_wide(obs, opts, year_start(opts))


def year_start(opts: TransformOptions, date: str = "date") -> Column:
    """First day (or first instant) of the year, per ``opts.year_start``."""
    return trunc_year_ts(date) if opts.year_start == "timestamp" else trunc_year(date)


def first_flags(obs: DataFrame, opts: TransformOptions, yearly: bool = False) -> DataFrame:
    """Flags of the first row (by the order key) of every station/period."""
    period = trunc_year("date") if yearly else F.col("date")
    grouped = ordered_rows(obs, opts).groupBy(F.col("id"), period.alias("date")).agg(*first_flag_aggs())
    return grouped.select("id", "date", *unpack_flags())


# -- one scan for both periods ---------------------------------------------------
# Daily partial aggregates (per measure: sum and count; the first row's order
# key and flags) are enough to finish both the daily and the yearly averages
# exactly: the yearly mean is sum(sums) / sum(counts) over the year's days,
# which weighs every raw row the same.

def daily_parts(obs: DataFrame, opts: TransformOptions) -> DataFrame:
    return exploded_rows(obs, opts).groupBy("id", "date").agg(*_sum_and_count(), F.min(ORDER).alias(ORDER), *first_flag_aggs())


def roll_up_parts(parts: DataFrame, period: Column) -> DataFrame:
    """Partials of a longer period (e.g. the year) from daily partials."""
    aggs = []
    for m in MEASURES:
        aggs += [F.sum(f"_s_{m}").alias(f"_s_{m}"), F.sum(f"_n_{m}").alias(f"_n_{m}")]
    return parts.groupBy(F.col("id"), period.alias("date")).agg(*aggs, F.min(ORDER).alias(ORDER), *first_flag_aggs())


def finish_parts(parts: DataFrame, opts: TransformOptions) -> DataFrame:
    """Averages (null where a measure has no value) and flags from partials."""
    return parts.select("id", "date", *_means(opts), *unpack_flags())

"""Driver test tables seen as observation data.

The test tables carry no weather data, but their shapes fit:

* ``events`` (one month)   -> daily observations: id from user_id, date from ts,
  element from event_type, value from value; flags from the time of day.
* ``lineitem`` (1995-2001) -> multi-year observations: id from l_suppkey, date
  from l_shipdate, element from return flag and line status (five mapped
  elements and one other element).
* ``customer`` / ``supplier`` -> stations, ``nation`` -> countries.

Each mapping exists twice: as DataFrame code (what the queries run) and as
SQL text (what the DuckDB oracles run).  Both are kept side by side here.
``seq`` is a unique row number that orders rows inside a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# Fixed values of the mapping.
# --------------------------------------------------------------------------
EVENT_ELEMENTS = {"view": "TMAX", "click": "TMIN", "purchase": "PRCP", "signup": "SNOW", "error": "SNWD"}
LINE_ELEMENTS = {"AF": "TMAX", "AO": "TMIN", "NF": "PRCP", "NO": "SNOW", "RF": "SNWD"}
OTHER_ELEMENT = "WSFG"
ID_WIDTH = 11


def _case(col, mapping: dict[str, str], default):
    out = default
    for k, v in reversed(list(mapping.items())):
        out = F.when(col == F.lit(k), F.lit(v)).otherwise(out)
    return out


def _sql_case(expr: str, mapping: dict[str, str], default: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {expr} {arms} ELSE {default} END"


def _pad_id(c) -> F.Column:
    return F.lpad(c.cast("string"), ID_WIDTH, "0")


def _sql_pad_id(expr: str) -> str:
    return f"lpad(CAST({expr} AS VARCHAR), {ID_WIDTH}, '0')"


# Test tables read in this process, by (session, path).  Reading a Parquet
# file runs a small job for its footer (schema); the tables are read-only, so
# one read per session is enough.  Only the lazy DataFrame is kept.
_READ: dict[tuple[str, int, str], DataFrame] = {}


class DriverTables:
    """Lazily read test tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        key = (self.spark.sparkContext.applicationId, id(self.spark), path)
        if key not in _READ:
            _READ[key] = self.spark.read.parquet(path)
        return _READ[key]

    # observations ---------------------------------------------------------
    def events_obs(self) -> DataFrame:
        e = self.table("events")
        ts = F.col("ts")
        return e.select(
            _pad_id(F.col("user_id")).alias("id"),
            ts.cast("date").alias("date"),
            _case(F.col("event_type"), EVENT_ELEMENTS, F.upper("event_type")).alias("element"),
            (F.floor(F.col("value") * 10).cast("long") - 800).alias("value"),
            F.when(F.minute(ts) < 20, "").when(F.minute(ts) < 40, "T").otherwise("P").alias("m_flag"),
            F.when(F.second(ts) < 6, "I").otherwise("").alias("q_flag"),
            F.when(F.hour(ts) < 12, "S").otherwise("7").alias("s_flag"),
            (F.hour(ts) * 100 + F.minute(ts)).cast("short").alias("obs_time"),
            F.col("event_id").alias("seq"),
        )

    def events_obs_odd_flags(self, by_group: bool = False) -> DataFrame:
        """``events_obs`` with null, longer and non-ASCII flags and a partly null order
        column; ``by_group``: the flags depend on the station and day alone."""
        obs = self.events_obs()
        k = (F.substring("id", -2, 2).cast("int") + F.dayofmonth("date")) if by_group else F.col("seq")
        return obs.withColumns({
            "m_flag": F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, "TQ").when(k % 5 == 2, "é").when(k % 5 == 3, "").otherwise("P"),
            "s_flag": F.when(k % 7 < 2, F.lit(None)).when(k % 7 < 4, "œz").when(k % 7 < 6, "S").otherwise("7a"),
            "seq": F.when(F.col("seq") % 3 != 0, F.col("seq")),
            "seq0": F.col("seq"),
        })

    def lineitem_obs(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            _pad_id(F.col("l_suppkey")).alias("id"),
            F.col("l_shipdate").cast("date").alias("date"),
            _case(F.concat("l_returnflag", "l_linestatus"), LINE_ELEMENTS, F.lit(OTHER_ELEMENT)).alias("element"),
            (F.col("l_quantity").cast("long") * 40 - 1000).alias("value"),
            F.when(F.col("l_linenumber") <= 2, "").when(F.col("l_linenumber") <= 4, "T").otherwise("P").alias("m_flag"),
            F.when(F.col("l_discount") > 0.095, "X").otherwise("").alias("q_flag"),
            F.when(F.col("l_tax") < 0.04, "S").otherwise("7").alias("s_flag"),
            F.lit(None).cast("short").alias("obs_time"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
        )

    # dimensions -----------------------------------------------------------
    def _stations(self, t: DataFrame, key: str, nation: str, bal: str, name: str, embed_country: bool,
                  wmo_guard=None) -> DataFrame:
        code = F.lpad(F.col(nation).cast("string"), 2, "0")
        wmo = F.lpad(F.col(nation).cast("string"), 5, "0")
        sid = F.concat(code, F.lpad(F.col(key).cast("string"), ID_WIDTH - 2, "0")) if embed_country else _pad_id(F.col(key))
        cols = [
            sid.alias("id"),
            F.col(nation).cast("double").alias("latitude"),
            F.col(bal).alias("longitude"),
            F.length(name).cast("double").alias("elevation"),
            F.lit(None).cast("string").alias("state"),
            F.col(name).alias("name"),
            F.lit(None).cast("string").alias("gsn_flag"),
            F.lit(None).cast("string").alias("hcn_crn_flag"),
            (wmo if wmo_guard is None else F.when(wmo_guard, wmo)).alias("wmo_id"),
        ]
        if not embed_country:
            cols.append(code.alias("country_code"))
        return t.select(*cols)

    def customer_stations(self, embed_country: bool = False) -> DataFrame:
        # Some stations have no WMO id: their lines of the text file end early.
        return self._stations(self.table("customer"), "c_custkey", "c_nationkey", "c_acctbal", "c_name",
                              embed_country, wmo_guard=F.col("c_mktsegment") != "BUILDING")

    def supplier_stations(self, embed_country: bool = False) -> DataFrame:
        return self._stations(self.table("supplier"), "s_suppkey", "s_nationkey", "s_acctbal", "s_name", embed_country)

    def countries(self) -> DataFrame:
        n = self.table("nation")
        return n.select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code"), F.col("n_name").alias("name"))


# --------------------------------------------------------------------------
# The same mappings as SQL (DuckDB dialect) for the oracles.
# --------------------------------------------------------------------------

SQL_EVENTS_OBS = f"""
SELECT {_sql_pad_id('user_id')} AS id,
       CAST(ts AS DATE) AS date,
       {_sql_case('event_type', EVENT_ELEMENTS, 'upper(event_type)')} AS element,
       CAST(floor(value * 10) AS BIGINT) - 800 AS value,
       CASE WHEN minute(ts) < 20 THEN '' WHEN minute(ts) < 40 THEN 'T' ELSE 'P' END AS m_flag,
       CASE WHEN second(ts) < 6 THEN 'I' ELSE '' END AS q_flag,
       CASE WHEN hour(ts) < 12 THEN 'S' ELSE '7' END AS s_flag,
       CAST(hour(ts) * 100 + minute(ts) AS SMALLINT) AS obs_time,
       event_id AS seq
FROM events"""



def sql_events_obs_odd_flags(by_group: bool = False) -> str:
    k = "(CAST(right(id, 2) AS INT) + day(date))" if by_group else "seq"
    return f"""
SELECT id, date, element, value,
       CASE {k} % 5 WHEN 0 THEN '' WHEN 1 THEN 'TQ' WHEN 2 THEN 'é' WHEN 3 THEN '' ELSE 'P' END AS m_flag, q_flag,
       CASE WHEN {k} % 7 < 2 THEN '' WHEN {k} % 7 < 4 THEN 'œz' WHEN {k} % 7 < 6 THEN 'S' ELSE '7a' END AS s_flag,
       obs_time, CASE WHEN seq % 3 <> 0 THEN seq END AS seq, seq AS seq0
FROM ({SQL_EVENTS_OBS}) AS e"""


SQL_LINEITEM_OBS = f"""
SELECT {_sql_pad_id('l_suppkey')} AS id,
       CAST(l_shipdate AS DATE) AS date,
       {_sql_case('l_returnflag || l_linestatus', LINE_ELEMENTS, repr(OTHER_ELEMENT))} AS element,
       CAST(l_quantity AS BIGINT) * 40 - 1000 AS value,
       CASE WHEN l_linenumber <= 2 THEN '' WHEN l_linenumber <= 4 THEN 'T' ELSE 'P' END AS m_flag,
       CASE WHEN l_discount > 0.095 THEN 'X' ELSE '' END AS q_flag,
       CASE WHEN l_tax < 0.04 THEN 'S' ELSE '7' END AS s_flag,
       CAST(NULL AS SMALLINT) AS obs_time,
       l_orderkey * 8 + l_linenumber AS seq
FROM lineitem"""


def _sql_stations(table: str, key: str, nation: str, bal: str, name: str, embed_country: bool,
                  wmo_guard: str | None = None) -> str:
    code = f"lpad(CAST({nation} AS VARCHAR), 2, '0')"
    sid = f"{code} || lpad(CAST({key} AS VARCHAR), {ID_WIDTH - 2}, '0')" if embed_country else _sql_pad_id(key)
    wmo = f"lpad(CAST({nation} AS VARCHAR), 5, '0')"
    if wmo_guard:
        wmo = f"CASE WHEN {wmo_guard} THEN {wmo} END"
    extra = "" if embed_country else f",\n       {code} AS country_code"
    return f"""
SELECT {sid} AS id,
       CAST({nation} AS DOUBLE) AS latitude,
       {bal} AS longitude,
       CAST(length({name}) AS DOUBLE) AS elevation,
       CAST(NULL AS VARCHAR) AS state,
       {name} AS name,
       CAST(NULL AS VARCHAR) AS gsn_flag,
       CAST(NULL AS VARCHAR) AS hcn_crn_flag,
       {wmo} AS wmo_id{extra}
FROM {table}"""


def sql_customer_stations(embed_country: bool = False) -> str:
    return _sql_stations("customer", "c_custkey", "c_nationkey", "c_acctbal", "c_name", embed_country,
                         wmo_guard="c_mktsegment <> 'BUILDING'")


def sql_supplier_stations(embed_country: bool = False) -> str:
    return _sql_stations("supplier", "s_suppkey", "s_nationkey", "s_acctbal", "s_name", embed_country)


SQL_COUNTRIES = """
SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_name AS name
FROM nation"""

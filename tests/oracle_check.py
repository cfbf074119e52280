"""Run registered queries against their DuckDB oracles.

    python tests/oracle_check.py [sf_dir] [key ...]

Compares row count, column names (sorted) and the multiset of rows.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


SPARK_TO_DUCK = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
    "double": "DOUBLE", "float": "FLOAT", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN",
}


def spark_type(t) -> str:
    s = t.simpleString()
    if s.startswith("decimal"):
        return s.upper().replace(" ", "")
    return SPARK_TO_DUCK.get(s, s.upper())


def check(spark, key: str, fn, sql: str | None, sf_dir: str, con) -> tuple[bool, str]:
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    if sql is None:
        return True, f"rows={len(srows)} (no oracle) {t1 - t0:.1f}s"
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    if sorted(scols) != sorted(ocols):
        return False, f"columns differ: spark={sorted(scols)} oracle={sorted(ocols)}"
    stypes = {f.name: spark_type(f.dataType) for f in df.schema.fields}
    otypes = dict(zip(ocols, [str(d[1]).upper().replace(" ", "") for d in res.description]))
    bad_types = {c: (stypes[c], otypes[c]) for c in scols if stypes[c].replace(" ", "") != otypes[c]}
    if bad_types:
        return False, f"types differ (spark, oracle): {bad_types}"
    if len(srows) != len(orows):
        return False, f"row count spark={len(srows)} oracle={len(orows)}"
    a, b = rows_of(scols, srows), rows_of(ocols, orows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"rows={len(srows)} {t1 - t0:.1f}s"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as entry
    from meteora.session import local_session

    spark = local_session(8, 8)
    con = duck(sf_dir)
    qs, sq = entry.queries(), entry.oracle_sql()
    bad = 0
    for k in keys or list(qs):
        try:
            ok, msg = check(spark, k, qs[k], sq.get(k), sf_dir, con)
        except Exception as exc:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(exc).__name__}: {str(exc)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {k}: {msg}", flush=True)
    print(f"{len(keys or qs) - bad} ok, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

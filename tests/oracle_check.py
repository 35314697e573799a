"""Run registered Spark queries and their DuckDB oracles side by side.

Usable from pytest (``compare``) and as a script:
``python tests/oracle_check.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        return f if EXACT else round(f, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.date().isoformat() if v.time() == dt.time(0) else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(repr(_norm(r[i])) for i in order) for r in rows)


SPARK_TO_DUCK = {"StringType()": "VARCHAR", "DateType()": "DATE", "DoubleType()": "DOUBLE",
                 "LongType()": "BIGINT", "IntegerType()": "INTEGER", "BooleanType()": "BOOLEAN"}


def spark_types(df):
    return {f.name: SPARK_TO_DUCK.get(str(f.dataType), str(f.dataType)) for f in df.schema.fields}


def compare(spark, con, name, spark_fn, sql, sf_dir):
    t0 = time.time()
    sdf = spark_fn(spark, sf_dir)
    s_names = sdf.columns
    s_types = spark_types(sdf)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_names = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2)}
    out["columns_match"] = sorted(s_names) == sorted(d_names)
    rel = con.sql(sql)
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    out["types_match"] = s_types == d_types
    if not out["types_match"]:
        out["type_diff"] = {c: (s_types.get(c), d_types.get(c)) for c in set(s_types) | set(d_types)
                            if s_types.get(c) != d_types.get(c)}
    out["values_match"] = out["columns_match"] and _rows(s_names, s_rows) == _rows(d_names, d_rows)
    if not out["values_match"]:
        out["spark_columns"], out["oracle_columns"] = s_names, d_names
        if out["columns_match"]:
            a, b = _rows(s_names, s_rows), _rows(d_names, d_rows)
            out["only_spark"] = list((a - b).items())[:3]
            out["only_oracle"] = list((b - a).items())[:3]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(argv[2:])
    import __spark_entry__ as entry
    from tidemark.session import build_session
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        if name not in sqls:
            print(f"{name}: no oracle")
            continue
        try:
            r = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as exc:  # report and continue
            r = {"name": name, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        ok = r.get("values_match", False) and r.get("types_match", False)
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(qs) - bad if not wanted else len(wanted) - bad} ok, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

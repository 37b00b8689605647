"""Run registered queries in Spark and their oracle SQL in DuckDB on the same
parquet tables; compare column names, row counts and sorted values.

CLI: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


_SPARK_T = {"int": "int32", "bigint": "int64", "double": "float64", "string": "string", "boolean": "bool",
            "timestamp_ntz": "timestamp", "timestamp": "timestamp", "date": "date", "float": "float32",
            "smallint": "int16", "tinyint": "int8"}
_DUCK_T = {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float64", "VARCHAR": "string", "BOOLEAN": "bool",
           "TIMESTAMP": "timestamp", "DATE": "date", "FLOAT": "float32", "HUGEINT": "int128",
           "SMALLINT": "int16", "TINYINT": "int8"}


def type_diff(sdf, rel) -> dict:
    """Columns whose Spark and DuckDB types differ (canonical names)."""
    st = {f.name: _SPARK_T.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    dt = {c: _DUCK_T.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    return {c: (st[c], dt.get(c)) for c in st if st[c] != dt.get(c)}


def _key(row):
    return tuple((x is None, str(type(x).__name__), str(x)) for x in row)


def compare(spark, sf_dir: str, name: str, fn, sql: str, con=None, tol: float = 0.0):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = list(sdf.columns)
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    out = {"query": name, "spark_rows": len(srows), "oracle_rows": len(drows),
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    td = type_diff(sdf, con.sql(sql))
    if td:
        out["error"] = f"types differ: {td}"
        return out
    if sorted(scols) != sorted(dcols):
        out["error"] = f"columns differ: spark-only {sorted(set(scols) - set(dcols))} " \
                       f"oracle-only {sorted(set(dcols) - set(scols))}"
        return out
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    s = sorted((tuple(_norm(r[i]) for i in si) for r in srows), key=_key)
    d = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=_key)
    bad = []
    for a, b in zip(s, d):
        if a != b:
            for c, x, y in zip(order, a, b):
                if x != y and not (isinstance(x, float) and isinstance(y, float)
                                   and abs(x - y) <= tol * max(1.0, abs(y))):
                    bad.append((c, x, y))
        if len(bad) > 5:
            break
    if len(s) != len(d):
        out["error"] = "row counts differ"
    elif bad:
        out["error"] = f"values differ: {bad[:5]}"
    return out


def main():
    from cairn.session import build_session
    from cairn.plans.registry import ORACLE, QUERIES, _load_all
    _load_all()
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(QUERIES)
    spark = build_session(shuffle_partitions=8)
    con = duck(sf_dir)
    fails = 0
    for n in names:
        if n not in ORACLE:
            df = QUERIES[n](spark, sf_dir)
            print({"query": n, "rows_only": df.count()})
            continue
        try:
            r = compare(spark, sf_dir, n, QUERIES[n], ORACLE[n], con)
        except Exception as e:  # report and go on
            r = {"query": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        fails += "error" in r
        print(r, flush=True)
    print(f"{len(names) - fails}/{len(names)} ok")


if __name__ == "__main__":
    main()

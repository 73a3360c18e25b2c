"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
Comparison: row count, column names, and the multiset of rows (columns sorted by name,
values normalised: floats rounded to 9 significant digits, timestamps as ISO text).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


# Spark simple type name -> DuckDB type name
_TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT"}


def type_mismatches(sdf, rel):
    st = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    dt_ = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return {c: (st[c], dt_.get(c)) for c in st if _TYPE_MAP.get(st[c], st[c]) != dt_.get(c)}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("spark-error", str(e)[:400])
            if verbose:
                print(f"{name:22s} SPARK ERROR {str(e)[:400]}")
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = ("no-oracle", len(srows))
            if verbose:
                print(f"{name:22s} rows={len(srows)} (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(sqls[name])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("sql-error", str(e)[:400])
            if verbose:
                print(f"{name:22s} SQL ERROR {str(e)[:400]}")
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        bad_types = type_mismatches(df, rel) if ok_cols else {}
        a, b = _rows(scols, srows), _rows(dcols, drows)
        ok = ok_cols and a == b and not bad_types
        results[name] = ("ok" if ok else "mismatch", len(srows), len(drows))
        if verbose:
            print(f"{name:22s} {'OK ' if ok else 'BAD'} spark={len(srows)} duck={len(drows)} {ts:.1f}s")
            if bad_types:
                print("   types (spark, duck):", bad_types)
            if not ok_cols:
                print("   cols spark-only:", sorted(set(scols) - set(dcols)), "duck-only:", sorted(set(dcols) - set(scols)))
            elif not ok:
                sa, sb = set(a), set(b)
                print("   spark-only e.g.", list(sa - sb)[:2])
                print("   duck-only  e.g.", list(sb - sa)[:2])
    return results


if __name__ == "__main__":
    from snapflow.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("ok", "no-oracle")]
    print("FAILED:", bad if bad else "none")

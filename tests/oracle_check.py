"""Run registered queries in Spark and their oracle SQL in DuckDB; compare like the driver does.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names, and an order-insensitive hash of values with columns sorted by
name. Floats are compared exactly.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)  # exact: every registered query matches its oracle bit for bit
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat() if hasattr(v, "tzinfo") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def digest(rows: list[tuple]) -> str:
    keys = sorted(repr(r) for r in rows)
    return hashlib.sha256("\n".join(keys).encode()).hexdigest()[:16]


def spark_rows(df):
    cols = sorted(df.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, out


def duck_rows(con, sql):
    rel = con.sql(sql)
    cols = list(rel.columns)
    data = rel.fetchall()
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], [tuple(_norm(r[i]) for i in order) for r in data]


def compare(spark, sf_dir: str, names=None) -> dict[str, dict]:
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or qs:
        t0 = time.time()
        rec = {}
        try:
            scols, srows = spark_rows(qs[name](spark, sf_dir))
            rec["spark_rows"] = len(srows)
            if name in sqls:
                dcols, drows = duck_rows(con, sqls[name])
                rec.update(
                    oracle_rows=len(drows),
                    cols_match=scols == dcols,
                    hash_match=digest(srows) == digest(drows),
                )
                if not rec["cols_match"]:
                    rec["cols"] = (scols, dcols)
                if rec["cols_match"] and not rec["hash_match"]:
                    a, b = set(srows), set(drows)
                    rec["only_spark"] = list(a - b)[:3]
                    rec["only_oracle"] = list(b - a)[:3]
            rec["ok"] = rec.get("hash_match", True) and rec.get("cols_match", True)
        except Exception as e:  # noqa: BLE001 - report and continue
            rec["ok"] = False
            rec["error"] = f"{type(e).__name__}: {str(e)[:400]}"
        rec["sec"] = round(time.time() - t0, 2)
        results[name] = rec
        print(name, rec, flush=True)
    return results


if __name__ == "__main__":
    from riskflow.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_spark("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names)
    bad = [n for n, r in res.items() if not r["ok"]]
    print("FAILED:", bad if bad else "none", f"({len(res) - len(bad)}/{len(res)} ok)")

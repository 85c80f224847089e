"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: ``python tests/oracle_compare.py [sf_dir] [name ...]``. Prints one line per
query: rows on both sides, and whether names and (order-insensitive) values match.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

# ORACLE_EXACT=1 compares floating point values bit for bit instead of to 6 decimals
EXACT = os.environ.get("ORACLE_EXACT") == "1"

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm_value(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if EXACT else round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None).isoformat() if v.tzinfo else v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if hasattr(v, "item"):
        return _norm_value(v.item())
    return v


def normalise(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm_value(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, name: str, builder, sql: str | None, sf_dir: str, con) -> dict:
    t0 = time.time()
    sdf = builder(spark, sf_dir)
    s_pd = sdf.toPandas()
    took = time.time() - t0
    out = {"name": name, "spark_rows": len(s_pd), "sec": round(took, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    d_pd = con.sql(sql).df()
    out["oracle_rows"] = len(d_pd)
    out["names_match"] = sorted(s_pd.columns) == sorted(d_pd.columns)
    if not out["names_match"]:
        out["status"] = f"NAMES {sorted(s_pd.columns)} vs {sorted(d_pd.columns)}"
        return out
    a, b = normalise(s_pd), normalise(d_pd)
    out["values_match"] = a == b
    if a != b:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        out["status"] = f"VALUES spark-only={diff_a} oracle-only={diff_b}"
    else:
        out["status"] = "ok"
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from silverline.session import local_session
    import __spark_entry__ as entry

    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, name, fn, sqls.get(name), sf_dir, con)
        except Exception as e:  # report and go on
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(f"{name:40s} {r.get('spark_rows')!s:>7} {r.get('oracle_rows')!s:>7} {r.get('sec')!s:>6}s  {r['status'][:400]}",
              flush=True)
    print(f"mismatches: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

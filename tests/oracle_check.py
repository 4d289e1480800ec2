"""Run registered queries on Spark and their SQL on DuckDB; compare rows
order-insensitively after normalising values (dates/timestamps to ISO text,
floats rounded to 6 significant decimals)."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return round(f, 6) if abs(f) < 1e12 else float(f"{f:.12g}")
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_key(rows):
    return sorted((tuple(norm(x) for x in r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, name, fn, sql, sf_dir, con):
    t = time.time()
    df = fn(spark, sf_dir)
    cols = df.columns
    s_rows = [tuple(r[c] for c in sorted(cols)) for r in df.collect()]
    t_spark = time.time() - t
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = [tuple(dict(zip(d_cols, r))[c] for c in sorted(d_cols)) for r in rel.fetchall()]
    ok_cols = sorted(cols) == sorted(d_cols)
    ok = ok_cols and rows_key(s_rows) == rows_key(d_rows)
    return ok, ok_cols, len(s_rows), len(d_rows), t_spark, cols, d_cols


def main(names=None, sf_dir="/root/testdata/sf0.01"):
    sys.path.insert(0, "/root/repo")
    from __spark_entry__ import oracle_sql, queries
    from strata.session import get_spark
    spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = []
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name:28s} (no oracle)")
            continue
        try:
            ok, ok_cols, ns, nd, ts, cols, dcols = compare(spark, name, qs[name], sqls[name], sf_dir, con)
        except Exception as e:  # report and go on
            print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:300]}")
            bad.append(name)
            continue
        print(f"{name:28s} {'OK ' if ok else 'BAD'} spark={ns} duck={nd} {ts:.1f}s"
              + ("" if ok_cols else f" cols {cols} vs {dcols}"))
        if not ok:
            bad.append(name)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf, args = args[0], args[1:]
    print("FAILED:", main(args or None, sf))

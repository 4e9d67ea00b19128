"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

Usage: python tools/check_oracle.py [sf_dir] [name ...]

Compares row count, column names and an order-insensitive multiset of
rows (floats rounded to 9 significant digits). Prints one line per query
and a JSON summary at the end.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    import importlib.util
    spec = importlib.util.spec_from_file_location(
        "entry", os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                              "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    from pyspark.sql import SparkSession
    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false") \
        .config("spark.ui.showConsoleProgress", "false") \
        .config("spark.sql.shuffle.partitions", "8")
    # a plain session, as a caller would build it; CHECK_CONF="k=v,k=v" adds settings
    for item in filter(None, os.environ.get("CHECK_CONF", "").split(",")):
        k, v = item.split("=", 1)
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = entry.queries(), entry.oracle_sql()
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as exc:  # noqa: BLE001
            results[name] = {"ok": False, "error": f"spark: {str(exc)[:300]}"}
            print(name, "SPARK ERROR", str(exc)[:300], flush=True)
            continue
        t1 = time.time()
        if name not in sqls:
            results[name] = {"ok": None, "rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
            print(name, "rows-only", len(s_rows), flush=True)
            continue
        try:
            cur = con.execute(sqls[name])
            d_cols = [c[0] for c in cur.description]
            d_rows = cur.fetchall()
        except Exception as exc:  # noqa: BLE001
            results[name] = {"ok": False, "error": f"duckdb: {str(exc)[:300]}"}
            print(name, "DUCKDB ERROR", str(exc)[:300], flush=True)
            continue
        same_cols = sorted(s_cols) == sorted(d_cols)
        same_n = len(s_rows) == len(d_rows)
        same_v = same_cols and canon(s_cols, s_rows) == canon(d_cols, d_rows)
        ok = same_cols and same_n and same_v
        results[name] = {"ok": ok, "rows": len(s_rows), "oracle_rows": len(d_rows),
                         "cols": same_cols, "spark_s": round(t1 - t0, 2)}
        msg = "OK" if ok else "MISMATCH"
        print(f"{name:24s} {msg} rows={len(s_rows)}/{len(d_rows)} cols={same_cols} "
              f"t={t1 - t0:.2f}s", flush=True)
        if not ok:
            if not same_cols:
                print("   spark:", sorted(s_cols), "\n   duck: ", sorted(d_cols))
            else:
                a, b = canon(s_cols, s_rows), canon(d_cols, d_rows)
                sa, sb = set(a), set(b)
                print("   only spark:", list(sa - sb)[:3], "\n   only duck: ", list(sb - sa)[:3])
    good = sum(1 for r in results.values() if r.get("ok"))
    print(json.dumps({"ok": good, "total": len(results),
                      "failed": [k for k, r in results.items() if r.get("ok") is False]}))


if __name__ == "__main__":
    main()

"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
Compares row count, column names and the multiset of rows (doubles to
1e-9 relative tolerance); prints one line per key.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, repr(x) if isinstance(x, float) else str(x))
                 for x in row)


def _close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(_close(x, y) for x, y in zip(a, b))
    return a == b


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns differ: {sorted(spark_cols)} vs {sorted(duck_cols)}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=_key)
    if len(a) != len(b):
        return f"rows differ: spark {len(a)} vs duckdb {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if not _close(x, y)]
    if bad:
        return f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    exact = all(x == y for x, y in zip(a, b))
    return "ok" if exact else "ok~"


def main(argv):
    import __spark_entry__ as E
    from trafficlens.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:]
    extra = {}
    if os.environ.get("ORACLE_SESSION_TZ"):  # run under another session setup
        extra = {"spark.sql.session.timeZone": os.environ["ORACLE_SESSION_TZ"],
                 "spark.sql.adaptive.enabled": "false"}
    spark = build_session(shuffle_partitions=int(os.environ.get("ORACLE_SHUFFLE", "8")), extra=extra)
    con = duck(sf_dir)
    qs, sql = E.queries(), E.oracle_sql()
    failed = 0
    for k in (keys or list(qs)):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{k:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            failed += 1
            continue
        t1 = time.time()
        if k not in sql:
            print(f"{k:28s} rows-only {len(rows)} rows  spark {t1 - t0:.2f}s")
            continue
        try:
            res = con.execute(sql[k])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{k:28s} DUCK-ERROR {type(e).__name__}: {str(e)[:300]}")
            failed += 1
            continue
        verdict = compare(rows, cols, drows, dcols)
        if not verdict.startswith("ok"):
            failed += 1
        print(f"{k:28s} {verdict}  rows={len(rows)}  spark {t1 - t0:.2f}s")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

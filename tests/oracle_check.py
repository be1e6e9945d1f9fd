"""Compare each registered query with its DuckDB oracle.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Rows are compared as multisets after canonicalizing values (floats to 6
decimals, dates and times as ISO text, arrays as lists), columns by name.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, canon(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return canon(v.asDict())
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return [tuple(canon(r[i]) for i in order) for r in rows], sorted(n.lower() for n in names)


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark_df, con, sql):
    s_rows, s_cols = rows_of(spark_df.columns, spark_df.collect())
    r = con.sql(sql)
    d_rows, d_cols = rows_of(r.columns, r.fetchall())
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    cs, cd = Counter(s_rows), Counter(d_rows)
    if cs == cd:
        return True, f"{len(s_rows)} rows"
    only_s = list((cs - cd).elements())[:3]
    only_d = list((cd - cs).elements())[:3]
    return False, (f"spark {len(s_rows)} rows, duck {len(d_rows)} rows; "
                   f"only spark e.g. {only_s}; only duck e.g. {only_d}")


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and "/" in argv[1] else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if "/" not in a]
    import __spark_entry__ as E
    from linefold.session import build_session
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        t = time.time()
        if name not in orc:
            n = qs[name](spark, sf_dir).count()
            print(f"{name:32s} rows-only {n} rows ({time.time() - t:.1f}s)")
            continue
        try:
            ok, msg = compare(qs[name](spark, sf_dir), con, orc[name])
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{name:32s} {'OK  ' if ok else 'FAIL'} {msg} ({time.time() - t:.1f}s)", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

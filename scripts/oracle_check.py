"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

    python scripts/oracle_check.py [sf_dir] [query ...]

Compares row count, column names and the multiset of rows (floats rounded to
9 places, lists as tuples).  Prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from lodestar.plans.registry import ORACLE_SQL, QUERIES  # noqa: E402
from lodestar.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    ok_all = True
    for name in names:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        ts = time.time() - t0
        if name not in ORACLE_SQL:
            print(f"{name:28s} spark-only rows={len(s_rows)} ({ts:.1f}s)")
            continue
        t1 = time.time()
        res = con.execute(ORACLE_SQL[name])
        o_cols = [d[0] for d in res.description]
        o_rows = res.fetchall()
        to = time.time() - t1
        same_cols = sorted(s_cols) == sorted(o_cols)
        same = same_cols and rows_of(s_cols, s_rows) == rows_of(o_cols, o_rows)
        ok_all &= same
        print(f"{name:28s} {'OK ' if same else 'BAD'} spark={len(s_rows)} oracle={len(o_rows)} "
              f"cols={'same' if same_cols else (s_cols, o_cols)} ({ts:.1f}s / {to:.1f}s)")
        if not same and same_cols:
            a, b = rows_of(s_cols, s_rows), rows_of(o_cols, o_rows)
            print("   spark-only:", list((a - b).items())[:3])
            print("   oracle-only:", list((b - a).items())[:3])
    spark.stop()
    sys.exit(0 if ok_all else 1)


if __name__ == "__main__":
    main()

"""Compare registered queries with their SQL: python -m corpusloom.plans.check [sf] [name ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from corpusloom.plans import catalog
from corpusloom.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _key(v):
    return (v is None, str(type(v).__name__), str(v))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(r[i] for i in order) for r in rows]
    return sorted(out, key=lambda r: [_key(v) for v in r])


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(_same(x, y) for x, y in zip(a, b))
    return a == b and isinstance(a, float) == isinstance(b, float)


def difference(spark, con, sf: str, name: str) -> str | None:
    """None when Spark and SQL agree, else what differs."""
    df = catalog.QUERIES[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    cursor = con.execute(catalog.SQL[name])
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    bad = [
        (a, b)
        for a, b in zip(rows_of(df.columns, got), rows_of(names, want))
        if not all(_same(x, y) for x, y in zip(a, b))
    ]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}"[:600] if bad else None


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    catalog.load()
    spark, con = local_session(), connect(sf)
    failed = 0
    for name in argv[1:] or list(catalog.QUERIES):
        start = time.time()
        try:
            if name in catalog.SQL:
                found = difference(spark, con, sf, name)
                kind = "sql"
            else:
                kind, n = "rows", catalog.QUERIES[name](spark, sf).count()
                found = None if n else "no rows"
        except Exception as e:  # report and go on with the next query
            found = f"{type(e).__name__}: {str(e)[:600]}"
        failed += found is not None
        print(f"{name:32} {kind:4} {time.time() - start:6.2f}s {found or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

"""Run every query against its SQL. ``python tests/oracle_check.py [folder] [name ...]``"""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return str(v.normalize() + 0) if v else "0"
    return repr(v) if isinstance(v, float) else str(v)


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> str | None:
    """None if equal, else what differs."""
    found = con.execute(sql)
    names, want = [d[0] for d in found.description], found.fetchall()
    got = [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    if len(got) != len(want):
        return f"rows {len(got)} against {len(want)}"
    a, b = rows_by_name(df.columns, got), rows_by_name(names, want)
    if a == b:
        return None
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    cols = sorted(df.columns)
    diff = {c: (p, q) for c, p, q in zip(cols, *bad[0]) if p != q}
    return f"{len(bad)} rows differ, first: {diff}"


def main(folder: str, only: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from rentledger import get_session

    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    spark = get_session(master="local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(folder), oracle_sql(), 0
    for name, fn in queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            problem = compare(fn(spark, folder), con, sqls[name])
        except Exception as e:  # report and go on to the next query
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(bool(main(args[0] if args else "/root/testdata/sf0.001", args[1:])))

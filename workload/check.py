"""Compare registered queries with their SQL.

    python -m workload.check [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _bag(rows, columns: list[str]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when both give the same columns and the same bag of rows."""
    df = query(spark, sf_dir)
    ours = _bag(df.collect(), df.columns)
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = _bag(cur.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if ours != theirs:
        a, b = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
        return f"{sum(ours.values())} and {sum(theirs.values())} rows; ours only {a}; SQL only {b}"
    return None


def main() -> int:
    from workload.oracle import ORACLE_SQL
    from workload.queries import QUERIES
    from workload.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con, bad = local_session(), connect(sf_dir), 0
    for name in sys.argv[2:] or QUERIES:
        started = time.monotonic()
        try:
            problem = compare(spark, con, sf_dir, QUERIES[name], ORACLE_SQL[name])
        except Exception:  # noqa: BLE001 - report and go on with the next query
            problem = traceback.format_exc()[-int(os.environ.get("CHECK_CHARS", "1500")):]
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.monotonic() - started:.2f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())

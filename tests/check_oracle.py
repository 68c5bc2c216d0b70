"""Run registered queries against their SQL twins: python tests/check_oracle.py [sf_dir] [names...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.12g}"
    if isinstance(value, (list, tuple)):
        return [normal(v) for v in value]
    return value


def rows_of(names: list[str], rows) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([normal(row[i]) for i in order]) for row in rows)


def compare(spark, con, sf_dir: str, name: str, query, sql: str) -> str:
    """'' when rows and column names agree, else what differs."""
    df = query(spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    con.execute(sql)
    columns = [d[0] for d in con.description]
    theirs = rows_of(columns, con.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"\n  spark {a}\n  sql   {b}"
    return ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from toolgauge.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con = local_session(), connect(sf_dir)
    bad = 0
    for name, query in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in oracle_sql():
                problem = compare(spark, con, sf_dir, name, query, oracle_sql()[name])
                kind = "ok" if not problem else "DIFF " + problem
                bad += bool(problem)
            else:
                kind = f"rows only: {query(spark, sf_dir).count()}"
        except Exception as error:  # keep going: the report covers every query
            kind, bad = f"ERROR {str(error)[:1500]}", bad + 1
        print(f"{name:22s} {time.time() - start:6.2f}s {kind}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())

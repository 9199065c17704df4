"""Runs a registered query and its oracle SQL and compares the rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, query, sql):
    """None when equal, otherwise a short description; plus row count and Spark seconds."""
    begin = time.time()
    frame = query(spark, folder)
    got = [tuple(r) for r in frame.collect()]
    seconds = time.time() - begin
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}", len(got), seconds
    a, b = _rows(frame.columns, got), _rows(names, want)
    if a != b:
        left = [x for x in a if x not in set(b)][:3]
        right = [x for x in b if x not in set(a)][:3]
        return f"{len(a)} vs {len(b)} rows; spark only {left}; sql only {right}", len(got), seconds
    return None, len(got), seconds


if __name__ == "__main__":
    import __spark_entry__ as entry
    from opsledger.session import build_session

    target = sys.argv[1]
    only = sys.argv[2:]
    session = build_session(cpus=8)
    con_ = connect(target)
    sqls = entry.oracle_sql()
    for key, fn in entry.queries().items():
        if only and key not in only:
            continue
        if key not in sqls:
            t0 = time.time()
            n = len(fn(session, target).collect())
            print(f"{key:28s} rows-only {n} {time.time() - t0:.1f}s", flush=True)
            continue
        try:
            problem, n, sec = compare(session, con_, target, fn, sqls[key])
            print(f"{key:28s} {'ok' if problem is None else 'DIFF ' + problem} rows={n} {sec:.1f}s", flush=True)
        except Exception as e:  # noqa: BLE001
            print(f"{key:28s} FAIL {str(e)[:700]}", flush=True)

"""Run a registered query and its DuckDB twin over one data folder and compare the results."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as registry  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value: object) -> tuple:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (1, repr(float(value)) if isinstance(value, float) else str(value))
    return (1, str(value))


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[str | None, int, float]:
    """(difference or None, rows, Spark seconds)"""
    started = time.time()
    df = registry.queries()[name](spark, sf_dir)
    got = _rows(df.columns, df.collect())
    seconds = time.time() - started
    cursor = con.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", len(got), seconds
    want = _rows(columns, cursor.fetchall())
    if got == want:
        return None, len(got), seconds
    left, right = set(got), set(want)
    first = [sorted(left - right)[:2], sorted(right - left)[:2]]
    return f"{len(got)} rows against {len(want)}: {first}", len(got), seconds


if __name__ == "__main__":
    from pitchside.session import local_session

    folder = sys.argv[1]
    names = sys.argv[2:] or list(registry.queries())
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for query in names:
        try:
            difference, n, took = compare(session, con, query, folder)
        except Exception as error:  # noqa: BLE001
            difference, n, took = f"{type(error).__name__}: {str(error)[:1500]}", 0, 0.0
        bad += difference is not None
        print(f"{'ok ' if difference is None else 'BAD'} {query:24} {n:8} rows {took:7.2f}s"
              f" {difference or ''}", flush=True)
    print(f"{bad} of {len(names)} differ")

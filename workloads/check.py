"""Compares registered queries with their SQL on DuckDB: ``python -m workloads.check [dir] [names]``."""

import sys
import time
from pathlib import Path

import duckdb

from nameledger.session import local_session
from workloads.queries import ORACLES, QUERIES


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both engines agree, else what differs."""
    got = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in got.collect()]
    if name not in ORACLES:
        return None
    want = con.sql(ORACLES[name])
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {got.columns} / {want.columns}"
    ours, theirs = rows_of(got.columns, rows), rows_of(want.columns, want.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows / {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} / {b}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, bad = local_session("check"), duck(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            issue = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            issue = f"{type(error).__name__}: {str(error)[:600]}"
        bad += issue is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if issue is None else 'BAD ' + issue}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

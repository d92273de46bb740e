"""Run queries next to their SQL and compare: columns, row counts and sorted values."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


TIMES = [0.0, 0.0]  # seconds of the last comparison: this engine, the other


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return 0.0 if value == 0 and isinstance(value, float) else value


def _sorted_rows(rows, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    t0 = time.time()
    got = _sorted_rows(df.collect(), df.columns)
    t1 = time.time()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = _sorted_rows(result.fetchall(), names)
    TIMES[:] = [t1 - t0, time.time() - t1]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows and {len(want)}; first {got[:1]} {want[:1]}"
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(wrong)} of {len(got)} rows, as {wrong[:2]}" if wrong else None


def main(sf_dir: str, names: list[str]) -> int:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES
    from checks.session import local_session

    spark, con, failed = local_session(), connect(sf_dir), 0
    for name in names or QUERIES:
        t0 = time.time()
        try:
            result = difference(QUERIES[name](spark, sf_dir), con, ORACLE[name])
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:500]}"
        failed += result is not None
        print(f"{name:26s} {time.time() - t0:6.2f}s (run {TIMES[0]:.1f}, other {TIMES[1]:.1f}) {'ok' if result is None else result}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

"""Compare queries with their oracles on one scale factor: ``python -m tests.oracle [sf_dir] [names]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from __spark_entry__ import oracle_sql, queries
from tallystream.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """Nothing when equal, otherwise what differs."""
    got = queries()[name](spark, sf_dir)
    got_rows = _canonical(got.columns, got.collect())
    want = con.execute(oracle_sql()[name])
    columns = [d[0] for d in want.description]
    want_rows = _canonical(columns, want.fetchall())
    if sorted(got.columns) != sorted(columns):
        return f"columns {sorted(got.columns)} against {sorted(columns)}"
    if len(got_rows) != len(want_rows):
        return f"{len(got_rows)} rows against {len(want_rows)}"
    for a, b in zip(got_rows, want_rows):
        if a != b:
            return f"{a}\n   against {b}"
    return None


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(queries())
    session = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    session.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    for n in names:
        start = time.time()
        try:
            what = compare(session, db, n, folder)
        except Exception as e:  # noqa: BLE001
            what = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{'ok  ' if what is None else 'FAIL'} {n} {time.time() - start:.1f}s {what or ''}", flush=True)

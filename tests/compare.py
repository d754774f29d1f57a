"""Run queries and their SQL twins side by side: ``python -m tests.compare [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb

from __spark_entry__ import oracle_sql, queries
from martloom.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 9)
    return value


def _ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def duck(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def compare(spark, con, folder: str, name: str) -> str | None:
    """None when equal, else what differs."""
    df = queries()[name](spark, folder)
    left = _ordered(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(oracle_sql()[name])
    right = _ordered([d[0] for d in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"{a} != {b}"
    return None if left[1] else "EMPTY"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(queries())
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            difference = compare(spark, con, folder, name)
        except Exception:
            difference = traceback.format_exc(limit=3)[-1500:]
        bad += difference is not None
        mark = "ok " if difference is None else "BAD"
        print(f"{mark} {time.time() - start:6.2f}s {name} {difference or ''}")
    print(f"{len(names) - bad}/{len(names)} equal")


if __name__ == "__main__":
    main()

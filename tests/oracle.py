"""Compare every registered query with its oracle statement in DuckDB.

Usage: python -m tests.oracle <data folder> [query name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def cell(value: object) -> str:
    """Text of a value that keeps the kind apart: a float is not an integer, NaN equals NaN."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return f"b:{value}"
    if isinstance(value, int):
        return f"i:{value}"
    if isinstance(value, float):
        return "f:nan" if math.isnan(value) else f"f:{value!r}"
    if isinstance(value, dt.datetime):
        return f"t:{value.isoformat()}"
    if isinstance(value, dt.date):
        return f"d:{value.isoformat()}"
    return f"{type(value).__name__}:{value}"


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, query, sql: str) -> tuple[bool, str]:
    df = query(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    if got == want:
        return True, f"{len(got)} rows"
    extra = sorted(set(got) - set(want))[:3]
    missing = sorted(set(want) - set(got))[:3]
    return False, f"{len(got)} vs {len(want)} rows\n   columns {sorted(names)}\n   spark  {extra}\n   oracle {missing}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from cartmetrics.session import build_session

    folder, *names = sys.argv[1:]
    spark = build_session("oracle", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracle = oracle_sql()
    bad = 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracle:
                ok, note = compare(spark, con, folder, run, oracle[name])
            else:
                ok, note = True, f"{run(spark, folder).count()} rows, no oracle"
        except Exception as error:  # report every query
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

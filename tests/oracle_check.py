"""Compare registered queries with their SQL; also runnable: ``oracle_check.py <sf_dir> [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def compare(df, con, sql: str) -> str | None:
    """None if both sides hold the same columns and rows, else what differs."""
    ours = df.toArrow()
    theirs = con.sql(sql).to_arrow_table()
    names = sorted(ours.column_names)
    if names != sorted(theirs.column_names):
        return f"columns {names} vs {sorted(theirs.column_names)}"
    if ours.num_rows != theirs.num_rows:
        return f"{ours.num_rows} rows vs {theirs.num_rows}"
    for name in names:
        a, b = str(ours.schema.field(name).type), str(theirs.schema.field(name).type)
        if a.removeprefix("large_") != b.removeprefix("large_"):
            return f"column {name}: {a} vs {b}"
    key = repr
    a = sorted(zip(*[ours.column(n).to_pylist() for n in names], strict=True), key=key)
    b = sorted(zip(*[theirs.column(n).to_pylist() for n in names], strict=True), key=key)
    for x, y in zip(a, b, strict=True):
        if x != y:
            return f"row {str(x)[:300]} vs {str(y)[:300]}"
    return None


if __name__ == "__main__":
    from logloom.oracle import ORACLE_SQL
    from logloom.registry import QUERIES
    from logloom.session import local_session

    spark = local_session(8)
    con = connect(sys.argv[1])
    wrong = 0
    for name, query in QUERIES.items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        if name not in ORACLE_SQL:
            print(f"NOSQL {name}", flush=True)
            continue
        try:
            problem = compare(query(spark, sys.argv[1]), con, ORACLE_SQL[name])
        except Exception as error:
            problem = str(error)[:800]
        wrong += problem is not None
        print(f"{'OK   ' if problem is None else 'WRONG'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    sys.exit(1 if wrong else 0)

"""Run queries on Spark and their SQL in DuckDB over the same folder and compare the rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from claimloom.plans.catalog import QUERIES
from claimloom.plans.oracle import ORACLE


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def differences(spark, con, folder: str, name: str) -> tuple[int, list]:
    """Row count, and a sample of rows found on one side only."""
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    left = Counter(tuple(row) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    result = con.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return sum(left.values()), [("columns", columns, sorted(names))]
    order = [names.index(c) for c in columns]
    right = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    diff = [("spark", r) for r in (left - right)] + [("sql", r) for r in (right - left)]
    return sum(left.values()), diff


if __name__ == "__main__":
    from claimloom.session import local_session

    folder = sys.argv[1]
    spark = local_session(8)
    con = connect(folder)
    for name in sys.argv[2:] or list(ORACLE):
        start = time.time()
        try:
            rows, diff = differences(spark, con, folder, name)
            print(f"{'SAME' if not diff else 'DIFF'} {name} rows={rows} diff={len(diff)} {time.time() - start:.1f}s", str(diff[:4])[:700] if diff else "", flush=True)
        except Exception as error:  # noqa: BLE001
            print(f"FAIL {name} {str(error)[:500]}", flush=True)

"""Compare registered queries with their SQL: ``python -m tests.oracle [sf_dir] [query ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession

from twinproof.workload.derived import TABLES


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, Decimal)):
        return str(Decimal(value).normalize())
    if isinstance(value, float):
        return repr(value)
    return str(value)


def _bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same rows, otherwise what differs."""
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    want = _bag(cursor.fetchall(), columns)
    got = _bag([tuple(r) for r in df.collect()], df.columns)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    if got != want:
        extra, lost = got - want, want - got
        return f"{sum(got.values())} rows, {sum(want.values())} wanted; only here {list(extra)[:3]}; only there {list(lost)[:3]}; {dict(df.dtypes)} {kinds}"
    return None


def main() -> int:
    from twinproof.session import get_session
    from twinproof.workload.queries import ORACLE, QUERIES

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark: SparkSession = get_session("oracle", "local[8]", 8, memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf)
            problem = compare(df, con, ORACLE[name]) if name in ORACLE else None
            rows = "" if name in ORACLE else f" rows={df.count()}"
        except Exception as e:  # noqa: BLE001
            problem, rows = f"{type(e).__name__}: {str(e)[:1500]}", ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s{rows} {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())

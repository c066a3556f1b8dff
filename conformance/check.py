"""Run queries beside their oracle and compare: ``python -m conformance.check [sf_dir] [names...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame

from conformance.oracle import oracle_sql
from conformance.queries import QUERIES
from conformance.views import TABLES
from lociweave.session import build_session


def _value(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float)):
        return None if isinstance(v, float) and math.isnan(v) else float(v)
    return str(v)


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both return the same rows, else what differs."""
    got = canonical(df.columns, df.collect())
    relation = con.sql(sql)
    want = canonical(relation.columns, relation.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        extra = [r for r in got[1] if r not in set(want[1])][:2]
        lost = [r for r in want[1] if r not in set(got[1])][:2]
        return f"rows {len(got[1])} vs {len(want[1])}; only spark {extra}; only sql {lost}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "conformance", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = oracle_connection(sf_dir), oracle_sql(), 0
    for name in names:
        start = time.perf_counter()
        try:
            df = QUERIES[name](spark, sf_dir)
            found = difference(df, con, sql[name]) if name in sql else None
            note = "no oracle, %d rows" % df.count() if name not in sql else "ok"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{name:28s} {time.perf_counter() - start:6.2f}s  {found or note}", flush=True)
    print(f"{len(names) - bad}/{len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main())

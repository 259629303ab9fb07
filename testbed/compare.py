"""Run registered queries in Spark and DuckDB and compare names, types and values.

    python -m testbed.compare [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from testbed import registry
from tillworks.session import build_session

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{Path(sf_dir) / (table + '.parquet')}'")
    return con


def _spark_type(t: T.DataType) -> str:
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    names = {"string": "VARCHAR", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP"}
    return names.get(t.simpleString(), t.simpleString().upper())


def _value(v):
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, Decimal):
        return str(v)
    return v


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    rel = con.sql(sql)
    mine = {f.name: _spark_type(f.dataType) for f in df.schema.fields}
    theirs = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    if mine.keys() != theirs.keys():
        return f"columns {sorted(mine.keys() ^ theirs.keys())}"
    order = sorted(mine)
    a = Counter(tuple(_value(r[c]) for c in order) for r in df.collect())
    at = [rel.columns.index(c) for c in order]
    b = Counter(tuple(_value(r[i]) for i in at) for r in rel.fetchall())
    if a != b:
        left, right = list((a - b).elements())[:2], list((b - a).elements())[:2]
        return (
            f"{sum(a.values())} vs {sum(b.values())} rows, {sum((a - b).values())} / {sum((b - a).values())} differ\n"
            f"    columns {order}\n    spark  {left}\n    duckdb {right}"
        )
    types = {c: (mine[c], theirs[c]) for c in order if mine[c] != theirs[c]}
    return f"types {types}" if types else None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("compare", spark__master="local[4]", spark__sql__shuffle__partitions="4")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    queries, oracle = registry.queries(), registry.oracle_sql()
    bad = 0
    for name in args.names or queries:
        start = time.time()
        try:
            df = queries[name](spark, args.sf)
            problem = compare(df, con, oracle[name]) if name in oracle else f"(no SQL) {df.count()} rows"
        except Exception as error:  # keep going, report at the end
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None and not problem.startswith("(no SQL)")
        print(f"{'ok  ' if problem is None else 'DIFF'} {name:32} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())

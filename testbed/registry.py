"""The registered queries: name -> (Spark query over a ``Warehouse``, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from testbed import queries_operators, queries_relations, queries_reports, queries_sources
from testbed.oracle_base import with_layers
from testbed.warehouse import Warehouse

ALL = queries_sources.QUERIES | queries_operators.QUERIES | queries_relations.QUERIES | queries_reports.QUERIES


def _bind(build: Callable[[Warehouse], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(Warehouse.open(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(build) for name, (build, _) in ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: with_layers(sql) for name, (_, sql) in ALL.items() if sql is not None}

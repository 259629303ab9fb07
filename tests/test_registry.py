"""The registered queries against DuckDB. Set TILLWORKS_ALL=1 to compare every one of them."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

from testbed import registry
from testbed.compare import compare, connect
from tillworks.operators import ordering
from tillworks.plans import dashboards, marts, staging

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
SOME = [
    *staging.BUILDERS, "monthly_profit", "product_performance", "unit_performance", "src_scan_tab", "dash_top10_products",
]


def test_every_query_has_sql_and_a_plain_name():
    assert registry.queries().keys() == registry.oracle_sql().keys()
    assert dashboards.QUERIES.keys() <= registry.queries().keys() and len(registry.queries()) >= 174


@needs_data
@pytest.mark.parametrize("name", registry.queries() if os.environ.get("TILLWORKS_ALL") else SOME)
def test_same_as_duckdb(spark, name):
    df = registry.queries()[name](spark, SF)
    assert compare(df, connect(SF), registry.oracle_sql()[name]) is None


@needs_data
@pytest.mark.parametrize("name", ["order_pnl_table", "order_top10_products", "dash_low_stock_unbooked", "dq_stock_never_negative_unbooked"])
def test_reports_have_rows_in_order(spark, name):
    df = registry.queries()[name](spark, SF)
    assert df.count() > 3 and compare(df, connect(SF), registry.oracle_sql()[name]) is None


@needs_data
@pytest.mark.parametrize("name", ["upper_name", "parse_bool_flag"])
def test_columns_that_differ_in_case_can_be_written(spark, tmp_path, name):
    df = registry.queries()[name](spark, SF)
    df.write.parquet(f"{tmp_path}/{name}")
    assert compare(spark.read.parquet(f"{tmp_path}/{name}"), connect(SF), registry.oracle_sql()[name]) is None


def test_a_broken_order_is_seen(spark):
    rows = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b"), (None, "d")], "v int, k string")
    sql = "SELECT v, row_number() OVER (ORDER BY v DESC NULLS LAST) AS position FROM (VALUES (3), (1), (2), (NULL)) t(v)"
    right = ordering.numbered(ordering.sort_by(rows, "-v")).select("v", "position")
    assert compare(right, duckdb.connect(), sql) is None
    for wrong in (rows, ordering.sort_by(rows, "v")):
        assert "differ" in compare(ordering.numbered(wrong).select("v", "position"), duckdb.connect(), sql)


@needs_data
def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == marts.COLUMNS["monthly_profit"] and df.count() > 0


def test_keys_are_checked_without_building_tables(spark, tmp_path):
    from testbed.queries_relations import dq_unique
    from testbed.warehouse import Warehouse

    tables = {
        "nation": ("n_nationkey int, n_name string", [(1, "KENYA")]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int", [(1, "Ann")]),
        "customer": ("c_custkey long, c_name string, c_nationkey int", [(1, "Bob")]),
        "part": ("p_partkey long, p_name string, p_brand string, p_size int, p_retailprice double", [(10, "red pan", "B1", 3, 9.5)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderdate string, o_orderpriority string, o_totalprice double, o_orderstatus string",
                   [(1, 1, "2000-01-05", "2-HIGH", 12.0, "F")]),
        "lineitem": ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate string, l_returnflag string, "
                     "l_linestatus string, l_quantity double, l_discount double",
                     [(1, 1, 10, 1, "2000-02-03", f, "O", 4.0, 0.05) for f in ("N", "N", "R", "R", "R")]),
    }
    for name, (schema, rows) in tables.items():
        rows = [(*r, 1) for r in rows] if name in ("supplier", "customer") else rows
        df = spark.createDataFrame(rows, schema)
        df.withColumns({c: df[c].cast("date") for c in df.columns if c.endswith("date")}).write.parquet(f"{tmp_path}/{name}.parquet")
    w = Warehouse(spark, str(tmp_path))
    planned = sorted(tuple(r) for r in dq_unique(w).collect())
    assert not w.built  # all tables were stored before
    assert [(t, c, n) for t, c, _, n in planned] == [
        ("products_raw", "Product_Name", 2), ("returns_analysis", "return_id", 3), ("stg_inventory_purchases", "purchase_id", 5),
        ("stg_returns", "return_id", 3), ("stg_sales", "sale_id", 2),
    ]
    for table in ("inventory_position", "returns_analysis", "stg_expenses"):
        w.any(table)
    w.raw("products_raw")
    assert sorted(tuple(r) for r in dq_unique(w).collect()) == planned

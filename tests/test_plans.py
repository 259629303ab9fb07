"""Physical plans: what must hold so that the jobs survive large and skewed data."""

from __future__ import annotations

import datetime as dt
import re
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rows import given_tables

from testbed import queries_relations, warehouse
from tillworks import session
from tillworks.operators import joins, windows
from tillworks.plans import marts, quality, staging
from tillworks.sources import layers
from tillworks.values import TABS

SALES = 40_000
BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups")


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
SPLIT_EARLY = NO_BROADCAST | {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
}


@contextmanager
def settings(spark, conf):
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in conf:
            spark.conf.unset(key)


def filters(df):
    """The conditions in the optimized plan."""
    return re.findall(r"Filter (.*?)\+- ", df._jdf.queryExecution().optimizedPlan().toString(), re.S)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Staging tables in which one product, unit, person and phone hold a third of all rows."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    day = F.date_add(F.lit(dt.date(2025, 1, 1)), (F.col("id") % 90).cast("int"))
    hot = F.col("id") % 3 == 0

    def pick(prefix, n):
        return F.when(hot, F.lit(f"{prefix}0")).otherwise(F.concat(F.lit(prefix), F.col("id") % n))

    base = spark.range(SALES).select(
        F.col("id").cast("string").alias("sale_id"), day.alias("sale_date"), pick("P", 40).alias("salesperson_name"),
        pick("p", 700).alias("product_key"), (F.col("id") % 5 + 1).alias("units_sold"),
        (F.col("id") % 7 * 10 + 90).cast("decimal(27,9)").alias("unit_price"),
        F.lit(5).cast("decimal(27,9)").alias("discount_amount"),
        F.when(F.col("id") % 2 == 0, "Bank").otherwise("M-Pesa").alias("payment_method"),
        F.concat(F.lit("07"), F.lpad(F.when(hot, 0).otherwise(F.col("id") % 900).cast("string"), 8, "0")).alias("customer_phone"),
        F.lit("").alias("customer_type"), F.when(F.col("id") % 11 != 0, pick("U", 12)).alias("unit"),
        F.lit(None).cast("string").alias("notes"), F.lit(dt.datetime(2025, 1, 1)).alias("submitted_at"),
    )
    sales = base.withColumns({
        "gross_amount": (F.col("units_sold").cast("decimal(10,0)") * F.col("unit_price")).cast("decimal(18,2)"),
        "net_amount": (F.col("units_sold").cast("decimal(10,0)") * F.col("unit_price") - 5).cast("decimal(18,2)"),
    })
    renamed = {"sale_id": "return_id", "sale_date": "return_date", "units_sold": "units_returned",
               "unit_price": "original_unit_price", "net_amount": "return_value"}
    returns = sales.filter("sale_id % 4 = 1 or product_key = 'p0'").withColumnsRenamed(renamed).withColumns({
        "return_reason": F.lit("Other"), "refund_method": F.lit("Bank")}).select(staging.COLUMNS["stg_returns"])
    expenses = base.select(
        F.col("sale_id").alias("expense_id"), F.col("sale_date").alias("expense_date"), F.lit("Water").alias("expense_category"),
        F.col("unit_price").alias("amount"), F.col("notes").alias("description"), F.lit("Bank").alias("paid_via"),
        F.lit("x").alias("recorded_by"), "unit", "submitted_at")
    products = spark.range(700).select(
        F.concat(F.lit("p"), F.col("id")).alias("product_key"), F.concat(F.lit("Product "), F.col("id")).alias("product_name"),
        F.lit("f").alias("product_family"), F.lit(None).cast("string").alias("product_variant"), F.lit("Other").alias("category"),
        F.lit("Set").alias("unit_of_measure"), F.lit(200).cast("decimal(27,9)").alias("selling_price"),
        F.when(F.col("id") % 9 != 0, 100).cast("decimal(27,9)").alias("cost_price"),
        F.lit(100).cast("decimal(28,2)").alias("unit_margin_kes"), F.lit(50).cast("decimal(28,1)").alias("unit_margin_pct"),
        F.lit(5).cast("bigint").alias("reorder_level"), (F.col("id") % 10 != 9).alias("is_active"), F.lit(dt.datetime(2025, 1, 1)).alias("submitted_at"))
    purchases = base.select(
        F.col("sale_id").alias("purchase_id"), F.col("sale_date").alias("purchase_date"), "product_key",
        F.col("units_sold").alias("units_purchased"), F.col("unit_price").alias("unit_cost"),
        F.lit(7).cast("decimal(18,2)").alias("total_cost"), F.lit("s").alias("supplier_name"), "payment_method", "unit", "notes", "submitted_at")
    units = spark.range(12).select(F.concat(F.lit("U"), F.col("id")).alias("unit_name"), F.col("id").cast("int").alias("sort_order"))
    frames = {"stg_sales": sales, "stg_returns": returns, "stg_expenses": expenses, "stg_products": products,
              "stg_inventory_purchases": purchases, "business_units": units}
    for name, df in frames.items():
        df.repartition(6).write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in frames}


def build(skewed, mart):
    builder, inputs, takes_as_of = marts.BUILDERS[mart]
    return builder(*(skewed[i] for i in inputs), **({"as_of": dt.date(2025, 6, 1)} if takes_as_of else {}))


@pytest.mark.parametrize("mart", marts.BUILDERS)
def test_no_cross_join_and_no_python(spark, skewed, mart):
    text = plan(build(skewed, mart))
    assert not [b for b in BAD if b in text]


@pytest.mark.parametrize("mart", marts.BUILDERS)
def test_result_does_not_depend_on_join_strategy(spark, skewed, mart):
    """Broadcast joins, plain sort-merge joins and skew-split sort-merge joins give the same rows."""
    results = []
    for conf in ({}, NO_BROADCAST, SPLIT_EARLY):
        with settings(spark, conf):
            results.append(sorted(map(repr, build(skewed, mart).collect())))
    assert results[0] == results[1] == results[2] and results[0]


@pytest.mark.parametrize("job", ["returns_analysis", "sale_price_above_cost", "orphans"])
def test_a_hot_product_is_split_where_single_rows_are_joined(spark, skewed, job):
    sales, products = skewed["stg_sales"], skewed["stg_products"]
    jobs = {
        "returns_analysis": lambda: build(skewed, "returns_analysis"),
        "sale_price_above_cost": lambda: quality.sale_price_above_cost(sales, skewed["stg_inventory_purchases"]),
        "orphans": lambda: joins.orphans(sales.select("sale_id", "product_key"), products.filter("product_key <> 'p1'"), "product_key"),
    }
    with settings(spark, SPLIT_EARLY):
        df = jobs[job]()
        split = sorted(map(repr, df.collect()))
        assert "skew=true" in plan(df)
    assert split == sorted(map(repr, jobs[job]().collect()))


def test_brute_force_sums_on_skewed_data(spark, skewed):
    """The two-step cost sums against the direct row-by-row join."""
    direct = skewed["stg_sales"].join(skewed["stg_products"].select("product_key", "cost_price"), "product_key", "left")
    cost = F.col("units_sold").cast("decimal(10,0)") * F.coalesce("cost_price", F.lit(0))
    margin = F.greatest(F.col("unit_price") - F.coalesce("cost_price", F.lit(0)), F.lit(0)) * F.col("units_sold").cast("decimal(10,0)")
    by_unit = {(r.month, r.unit): r.c for r in direct.groupBy(F.trunc("sale_date", "MM").alias("month"), "unit").agg(F.sum(cost).alias("c")).collect()}
    assert {(r.month, r.unit): r.total_cogs for r in build(skewed, "monthly_profit").collect()} == by_unit
    by_product = {(r.month, r.product_key): r.m for r in direct.groupBy(F.trunc("sale_date", "MM").alias("month"), "product_key").agg(F.sum(margin).alias("m")).collect()}
    perf = build(skewed, "product_performance").filter("total_transactions > 0").collect()
    assert perf and all(r.total_gross_profit + r.total_return_value == by_product[r.month, r.product_key] for r in perf)


def test_products_are_limited_per_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    latest = windows.latest_per_key(df, ["k"], [F.col("id").desc()])
    text = plan(latest)
    assert text.count("WindowGroupLimit") == 2  # below and above the exchange
    assert sorted(r.id for r in latest.collect()) == [997, 998, 999]


@pytest.mark.parametrize("job", ["inventory_position", "sale_price_above_cost"])
def test_latest_cost_is_hashed_not_sorted(skewed, job):
    jobs = {
        "inventory_position": lambda: build(skewed, "inventory_position"),
        "sale_price_above_cost": lambda: quality.sale_price_above_cost(skewed["stg_sales"], skewed["stg_inventory_purchases"]),
    }
    assert "SortAggregate" not in plan(jobs[job]())


def suite(skewed):
    return quality.suite_summary(lambda t: skewed[t] if t in skewed else build(skewed, t), dt.date(2025, 6, 1))


def test_the_suite_reads_each_table_once(spark, skewed, tmp_path):
    """All checks of a table come from one scan; purchases are read once more for the latest costs."""
    stored = dict(skewed)
    for mart in marts.BUILDERS:
        build(skewed, mart).write.parquet(f"{tmp_path}/{mart}")
        stored[mart] = spark.read.parquet(f"{tmp_path}/{mart}")
    text = plan(suite(stored))
    assert "SortAggregate" not in text
    for fact, most in (("stg_sales", 1), ("stg_returns", 1), ("stg_expenses", 1), ("stg_inventory_purchases", 2)):
        assert len([line for line in text.splitlines() if "FileScan" in line and f"/{fact}]" in line]) == most, fact


def test_unit_performance_reads_sales_once(skewed):
    """Next to one scan of the columns it sums, only the dates are read again, for the months of the spine."""
    scans = [line for line in plan(build(skewed, "unit_performance")).splitlines() if "FileScan" in line and "/stg_sales" in line]
    assert len([line for line in scans if "net_amount" in line.split("Batched")[0]]) == 1
    assert len([line for line in scans if "product_key" in line.split("Batched")[0]]) == 1


def test_only_needed_columns_are_read(skewed):
    text = plan(build(skewed, "unit_performance"))
    for line in text.splitlines():
        if "FileScan" in line and "stg_sales" in line:
            assert "customer_phone" not in line.split("Batched")[0] and "notes" not in line.split("Batched")[0]


def test_products_in_all_months_read_sales_once(spark, skewed):
    """The list of months comes from the shuffled arrays of the products themselves."""
    df = build(skewed, "product_performance")
    df.collect()
    ran = plan(df)
    assert ran.count("ReusedExchange") >= 1 and "isFinalPlan=true" in ran
    scans = re.findall(r"\*\(\d+\) ColumnarToRow\s+[ :+-]*FileScan parquet \[[^\]]*\].*?stg_(\w+)\]", ran)
    assert scans.count("sales") == 1 and scans.count("returns") == 1
    assert "element_at" not in ran and "map_from_entries" not in ran


@pytest.mark.parametrize("mart", marts.BUILDERS)
def test_distinct_counts_do_not_multiply_rows(spark, skewed, mart):
    assert "Expand" not in plan(build(skewed, mart))


def test_products_go_through_two_shuffles(spark, skewed):
    """Sales and returns are summed per price, then sent to their product; the rest happens there."""
    with settings(spark, NO_BROADCAST):
        text = plan(build(skewed, "product_performance"))
    keys = re.findall(r"Exchange hashpartitioning\((.*?)\), [ER]", text)
    # Two of movements, one of products' costs, one of products; the list of months repeats the first three and reuses them.
    assert 0 < len(keys) <= 7, keys
    keys = re.findall(r"Exchange hashpartitioning\((.*?)\), [ER]", plan(build(skewed, "product_performance")))
    assert 0 < len(keys) <= 5, keys  # with costs broadcast
    assert "product_performance" not in marts.PARTITION_BY  # its dense rows stay where they are made


@pytest.mark.parametrize("mart", ["salesperson_performance", "customer_insights"])
def test_days_are_counted_without_grouping_by_day(skewed, mart):
    """Sales shuffle as one row per task, person or phone, and month."""
    keys = re.findall(r"Exchange hashpartitioning\((.*?)\), ENSURE", plan(build(skewed, mart)))
    assert keys and not any("sale_date" in k for k in keys)


def test_days_of_a_month_with_and_without_dates(spark):
    rows = [("a", dt.date(2025, 3, d)) for d in (1, 31, 31, 2)] + [("b", None), ("c", dt.date(2025, 1, 31)), ("c", None)]
    df = spark.createDataFrame(rows, "k string, d date")
    got = df.groupBy("k").agg(marts._days_of_month("d").alias("n"), F.count_distinct("d").alias("m")).collect()
    assert len(got) == 3 and all(r.n == r.m for r in got)


def test_staging_keeps_no_copy_of_raw_rows(spark, tmp_path):
    """Raw rows that only staging reads are not stored, and layer tables are packed densely."""
    from testbed.warehouse import Warehouse
    from tillworks.values import RAW_DB, STAGING_DB

    w = Warehouse(spark, "/root/testdata/sf0.001")
    w.folder = str(tmp_path)
    w.layers = type(w.layers)(spark, str(tmp_path), "plans_")
    assert w.staging("stg_expenses").count() > 0
    assert not w.layers.exists(RAW_DB, "expenses_raw")
    assert w.staging("stg_expenses").inputFiles() and all("zstd" in f for f in w.staging("stg_expenses").inputFiles())
    assert w.layers.exists(STAGING_DB, "stg_expenses")


def test_tasks_do_not_grow_with_the_tables(spark, tmp_path):
    """Shuffles begin with more partitions for larger tables, splits and merged partitions stay small."""
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with open(tmp_path / "lineitem.parquet", "wb") as file:
        file.truncate(400 << 20)
    before = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        warehouse.scale_shuffles(spark, str(tmp_path / "none"))
        assert spark.conf.get(name, None) is None
        for least, want in ((None, 100), ("70", 100), ("300", 300)):
            if least:
                spark.conf.set(name, least)
            warehouse.scale_shuffles(spark, str(tmp_path))
            assert int(spark.conf.get(name)) == want
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)
    assert int(session.RUNTIME_SETTINGS["spark.sql.files.maxPartitionBytes"].removesuffix("m")) < 128
    assert int(session.RUNTIME_SETTINGS["spark.sql.adaptive.advisoryPartitionSizeInBytes"].removesuffix("m")) < 64


def test_parsed_columns_are_computed_once(spark):
    raw = spark.createDataFrame([("5/4/2025", "x", "2")], "Date string, Product string, Units_Sold string")
    other = [c for c in TABS["Sales"].columns if c not in raw.columns]
    raw = raw.select("*", *(F.lit("1").alias(c) for c in other))

    def parses(whole):  # a filter that moved below the projection parses for itself
        return sum(condition.count("gettimestamp(") for condition in filters(staging.stg_sales(raw, whole)))

    assert parses(True) == 0 < parses(False)
    assert staging.stg_sales(raw).collect() == staging.stg_sales(raw, whole=False).collect()


def test_a_single_report_stores_no_mart(spark, tmp_path):
    """The first report that reads a mart stores nothing and aggregates only its months; the next one stores the mart."""
    lines = [(o, n, p, 1, f"2000-0{m}-03", f, "O", 4.0, 0.05) for o, m in ((1, 5), (2, 6)) for n, p, f in ((1, 10, "N"), (2, 12, "N"), (3, 10, "R"))]
    given_tables(spark, tmp_path, parts=[(10, "red pan", "B1", 3, 9.5), (12, "jar", "B2", 4, 5.0)], lines=lines)
    w = warehouse.Warehouse(spark, str(tmp_path))
    report, other = (queries_relations.QUERIES[n][0] for n in ("dash_revenue_by_category", "dash_bottom10_products"))
    first = sorted(tuple(r) for r in report(w).collect())
    assert len(first) == 2 and sum(r[1] for r in first) > 0
    again = report(w)
    assert sum("trunc(" in condition and "MM" in condition for condition in filters(again)) >= 2  # of sales and of returns
    assert not w.built and sorted(tuple(r) for r in again.collect()) == first
    assert len(other(w).collect()) == 2 and "product_performance" in w.built
    assert sorted(tuple(r) for r in report(w).collect()) == first


def test_checks_look_at_few_columns_of_marts(spark, tmp_path):
    """Marts are not stored for checks, product months are aggregated without measures, and keys are counted as they are."""
    lines = [(1, n, 10, 1, "2000-05-03", f, "O", 4.0, 0.05) for n, f in ((1, "N"), (2, "N"), (3, "R"))]
    given_tables(spark, tmp_path, parts=[(10, "red pan", "B1", 3, 9.5)], lines=lines)
    w = warehouse.Warehouse(spark, str(tmp_path))
    found = {}
    for name in ("dq_not_null", "dq_unique_combination", "dq_suite_summary"):
        found[name] = sorted(map(str, queries_relations.QUERIES[name][0](w).collect()))
    assert w.built == set(staging.BUILDERS)
    checked = w.checked("product_performance")
    assert checked.columns == ["month", "product_key"]
    assert "sum(" not in checked._jdf.queryExecution().optimizedPlan().toString()
    for mart in marts.BUILDERS:
        w.mart(mart)
    for name, rows in found.items():
        assert sorted(map(str, queries_relations.QUERIES[name][0](w).collect())) == rows


def test_keys_with_nulls_and_repeats_are_counted_by_their_columns(spark):
    rows = [("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1), (None, None), ("-", None)]
    df = spark.createDataFrame(rows, "unit string, month int")
    checks = quality.TableChecks(not_null=("unit",), unique_combination=(("month", "unit"),))
    assert quality._about_one_key(checks) and not quality._about_one_key(quality.DECLARED["returns_analysis"])
    by_columns, by_text = (f(df) for f in (lambda d: quality._key_checks(d, "t", checks), lambda d: quality._table_checks(d, "t", checks, [])))
    assert by_columns.schema == by_text.schema and by_columns.collect() == by_text.collect()
    assert [r.failures for r in by_columns.collect()] == [3, 2]
    assert plan(df.repartition(3, "unit").transform(lambda d: quality._key_checks(d, "t", checks))).count("hashpartitioning(") == 1


def test_a_written_table_keeps_no_shuffle_files(spark, tmp_path):
    setting = layers.DROP_SHUFFLES
    stored = layers.Layers(spark, str(tmp_path), "shuffles_")
    def shuffle_files():
        return len(list(local.glob("blockmgr-*/*/shuffle_*.data")))

    local = Path(spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()[0].getParent())
    seen = []
    with layers.dropping_shuffles(spark), layers.dropping_shuffles(spark):
        seen.append(spark.conf.get(setting))
    seen.append(spark.conf.get(setting))
    assert seen == ["true", "false"]
    before = shuffle_files()
    stored.replace(spark.range(10).groupBy(F.col("id") % 3).count().toDF("a", "b"), "retail_marts", "sums")
    assert shuffle_files() <= before
    assert spark.conf.get(setting) == "false" and stored.mart("sums").count() == 3

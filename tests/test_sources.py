from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from rows import raw, staged

from tillworks.plans import marts
from tillworks.sources import external, load, seeds, tabs
from tillworks.sources.layers import Layers
from tillworks.values import BUSINESS_UNITS, RAW_DB, TABS

NOON = dt.datetime(2025, 5, 4, 12, tzinfo=dt.timezone.utc)
EXPENSE_HEADERS = [h for h, _ in TABS["Expenses"].headers]


@pytest.fixture
def layers(spark, tmp_path, request):
    return Layers(spark, str(tmp_path / "layers"), request.node.name.split("[")[0] + "_")


def export(path, headers, *rows):
    path.mkdir(parents=True)
    lines = [",".join(f'"{c}"' if c else "" for c in row) for row in (headers, *rows)]
    (path / "part-0.csv").write_text("\n".join(lines) + "\n")
    return str(path)


def test_scan_keeps_text_and_line_breaks(spark, tmp_path):
    path = export(tmp_path / "t", ["Timestamp", "Notes"], ["007", ' two\nlines, and a "" quote '], ["", "nan"])
    rows = tabs.scan_tab(spark, path, multiline=True).collect()
    assert [tuple(r) for r in rows] == [("007", ' two\nlines, and a " quote '), (None, "nan")]


def test_parts_with_other_headers_are_refused(spark, tmp_path):
    path = export(tmp_path / "t", ["Timestamp", "Notes"], ["a", "b"])
    (tmp_path / "t" / "part-1.csv").write_text("Notes,Timestamp\nb,a\n")
    with pytest.raises(Exception, match="(?i)header"):
        tabs.scan_tab(spark, path).collect()


def test_header_drift(spark):
    df = spark.createDataFrame([("a", "b", "c")], "`  Product ` string, `Foo` string, `Unit Price (KES)` string")
    assert tabs.rename_headers(df, "Sales").columns == ["Product", "Unit_Price_KES"]
    drift = {(r.kind, r.header) for r in tabs.drift_report(df, "Sales").collect()}
    assert ("unknown", "Foo") in drift and ("missing", "Business Unit") in drift and len(drift) == 11
    prepared = tabs.prepare(df, "Sales", NOON)
    assert prepared.columns == [*TABS["Sales"].columns, "_loaded_at", "_source"]
    row = prepared.first()
    assert (row.Product, row.Unit_Price_KES, row.Business_Unit) == ("a", "c", None)
    assert (row["_loaded_at"], row["_source"]) == ("2025-05-04T12:00:00+00:00", "google_sheets_python_etl")
    twice = spark.createDataFrame([("a", "b")], "`Product` string, ` Product` string")
    with pytest.raises(ValueError, match="twice"):
        tabs.rename_headers(twice, "Sales")


def test_null_sentinels(spark):
    texts = ["", "None", "nan", " ", "NaN", "none", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    assert [r.c for r in tabs.null_sentinels(df).collect()] == [None, None, None, " ", "NaN", "none", "x", None]


def test_numbers_become_text(spark):
    df = spark.createDataFrame([(5, 2.5)], "`Units Sold` int, `Unit Price (KES)` double")
    row = tabs.prepare(df, "Sales", NOON).first()
    assert (row.Units_Sold, row.Unit_Price_KES) == ("5", "2.5")


def test_replace_is_idempotent(layers, spark):
    df = raw(spark, "expenses_raw", {"Amount_KES": "1"}, {"Amount_KES": "2"})
    for _ in range(2):
        layers.replace(df, RAW_DB, "expenses_raw")
    assert layers.raw("expenses_raw").count() == 2
    layers.replace(df.limit(0), RAW_DB, "expenses_raw")
    assert layers.raw("expenses_raw").count() == 0


def test_partitioned_table_keeps_declared_order(layers, spark):
    df = spark.createDataFrame([(dt.date(2025, m, 1), f"p{i}", i) for m in (1, 2) for i in range(5)], "month date, k string, v int")
    layers.replace(df, RAW_DB, "t", partition_by="month")
    stored = layers.raw("t")
    assert sorted(map(tuple, stored.select("month", "k", "v").collect())) == sorted(map(tuple, df.collect()))
    plan = stored.filter("month = date'2025-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_empty_tab_gives_full_schema(layers, spark):
    assert load.load_tab(layers, "Returns", tabs.empty_tab(spark), NOON) == 0
    assert layers.raw("returns_raw").schema.fieldNames() == tabs.raw_schema("Returns").fieldNames()


def test_a_failing_tab_does_not_stop_the_others(layers, tmp_path):
    good = export(tmp_path / "expenses", EXPENSE_HEADERS, ["x"] * 8, ["y"] * 8)
    exports = {"Expenses": good, "Sales": str(tmp_path / "nowhere")}
    status = {r.tab: r for r in load.load_all_tabs(layers, exports, NOON, strict=False).collect()}
    assert status.keys() == TABS.keys()
    assert (status["Expenses"].status, status["Expenses"].rows, status["Expenses"].error) == ("loaded", 2, None)
    assert status["Sales"].status == status["Returns"].status == "failed" and "nowhere" in status["Sales"].error
    with pytest.raises(load.LoadError) as caught:
        load.load_all_tabs(layers, exports, NOON)
    assert "Expenses" not in caught.value.failed and caught.value.status.count() == 5


def test_seeds(layers, tmp_path):
    seeds.load_seeds(layers)
    assert [r.unit_name for r in layers.raw("business_units").orderBy("sort_order").collect()] == list(BUSINESS_UNITS)
    assert layers.raw("product_categories").count() == 7
    (tmp_path / "u.csv").write_text("unit_name,sort_order\nA & B,1\nC,2\n")
    seeds.load_seeds(layers, {"business_units": str(tmp_path / "u.csv")})
    assert [tuple(r) for r in layers.raw("business_units").orderBy("sort_order").collect()] == [("A & B", 1), ("C", 2)]


def test_external_tab_reads_live(layers, tmp_path):
    path = export(tmp_path / "e", EXPENSE_HEADERS, ["x"] * 8)
    for _ in range(2):  # dropped and re-created
        external.create_external_tab(layers, "expenses_raw", path, TABS["Expenses"].columns)
    assert layers.raw("expenses_raw").columns == TABS["Expenses"].columns
    assert layers.raw("expenses_raw").count() == 1


def test_a_failed_write_keeps_the_old_table(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "kept"), "kept_")
    rows = spark.createDataFrame([(1,), (2,)], "a int")
    layers.replace(rows, "retail_raw", "some_raw")
    broken = rows.select(F.when(F.col("a") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("a")).cast("int").alias("a"))
    with pytest.raises(Exception, match="broken"):
        layers.replace(broken, "retail_raw", "some_raw")
    assert sorted(r.a for r in layers.raw("some_raw").collect()) == [1, 2]
    layers.replace(rows.limit(1), "retail_raw", "some_raw")
    layers.drop_versions("retail_raw", "some_raw")
    assert layers.raw("some_raw").count() == 1
    assert len([p for p in (tmp_path / "kept" / "kept_retail_raw" / "some_raw").iterdir()]) == 1


def test_a_table_keeps_its_declared_columns_and_types(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "typed"), "typed_")
    summary = marts.expense_summary(staged(spark, "stg_expenses"))
    layers.replace(summary, "retail_marts", "expense_summary", "month_start")
    with pytest.raises(ValueError, match="total_amount"):
        layers.replace(summary.withColumn("total_amount", F.col("total_amount").cast("decimal(20,2)")), "retail_marts", "expense_summary")
    with pytest.raises(ValueError, match="month_start"):
        layers.replace(summary.drop("month_start"), "retail_marts", "expense_summary")
    with pytest.raises(ValueError, match="no type"):
        layers.replace(spark.sql("SELECT NULL AS a"), "retail_raw", "void_raw")


def test_types_are_declared_before_anything_is_stored(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "first"), "first_")
    summary = marts.expense_summary(staged(spark, "stg_expenses"))
    with pytest.raises(ValueError, match=r"total_amount.*decimal\(30,2\)"):
        layers.replace(summary.withColumn("total_amount", F.col("total_amount").cast("decimal(30,2)")), "retail_marts", "expense_summary")
    with pytest.raises(ValueError, match="Amount_KES"):
        layers.replace(raw(spark, "expenses_raw", {"Amount_KES": "1"}).withColumn("Amount_KES", F.lit(1)), RAW_DB, "expenses_raw")
    with pytest.raises(ValueError, match="sort_order"):
        layers.replace(spark.sql("SELECT 'a' AS unit_name, 1L AS sort_order"), RAW_DB, "business_units")
    assert not any(layers.exists(*t) for t in (("retail_marts", "expense_summary"), (RAW_DB, "expenses_raw"), (RAW_DB, "business_units")))


@pytest.mark.parametrize("step", ["write", "CREATE TABLE", "MSCK", "CREATE OR REPLACE VIEW", "DROP TABLE"])
def test_a_replacement_that_fails_at_any_step_leaves_a_readable_table(spark, tmp_path, step):
    layers = Layers(spark, str(tmp_path / "steps"), f"steps_{step[:4].lower().strip()}{len(step)}_")
    month, later = dt.date(2025, 1, 1), dt.date(2025, 2, 1)

    def rows(n):
        return spark.createDataFrame([(month, n), (later, n)], "month date, v int")

    def read():
        return sorted(layers.raw("t").where("month >= date'2025-01-01'").collect())

    for n in (1, 2):
        layers.replace(rows(n), RAW_DB, "t", partition_by="month")
    before = layers.raw("t")
    sql = spark.sql

    def failing(text, *args, **kwargs):
        if text.startswith(step):
            raise RuntimeError("lost the catalog")
        return sql(text, *args, **kwargs)

    broken = rows(3)
    if step == "write":
        broken = broken.withColumn("v", F.when(F.col("month") == later, F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("int"))
    spark.sql = failing
    try:
        with pytest.raises(Exception, match="lost"):
            layers.replace(broken, RAW_DB, "t", partition_by="month")
    finally:
        del spark.sql
    want = 3 if step == "DROP TABLE" else 2
    assert [r.v for r in read()] == [want, want] and [r.v for r in before.collect()] == [2, 2]
    for n in range(4, 8):
        layers.replace(rows(n), RAW_DB, "t", partition_by="month")
        assert [r.v for r in read()] == [n, n] and len(layers.versions(RAW_DB, "t")) <= 1
    folders = [p for p in (tmp_path / "steps" / f"{layers.prefix}{RAW_DB}" / "t").iterdir() if p.is_dir()]
    assert len(folders) == 2


def test_a_table_of_another_kind_is_replaced(layers, spark, tmp_path):
    path = export(tmp_path / "e", EXPENSE_HEADERS, ["x"] * 8)
    external.create_external_tab(layers, "expenses_raw", path, TABS["Expenses"].columns)
    layers.replace(raw(spark, "expenses_raw", {"Amount_KES": "1"}), RAW_DB, "expenses_raw")
    assert [r.Amount_KES for r in layers.raw("expenses_raw").collect()] == ["1"]
    external.create_external_tab(layers, "expenses_raw", path, TABS["Expenses"].columns)
    assert [r.Amount_KES for r in layers.raw("expenses_raw").collect()] == ["x"]

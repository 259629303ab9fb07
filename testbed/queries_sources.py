"""Reading, aligning, loading and replacing tables, over form tabs derived from the whole given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from testbed import oracle_base as sql
from testbed.queries_relations import QUERIES as RELATIONS
from testbed.warehouse import CHECK_DAY, LOADED_AT, Warehouse
from tillworks.operators.sets import stack
from tillworks.plans.rebuild import rebuild
from tillworks.sources import external, load, seeds, tabs
from tillworks.values import LOADED_AT as LOADED_AT_COLUMN
from tillworks.values import RAW_DB, SOURCE, SOURCE_LABEL, STAGING_DB, TABS

STAMP = LOADED_AT.isoformat()


def form_tab(w: Warehouse, tab_name: str) -> DataFrame:
    """A raw table under its form headers, as an export would hold it."""
    tab = TABS[tab_name]
    raw = w.raw(tab.table)
    return raw.select(*(F.col(c).alias(h) for h, c in tab.headers))


def export_csv(w: Warehouse, tab_name: str) -> str:
    """The form tab as CSV part files, written once per session. Spark's writer would trim the cells by default."""
    path = w.scratch(f"export_{tab_name}")
    as_is = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    w._once(f"export_{tab_name}", lambda: form_tab(w, tab_name).write.mode("overwrite").options(**as_is).csv(path))
    return path


def scan(spark, path: str) -> DataFrame:
    return tabs.scan_tab(spark, path, multiline=False)  # no derived cell holds a line break


def _cells(tab_name: str, named: bool = True, blank: bool = True) -> str:
    """The tab's columns in SQL, under form headers or raw names; a CSV reader sees empty text as NULL."""
    cells = []
    for header, column in TABS[tab_name].headers:
        value = f"nullif(\"{column}\", '')" if blank else f'"{column}"'
        cells.append(f'{value} AS "{header if named else column}"')
    return ", ".join(cells)


def _raw_sql(tab_name: str) -> str:
    audit = f"'{STAMP}' AS {LOADED_AT_COLUMN}, '{SOURCE_LABEL}' AS {SOURCE}"
    return f"SELECT {_cells(tab_name, named=False)}, {audit} FROM {TABS[tab_name].table}"


def src_scan_tab(w: Warehouse) -> DataFrame:
    return scan(w.spark, export_csv(w, "Expenses"))


def src_rename_headers(w: Warehouse) -> DataFrame:
    """Headers arrive padded with blanks."""
    tab = form_tab(w, "Inventory")
    return tabs.rename_headers(tab.toDF(*(f" {c}  " for c in tab.columns)), "Inventory")


def src_schema_drift(w: Warehouse) -> DataFrame:
    """A header nobody knows and one that is missing."""
    tab = form_tab(w, "Returns").drop("Business Unit").withColumn("Mood", F.lit("fine"))
    return tabs.align_columns(tabs.rename_headers(tab, "Returns"), "Returns")


def src_null_sentinels(w: Warehouse) -> DataFrame:
    """Words for nothing in three columns, kept where they only look like it."""
    raw = w.raw("products_raw")
    noise = F.when(F.col("Is_Active") == "TRUE", "None").when(F.col("Is_Active") == "No", "nan").otherwise("NaN")
    return tabs.null_sentinels(raw.withColumns({
        "Category": F.when(F.col("Category") == "Other", "").otherwise(F.col("Category")), "Is_Active": noise,
    }))


def src_audit_columns(w: Warehouse) -> DataFrame:
    return tabs.audit_columns(w.raw("sales_raw"), LOADED_AT)


def sink_full_replace(w: Warehouse) -> DataFrame:
    """Loaded twice: the second load replaces the first."""
    layers = w.scratch_layers("replace")
    for _ in range(2):
        load.load_tab(layers, "Expenses", form_tab(w, "Expenses"), LOADED_AT)
    return layers.raw("expenses_raw")


def _loaded(w: Warehouse, name: str, exports: dict[str, str]):
    layers = w.scratch_layers(name)

    def read(spark, path: str) -> DataFrame:
        return tabs.empty_tab(spark) if path == "empty" else scan(spark, path)

    return layers, load.load_all_tabs(layers, exports, LOADED_AT, scan=read, strict=False)


def src_empty_tab(w: Warehouse) -> DataFrame:
    """An empty tab still gives a table with all its columns."""
    exports = {t: "empty" if t == "Returns" else export_csv(w, t) for t in TABS}
    layers, _ = _loaded(w, "empty", exports)
    shapes = [
        layers.raw(tab.table).agg(
            F.lit(tab.table).alias("table_name"), F.lit(len(layers.raw(tab.table).columns)).alias("n_columns"),
            F.count("*").alias("n_records"),
        )
        for tab in TABS.values()
    ]
    return stack(shapes)


def src_load_all_tabs(w: Warehouse) -> DataFrame:
    """One tab is missing; the others load."""
    _, status = _loaded(w, "load", {t: export_csv(w, t) for t in TABS if t != "Inventory"})
    return status.select("tab", "status", "rows")


def src_load_drift(w: Warehouse) -> DataFrame:
    """The headers that did not line up in a load, next to the rows that were stored all the same."""
    layers = w.scratch_layers("drift")

    def read(spark, path: str) -> DataFrame:
        tab = form_tab(w, path)
        return tab.drop("Business Unit").withColumn(" Mood ", F.lit("fine")) if path in ("Returns", "Expenses") else tab

    status = load.load_all_tabs(layers, {t: t for t in TABS}, LOADED_AT, scan=read)
    return status.select("tab", "rows", F.inline("drift"))


def src_seed_csv(w: Warehouse) -> DataFrame:
    """The unit seed read from CSV, with the sales of each seeded unit."""
    path = w.scratch("seed_units")
    w._once("seed_units", lambda: w.derived("business_units").coalesce(1).write.mode("overwrite").csv(path, header=True))
    units = seeds.read_seed_csv(w.spark, path, "business_units")
    sold = w.staging("stg_sales").groupBy("unit").agg(F.count("*").alias("n_sales"))
    return units.join(sold.withColumnRenamed("unit", "unit_name"), "unit_name", "left")


def src_external_tab(w: Warehouse) -> DataFrame:
    layers = w.scratch_layers("external")
    external.create_external_tab(layers, "products_raw", export_csv(w, "Products"), TABS["Products"].columns)
    return layers.raw("products_raw")


def sink_materialize_layer(w: Warehouse) -> DataFrame:
    """A staging table written as a layer table and read back."""
    layers = w.scratch_layers("materialize")
    layers.replace(w.staging("stg_returns"), STAGING_DB, "stg_returns")
    return layers.staging("stg_returns")


def src_scan_layer_table(w: Warehouse) -> DataFrame:
    w.raw("products_raw")
    return w.layers.table(RAW_DB, "products_raw")


def layered_rebuild(w: Warehouse) -> DataFrame:
    """Seeds, staging, marts and checks in one run over a separate set of layers."""
    layers = w.scratch_layers("rebuild")
    for table in (tab.table for tab in TABS.values()):
        layers.replace(w.derived(table), RAW_DB, table)
    path = w.scratch("seed_units")
    w._once("seed_units", lambda: w.derived("business_units").coalesce(1).write.mode("overwrite").csv(path, header=True))
    return rebuild(layers, "full", CHECK_DAY, {"business_units": path})


_TABLES = [(name, tab.table, len(tab.headers) + 2) for name, tab in TABS.items()]

QUERIES: dict = {
    "src_scan_tab": (src_scan_tab, f"SELECT {_cells('Expenses')} FROM expenses_raw"),
    "src_rename_headers": (
        src_rename_headers, f"SELECT {_cells('Inventory', named=False, blank=False)} FROM inventory_purchases_raw",
    ),
    "src_schema_drift": (
        src_schema_drift,
        "SELECT " + ", ".join(
            f'"{c}"' if c != "Business_Unit" else "NULL::VARCHAR AS Business_Unit" for c in TABS["Returns"].columns
        ) + " FROM returns_raw",
    ),
    "src_null_sentinels": (
        src_null_sentinels,
        "SELECT * REPLACE (nullif(Category, 'Other') AS Category, "
        "CASE WHEN Is_Active NOT IN ('TRUE', 'No') THEN 'NaN' END AS Is_Active) FROM products_raw",
    ),
    "src_audit_columns": (
        src_audit_columns, f"SELECT *, '{STAMP}' AS {LOADED_AT_COLUMN}, '{SOURCE_LABEL}' AS {SOURCE} FROM sales_raw",
    ),
    "sink_full_replace": (sink_full_replace, _raw_sql("Expenses")),
    "src_empty_tab": (
        src_empty_tab,
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, {n} AS n_columns, "
            + ("0::BIGINT AS n_records" if t == "returns_raw" else f"(SELECT count(*) FROM {t}) AS n_records")
            for _, t, n in _TABLES
        ),
    ),
    "src_load_all_tabs": (
        src_load_all_tabs,
        " UNION ALL ".join(
            f"SELECT '{name}' AS tab, 'failed' AS status, NULL::BIGINT AS rows" if name == "Inventory"
            else f"SELECT '{name}' AS tab, 'loaded' AS status, (SELECT count(*) FROM {t}) AS rows"
            for name, t, _ in _TABLES
        ),
    ),
    "src_load_drift": (
        src_load_drift,
        " UNION ALL ".join(
            f"SELECT '{name}' AS tab, (SELECT count(*) FROM {TABS[name].table}) AS rows, '{kind}' AS kind, '{header}' AS header"
            for name in ("Returns", "Expenses") for kind, header in (("unknown", "Mood"), ("missing", "Business Unit"))
        ),
    ),
    "src_seed_csv": (
        src_seed_csv,
        "SELECT unit_name, sort_order, n_sales FROM business_units LEFT JOIN "
        "(SELECT unit AS unit_name, count(*) AS n_sales FROM stg_sales GROUP BY unit) USING (unit_name)",
    ),
    "src_external_tab": (src_external_tab, f"SELECT {_cells('Products', named=False)} FROM products_raw"),
    "sink_materialize_layer": (sink_materialize_layer, "SELECT * FROM stg_returns"),
    "src_scan_layer_table": (src_scan_layer_table, "SELECT * FROM products_raw"),
    "layered_rebuild": (layered_rebuild, RELATIONS["dq_suite_summary"][1]),
}

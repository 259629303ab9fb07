"""Reference data: the business units and product categories."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession

from tillworks.values import BUSINESS_UNITS, PRODUCT_CATEGORIES, RAW_DB

if TYPE_CHECKING:
    from tillworks.sources.layers import Layers

SCHEMAS = {
    "business_units": "unit_name string, sort_order int",
    "product_categories": "category_name string, category_description string, sort_order int",
}


def read_seed_csv(spark: SparkSession, path: str, seed: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[seed]).options(header=True, enforceSchema=False).csv(path)


def builtin_seed(spark: SparkSession, seed: str) -> DataFrame:
    """The seed rows this library ships."""
    if seed == "business_units":
        rows = [(name, i) for i, name in enumerate(BUSINESS_UNITS, 1)]
    else:
        rows = [(name, text, i) for i, (name, text) in enumerate(PRODUCT_CATEGORIES, 1)]
    return spark.createDataFrame(rows, SCHEMAS[seed])


def load_seeds(layers: Layers, paths: dict[str, str] | None = None) -> None:
    """Replace the seed tables, from CSV files where a path is given."""
    for seed in SCHEMAS:
        path = (paths or {}).get(seed)
        df = read_seed_csv(layers.spark, path, seed) if path else builtin_seed(layers.spark, seed)
        layers.replace(df.coalesce(1), RAW_DB, seed)

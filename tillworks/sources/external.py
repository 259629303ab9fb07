"""A raw table that is read live from the exported files on every query."""

from __future__ import annotations

from tillworks.sources.layers import Layers
from tillworks.values import RAW_DB


def create_external_tab(layers: Layers, table: str, path: str, columns: list[str]) -> None:
    """Drop and re-create a CSV table over ``path``: explicit text columns, header row skipped, nothing copied."""
    name = layers.name(RAW_DB, table)
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    layers.drop(RAW_DB, table)
    layers.spark.sql(
        f"CREATE TABLE {name} ({schema}) USING csv OPTIONS (header 'true', escape '\"', path '{path}')"
    )

"""Form tabs: scan an export, line its headers up with the raw table, mark blanks, stamp the load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.sources import records
from tillworks.values import LOADED_AT, NULL_SENTINELS, SOURCE, SOURCE_LABEL, TABS, Tab

DRIFT_SCHEMA = "tab string, kind string, header string"


def scan_tab(spark: SparkSession, path: str, fmt: str = "csv", multiline: bool | str | None = None) -> DataFrame:
    """All records of one exported tab as text; the first row of each CSV file is its header.

    CSV files are read in splits, also where cells hold line breaks (``records``), which a first pass over the quotes finds
    out. ``multiline`` spares that pass: ``False`` for one record on each line, ``True`` for line breaks in quoted cells.
    With ``"file"`` each file is read in one task, which unbalanced quotes need.
    """
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    if multiline is None or multiline is True:
        splits = records.Splits(spark, path)
        if multiline or splits.broken:
            return records.scan_records(spark, path, splits)
    # Without inferSchema every CSV column is a string. enforceSchema=False checks each file's own header, so a part
    # with its columns in another order fails instead of being read into the wrong columns.
    options = {"header": True, "multiLine": multiline == "file", "escape": '"', "enforceSchema": False}
    return spark.read.options(**options).csv(path)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _headers_found(df: DataFrame, tab: Tab) -> dict[str, str]:
    """Trimmed known header -> the column as it is spelled in the export."""
    known = {header for header, _ in tab.headers}
    found: dict[str, str] = {}
    for column in df.columns:
        header = column.strip()
        if header in found:
            raise ValueError(f"header {header!r} occurs twice")
        if header in known:
            found[header] = column
    return found


def rename_headers(df: DataFrame, tab_name: str) -> DataFrame:
    """Known headers under their raw column names; the others are dropped."""
    tab = TABS[tab_name]
    found = _headers_found(df, tab)
    return df.select(*(_quoted(found[h]).alias(c) for h, c in tab.headers if h in found))


def align_columns(df: DataFrame, tab_name: str) -> DataFrame:
    """The raw table's columns in order, all text; those the export lacks are NULL."""
    return df.select(
        *(
            (F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c)
            for c in TABS[tab_name].columns
        )
    )


def header_drift(df: DataFrame, tab_name: str) -> list[tuple[str, str, str]]:
    """``(tab, 'unknown' | 'missing', header)`` for each header that does not line up."""
    tab = TABS[tab_name]
    known = {header for header, _ in tab.headers}
    found = _headers_found(df, tab)
    unknown = [(tab_name, "unknown", c.strip()) for c in df.columns if c.strip() not in known]
    return unknown + [(tab_name, "missing", h) for h, _ in tab.headers if h not in found]


def drift_report(df: DataFrame, tab_name: str) -> DataFrame:
    return df.sparkSession.createDataFrame(header_drift(df, tab_name), DRIFT_SCHEMA)


def null_sentinels(df: DataFrame) -> DataFrame:
    """Empty text and the words a spreadsheet export writes for "nothing" become NULL; the match is exact."""
    return df.select(*(F.when(~F.col(c).isin(*NULL_SENTINELS), F.col(c)).alias(c) for c in df.columns))


def audit_columns(df: DataFrame, loaded_at: dt.datetime, source: str = SOURCE_LABEL) -> DataFrame:
    """One instant for the whole load, as UTC ISO text, and the name of the loader."""
    stamp = loaded_at.astimezone(dt.timezone.utc).isoformat()
    return df.withColumns({LOADED_AT: F.lit(stamp), SOURCE: F.lit(source)})


def prepare(df: DataFrame, tab_name: str, loaded_at: dt.datetime) -> DataFrame:
    """A scanned tab as its raw table: one narrow projection, however wide the drift."""
    return audit_columns(null_sentinels(align_columns(rename_headers(df, tab_name), tab_name)), loaded_at)


def raw_schema(tab_name: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (*TABS[tab_name].columns, LOADED_AT, SOURCE)])


def empty_tab(spark: SparkSession) -> DataFrame:
    """What an export without records and headers scans as."""
    return spark.createDataFrame([], T.StructType([]))

"""Load form tabs into the raw layer."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tillworks.sources.layers import Layers
from tillworks.sources.tabs import header_drift, prepare, scan_tab
from tillworks.values import RAW_DB, TABS

log = logging.getLogger(__name__)

STATUS_SCHEMA = "tab string, status string, rows bigint, error string, drift array<struct<kind: string, header: string>>"


class LoadError(RuntimeError):
    """Some tabs failed; the others were loaded. ``status`` holds one row per tab."""

    def __init__(self, failed: list[str], status: DataFrame) -> None:
        super().__init__(f"load finished with errors in: {failed}")
        self.failed, self.status = failed, status


def load_tab(layers: Layers, tab_name: str, scanned: DataFrame, loaded_at: dt.datetime) -> int:
    """Replace one raw table with a scanned tab; returns the rows now stored (read from the file footers)."""
    table = TABS[tab_name].table
    layers.replace(prepare(scanned, tab_name, loaded_at), RAW_DB, table)
    return layers.raw(table).count()


def load_all_tabs(
    layers: Layers,
    exports: Mapping[str, str],
    loaded_at: dt.datetime | None = None,
    scan: Callable[..., DataFrame] = scan_tab,
    strict: bool = True,
) -> DataFrame:
    """Load every tab from its export path; a tab that is missing or fails does not stop the others.

    Returns ``(tab, status, rows, error, drift)``, where drift lists the headers that are unknown or missing; with
    ``strict`` a failure raises once all tabs were tried.
    """
    loaded_at = loaded_at or dt.datetime.now(dt.timezone.utc)
    results: list[tuple] = []
    for tab_name in TABS:
        drift = None
        try:
            if tab_name not in exports:
                raise FileNotFoundError(f"no export for tab {tab_name!r}")
            scanned = scan(layers.spark, exports[tab_name])
            drift = [(kind, header) for _, kind, header in header_drift(scanned, tab_name)]
            for kind, header in drift:
                log.warning("%s: %s header %r", tab_name, kind, header)
            rows = load_tab(layers, tab_name, scanned, loaded_at)
            results.append((tab_name, "loaded", rows, None, drift))
        except Exception as error:  # one bad tab must not keep the rest from loading
            log.error("%s: %s", tab_name, error)
            results.append((tab_name, "failed", None, str(error), drift))
    status = layers.spark.createDataFrame(results, STATUS_SCHEMA)
    failed = [tab for tab, state, *_ in results if state == "failed"]
    if failed and strict:
        raise LoadError(failed, status)
    return status

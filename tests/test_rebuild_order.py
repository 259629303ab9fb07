"""The rebuild job starts each table when its own inputs are there."""

from __future__ import annotations

import threading
import time

import pytest

from tillworks.plans import marts, rebuild, staging


def test_tasks_run_when_their_inputs_are_done():
    events, lock, slow = [], threading.Lock(), threading.Event()

    def task(name, waits=None):
        def run():
            with lock:
                events.append(("start", name))
            if waits:
                assert waits.wait(20)
            with lock:
                events.append(("end", name))
            if name == "mart of fast":
                slow.set()

        return run

    tasks = {
        "slow": (task("slow", slow), ()), "fast": (task("fast"), ()), "mart of fast": (task("mart of fast"), ["fast"]),
        "mart of both": (task("mart of both"), ["slow", "fast"]),
    }
    rebuild.run_when_ready(tasks, 2)  # ends only if the mart of the fast table starts while the slow one still runs
    order = {e: k for k, e in enumerate(events)}
    assert order["end", "mart of fast"] < order["end", "slow"] < order["start", "mart of both"]
    assert len(events) == 8


def test_an_error_stops_what_has_not_begun():
    started = []

    def broken():
        time.sleep(0.2)
        raise RuntimeError("no input")

    tasks = {"a": (broken, ()), "b": (lambda: started.append("b"), ()), "c": (lambda: started.append("c"), ["a"])}
    with pytest.raises(RuntimeError, match="no input"):
        rebuild.run_when_ready(tasks)
    assert started == ["b"]
    with pytest.raises(ValueError, match="each other"):
        rebuild.run_when_ready({"a": (broken, ["b"]), "b": (broken, ["a"])})
    with pytest.raises(ValueError, match="unknown"):
        rebuild.run_when_ready({"a": (broken, ["x"])})


def test_marts_overlap_with_staging(monkeypatch):
    """With a staging table that takes long, the marts that do not read it are done before it."""
    seen, lock, others = [], threading.Lock(), threading.Event()
    independent = [m for m, (_, inputs, _) in marts.BUILDERS.items() if "stg_inventory_purchases" not in inputs]

    def note(name):
        with lock:
            seen.append(name)
            if set(independent) <= set(seen):
                others.set()

    def build_staging(layers, table):
        if table == "stg_inventory_purchases":
            assert others.wait(20)
        note(table)

    monkeypatch.setattr(rebuild, "build_staging", build_staging)
    monkeypatch.setattr(rebuild, "build_mart", lambda layers, mart, as_of: note(mart))
    monkeypatch.setattr(rebuild.quality, "suite_summary", lambda read, as_of: "checked")
    assert rebuild.rebuild(None) == "checked"
    assert sorted(seen) == sorted([*staging.BUILDERS, *marts.BUILDERS]) and len(independent) == 8
    assert seen.index("stg_inventory_purchases") > max(map(seen.index, independent))

"""The daily job: rebuild staging and marts from the raw layer, then run the data checks."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from functools import partial

from pyspark.sql import DataFrame

from tillworks.plans import marts, quality, staging
from tillworks.sources.layers import Layers
from tillworks.sources.seeds import load_seeds
from tillworks.values import MARTS_DB, STAGING_DB

BUILDS_AT_ONCE = 4
MODES = ("normal", "full", "test_only")


def build_staging(layers: Layers, table: str) -> None:
    builder, raw_table = staging.BUILDERS[table]
    layers.replace(builder(layers.raw(raw_table)), STAGING_DB, table)


def build_mart(layers: Layers, mart: str, as_of: dt.date | None = None) -> None:
    builder, inputs, takes_as_of = marts.BUILDERS[mart]
    frames = [layers.raw(t) if t == "business_units" else layers.staging(t) for t in inputs]
    df = builder(*frames, as_of=as_of) if takes_as_of else builder(*frames)
    layers.replace(df, MARTS_DB, mart, marts.PARTITION_BY.get(mart))


def checked_table(layers: Layers, table: str) -> DataFrame:
    return layers.table(STAGING_DB if table in staging.BUILDERS else MARTS_DB, table)


def run_when_ready(tasks: dict[str, tuple[Callable[[], None], Iterable[str]]], at_once: int = BUILDS_AT_ONCE) -> None:
    """Run each task once the tasks that it names are done, a few at a time: one's last stages leave cores to the next.

    Of the tasks that are ready, those come first on which most others wait. The first error stops the job; what runs then is
    let finish, nothing else is started.
    """
    unknown = {d for _, needs in tasks.values() for d in needs} - tasks.keys()
    if unknown:
        raise ValueError(f"unknown tasks {sorted(unknown)}")
    needs = {name: set(wanted) for name, (_, wanted) in tasks.items()}
    waiting_on = Counter(d for wanted in needs.values() for d in wanted)
    running: dict[Future, str] = {}
    with ThreadPoolExecutor(at_once) as pool:
        while needs or running:
            ready = sorted((n for n, left in needs.items() if not left), key=lambda n: -waiting_on[n])
            for name in ready[: at_once - len(running)]:
                running[pool.submit(tasks[name][0])] = name
                del needs[name]
            if not running:
                raise ValueError(f"tasks {sorted(needs)} wait for each other")
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                done.result()
                name = running.pop(done)
                for left in needs.values():
                    left.discard(name)


def rebuild(
    layers: Layers, mode: str = "normal", as_of: dt.date | None = None, seeds: dict[str, str] | None = None
) -> DataFrame:
    """``normal`` builds and checks, ``full`` loads the seeds first, ``test_only`` only checks.

    A mart is built as soon as the staging tables it reads are there. A table that cannot be built stops the job with its
    error; failed checks are only reported. Returns the checks'
    summary, lazily.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "full":
        load_seeds(layers, seeds)
    if mode != "test_only":
        tasks = {table: (partial(build_staging, layers, table), ()) for table in staging.BUILDERS}
        for mart, (_, inputs, _) in marts.BUILDERS.items():
            tasks[mart] = (partial(build_mart, layers, mart, as_of), [t for t in inputs if t in staging.BUILDERS])
        run_when_ready(tasks)
    return quality.suite_summary(lambda table: checked_table(layers, table), as_of)

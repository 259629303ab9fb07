"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
    BENCH_RUNS    runs per query, the median counts (default 3)
    BENCH_ALL     set to time every registered query

``build_*`` derive and store the raw, staging and mart layers, once and cold. ``monthly_profit_from_raw`` runs parsing and
the flagship mart as one plan over the stored raw text. All other marts read stored staging tables and dashboards stored
marts, as in daily operation.
Every result is computed whole (written to Spark's noop sink).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from testbed import derive, registry  # noqa: E402
from testbed.warehouse import Warehouse  # noqa: E402
from tillworks.plans import dashboards, marts, staging  # noqa: E402
from tillworks.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = [
    *staging.BUILDERS, *marts.BUILDERS, "dq_unique", "dq_not_null", "dq_accepted_values", "dq_relationships",
    "dq_sale_price_above_cost", "dq_suite_summary", *dashboards.QUERIES,
]


def timed(action: Callable[[], object], runs: int) -> float:
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def run_whole(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench", spark__master=f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    warehouse = Warehouse.open(spark, SF_DIR)
    times["build_raw"] = timed(lambda: [warehouse.raw(t) for t in derive.RAW], 1)
    builder, inputs, _ = marts.BUILDERS["monthly_profit"]

    def flagship() -> None:
        cleaned = [staging.BUILDERS[t][0](warehouse.raw(staging.BUILDERS[t][1])) for t in inputs]
        run_whole(builder(*cleaned))

    times["monthly_profit_from_raw"] = timed(flagship, RUNS)
    times["build_staging"] = timed(lambda: [warehouse.staging(t) for t in staging.BUILDERS], 1)
    times["build_marts"] = timed(lambda: [warehouse.mart(m) for m in marts.BUILDERS], 1)
    queries = registry.queries()
    for name in queries if os.environ.get("BENCH_ALL") else HEADLINE:
        times[name] = timed(lambda: run_whole(queries[name](spark, SF_DIR)), RUNS)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_wall_clock", "value": total, "unit": "sec", "queries": times, "sf": SF_DIR}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR  input tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local[N] cores (default 8)

Each query runs to completion into the ``noop`` sink (full execution, no
collection to the driver), once, after a JVM warm-up that runs the flagship on
the smallest driver tables (class loading and JIT, not cached results: every
timed query reads ``BENCH_SF_DIR`` from scratch in a fresh warehouse, except
that queries of one session share the stored gold mart, as a deployed
warehouse would).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

WARMUP_DIR = "/root/testdata/sf0.001"
HEADLINE = (
    "risk_gold", "risk_gold_params", "sell_through", "serve_enriched_day", "kpis",
    "flags_by_category", "top_stockouts", "daily_trend", "spoilage_by_category",
    "supplier_conform", "scd2_build", "dq_suite_inventory", "dq_suite_risk",
    "dq_relationships", "event_enrich", "stream_good", "fifo_aging",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from shelfrisk.session import get_session
    from shelfrisk.plans.catalog import QUERIES

    spark = get_session(f"local[{cpus}]", app_name="shelfrisk-bench",
                        shuffle_partitions=max(8, cpus * 2))
    # Warm-up: JIT and class loading on the smallest tables (nothing reused).
    warm_dir = WARMUP_DIR if os.path.isdir(WARMUP_DIR) else sf_dir
    for name in ("risk_gold", "event_validate"):
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {timings[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Bench: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; print one JSON line.

Each query is timed end to end (plan building, including the checkpoints numbering takes, and full
execution through the no-op sink, which runs every column of every row without a driver collect).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "product_codes",
    "supplier_master",
    "quotation_bids",
    "quotation_item_prices",
    "tender_bids",
    "purchase_order_lines",
    "stock_opening_balance",
    "stock_movements",
    "vehicle_cost_centers",
    "fuel_items",
    "asset_register_final",
    "asset_ledger",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from transfero.plans import JOBS, run
    from transfero.session import build_local_session

    log_dir = tempfile.mkdtemp(prefix="transfero-events-", dir="/tmp")
    spark = build_local_session(cpus, app="transfero-bench", shuffle_partitions=max(8, int(cpus) * 2),
                                event_log_dir=log_dir)
    # Warm the JVM (class loading, codegen, the numbering path) on a small job so it is not billed to the
    # first headline query.
    for warm in ("units_of_measure", "product_groups"):
        run(warm, spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in names:
        if name not in JOBS:
            continue
        t0 = time.perf_counter()
        run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS
(timed runs per query after one warm-up, default 3; the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from clickloom.plans.queries import all_queries
from clickloom.session import build_session

HEADLINES = (
    "overview", "event_mix", "daily_series", "dim_channel", "dim_customer_country",
    "dim_payment_method", "product_product", "multi_dimension", "heatmap_pivot",
    "hour_distribution", "base_event_counts", "snapshot_counts", "snapshot_kpis",
    "snapshot_by_product", "pareto_products", "combined_view", "windowed_counts",
    "contract_violations", "cart_replay", "session_conformance", "order_lines", "product_sales",
    "order_reconciliation", "product_catalog",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def seconds(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in HEADLINES:
        seconds(name)
        times[name] = round(statistics.median(seconds(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "cpus": int(cpus), "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

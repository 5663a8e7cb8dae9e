"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyhouse.catalog import all_queries  # noqa: E402
from tallyhouse.plans import sample_star  # noqa: E402
from tallyhouse.session import configure  # noqa: E402

HEADLINE = [
    "vw_campaign_performance",
    "vw_merchant_performance",
    "vw_customer_segment_revenue",
    "vw_segment_revenue_by_time",
    "vw_sales_by_time",
    "vw_product_performance",
    "vw_staff_performance",
    "perf_view_rollups",
    "perf_rollup_campaigns",
    "perf_rollup_segments",
    "perf_rollup_merchants",
    "load_fact_orders",
    "load_fact_line_items",
    "load_fact_campaign_txn",
    "late_campaign_rekey",
    "dq_report",
    "dq_conflicts",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyhouse-bench")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog = {q.name: q for q in all_queries()}
    seconds: dict[str, float] = {}

    started = time.time()
    dict(sample_star.star(spark, sf_dir))  # every table
    seconds["build_star"] = round(time.time() - started, 3)

    for name in HEADLINE:
        times = []
        for _ in range(RUNS):
            started = time.time()
            # the noop sink runs the whole plan and brings nothing to the driver
            catalog[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.time() - started)
        seconds[name] = round(statistics.median(times), 3)

    queries = {n: s for n, s in seconds.items() if n != "build_star"}
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds (warm)",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

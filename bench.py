"""Time the headline queries on local cores; prints one JSON line.

`order_lines` brings the source tables into the raw contract; `warehouse_load` validates the lines,
builds the star schema, checks it and publishes it. Both run once, in a cold session. The other
queries read the published warehouse, are collected in full and run twice: `queries` has the second
run, `first_run` the one that still compiles its code. `value` adds both loads and the second runs.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from orderloom import registry
from orderloom.sources.staging import release

HEADLINE = [
    "executive_overview",
    "annual_performance",
    "monthly_trend",
    "category_annual",
    "category_performance",
    "product_performance",
    "weak_margin_products",
    "region_annual",
    "region_performance",
    "channel_performance",
    "customer_value",
    "top_customer_concentration",
    "filtered_overview",
    "sql_executive_summary",
    "sql_products",
    "sql_customers",
    "integrity_clean",
    "val_source_clean",
    "customer_revenue_histogram",
    "insights",
    "reconcile_kpis",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("orderloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="orderloom-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 3)

    lake = registry.lake(spark, folder)
    timed("order_lines", lambda: lake.raw)
    timed("warehouse_load", lambda: lake.root)
    queries = registry.queries()
    first: dict[str, float] = {}
    for name in HEADLINE:
        timed(name, lambda: queries[name](spark, folder).collect())
        first[name] = times[name]
        timed(name, lambda: queries[name](spark, folder).collect())
    release(spark)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "first_run": first,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

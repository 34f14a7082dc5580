"""Time the headline queries and print one JSON line.

Each query is built and written to the noop sink; the best of four runs counts, and the total is
the headline value. The first run of each query is kept as well.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from tallyhouse.plans.lineage import clear_scratch  # noqa: E402
from workload.spark_queries import REGISTRY  # noqa: E402

HEADLINE = (
    "sales_lines", "category_performance", "daily_revenue", "forecast_trend", "kpi_region_country",
    "rank_disagreement", "monthly_trend", "top_products", "daily_business", "metrics_sales_by_category",
    "metrics_sales_flat", "seasonality_index", "compare_forecasts", "reconcile_daily", "key_checks",
    "table_profile", "upsert_orders", "decision_signals", "csv_orders", "ingested_orders",
    "rank_customers",
)
RUNS = 4


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyhouse-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    best, first = {}, {}
    for name in HEADLINE:
        seconds = []
        for _ in range(RUNS):
            start = time.perf_counter()
            REGISTRY[name](spark, directory).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
            clear_scratch(spark)
        best[name], first[name] = round(min(seconds), 3), round(seconds[0], 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(best.values()), 3), "unit": "sec",
        "queries": best, "first_run": first, "sf": Path(directory).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

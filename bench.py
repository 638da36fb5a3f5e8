"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the input folder, BENCH_CPUS the number of local cores and BENCH_RUNS how often each
query runs; the fastest run counts. Results go to Spark's no-op sink, so every row and column is computed.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harness.queries import QUERIES  # noqa: E402
from tallyloft.session import build_session  # noqa: E402

HEADLINE = [
    "silver_products", "silver_sales", "silver_sales_dedup", "dim_customer", "dim_date", "scd2_customer",
    "fact_sales", "fact_product_sales", "fx_asof_sales",
    "mart_revenue_quarter_category", "mart_aov_margin", "mart_top_brands", "mart_demographics",
    "mart_store_performance", "mart_rfm", "mart_product_mix",
    "stream_item_enrich", "stream_order_agg_update", "stream_order_agg_windowed", "stream_dlq",
    "hot_items_latest", "mart_total_revenue", "mart_top_products", "mart_cancel_alerts",
    "dq_unique", "dq_referential", "dq_run_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    # Query output must not mix with the one line on stdout.
    with contextlib.redirect_stdout(sys.stderr):
        for name in names:
            took = []
            for _ in range(runs):
                started = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                took.append(time.perf_counter() - started)
            seconds[name] = round(min(took), 3)
            print(f"{name}: {seconds[name]}", flush=True)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

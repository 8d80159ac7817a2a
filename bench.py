"""Bench: one JSON line with the median time per headline query.

``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the threads.
Results are written to Spark's ``noop`` sink, so every row is produced and
none travels to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from quaymart.plans import registry
from quaymart.session import build_session

# Grouped as the published figures are: indexed and partitioned filters, the
# five marts, the model chain, then windows, time series, quality and history.
HEADLINE = (
    "state_top_sellers", "late_in_month", "segment_top_spend", "partitioned_month_filter",
    "partitioned_quarter_filter",
    "customer_ltv", "order_metrics", "seller_performance", "product_analytics", "monthly_revenue",
    "mart_chain",
    "customer_lifetime", "category_popularity", "top_customers", "overdue_items",
    "running_revenue", "spend_percentile", "seller_quartiles", "customer_cohort",
    "top_category_quarterly", "review_improvement", "rolling_by_customer", "payment_ranks",
    "group_stats_rows", "monthly_trend", "weekly_activity", "monthly_gaps",
    "table_profile", "dq_suite", "dq_checks", "scd2_snapshot", "incremental_upsert",
    "box_stats", "spend_histogram", "delay_features",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    registry.load_all()
    spark = build_session("bench", cpus)
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            df = registry.QUERIES[name](spark, folder)
            df.write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline queries, sum of medians",
                      "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                      "cpus": cpus, "repeats": repeats}))


if __name__ == "__main__":
    main()

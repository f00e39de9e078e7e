"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma-separated names).
Each query runs to completion into the no-op sink, twice: "queries" holds the second run, "first_run" the first, which
also pays for compilation.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from keelson.plans import registry  # noqa: E402

HEADLINE = [
    # ingestion and profile
    "overview_events", "column_profile_orders", "numeric_summary_lineitem", "categorical_summary_orders", "histogram_price_by_flag",
    # cleaning and labels
    "label_construction", "cleaning_summary", "cleaning_counts", "event_time_fallback", "latest_order_per_customer",
    # feature versions
    "features_v1", "features_v2", "feature_missingness", "feature_manifest", "version_compare", "data_fingerprint", "alignment_diff",
    # retrieval and serving
    "flagship", "pit_join", "pit_join_ttl", "pit_multi_view", "pit_lineitem", "materialize_latest", "online_lookup",
    # split and training
    "entity_split", "apply_split_counts", "target_stats_by_split", "exact_sample_orders", "impute_median_mode", "one_hot_wide",
    "forest_metrics", "experiment_comparison", "regression_metrics", "leaderboard",
    # audit
    "grid_gaps_users_days", "quality_checks",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("keelson-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false").config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_custkey").count().write.format("noop").mode("overwrite").save()
    first, seconds = {}, {}
    for name in names:
        for target in (first, seconds):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            target[name] = round(time.perf_counter() - start, 4)
        print(f"{name} {first[name]} {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 4), "unit": "sec",
                      "queries": seconds, "first_run": first, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()

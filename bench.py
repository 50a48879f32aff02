"""Wall time of the headline queries; prints one JSON line.

Each headline query runs once to warm up and once timed, its whole result written to the no-op
sink; "value" is their sum.  Heavy queries follow, once each.  BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "audit_summary", "clean_rows", "history_decreases", "split_summary", "customer_overlap", "category_stats_category",
    "trend_week", "heatmap", "box_summary", "spearman", "metric_record", "slice_metrics", "model_comparison", "review_queue",
    "features_imputed_scaled", "lr_scores", "iforest_scores", "bootstrap_ci",
]


# Fits of many models: run once each, after the others, as long as BENCH_HEAVY_SECONDS are not used up.
HEAVY = ["tree_scores", "permutation_fixed_score", "gbt_scores", "rf_scores", "candidate_comparison", "sensitivity", "permutation_importance"]


def main() -> None:
    from txnrisk.plans.registry import QUERIES
    from txnrisk.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        {"spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        first = once(name)
        seconds[name] = round(min(once(name), first), 3)
        print(f"{name}: first {first:.2f}s, then {seconds[name]:.2f}s", file=sys.stderr, flush=True)
    headline = round(sum(seconds.values()), 3)
    left = 0 if sys.argv[1:] else float(os.environ.get("BENCH_HEAVY_SECONDS", "420"))
    for name in HEAVY if left else []:
        if left <= 0:
            print(f"{name}: left out, the time for heavy queries is used up", file=sys.stderr, flush=True)
            continue
        seconds[name] = round(once(name), 3)
        left -= seconds[name]
        print(f"{name}: {seconds[name]:.2f}s", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": headline, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries on one local session and print one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names, or "all" for every registered query (default: the headline set)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rillmark.plans import registry  # noqa: E402
from rillmark.session import local_session  # noqa: E402

HEADLINE = [
    "user_features_orders", "item_features_orders", "pair_features_orders", "negatives_orders", "split_sets",
    "training_set", "rolling_counts", "interaction_sequence", "popularity_percentile", "hourly_pair_features",
    "dedup_events", "rejected_events", "served_clicks", "group_ctr", "ab_chi2", "ndcg_at_k", "average_precision",
    "list_diversity", "popularity_dampened", "mmr_rerank", "drift_psi", "stage_latency", "counter_rate",
    "column_profile", "gram_matrix", "fold_in", "stream_hourly_pairs",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    registry.load_all()
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(registry.QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = local_session(cpus)
    registry.QUERIES["item_popularity"](spark, root).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in names:
        t0 = time.perf_counter()
        registry.QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

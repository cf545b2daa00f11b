"""Headline queries on one machine: one JSON line on standard output.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Each query runs once to
warm up and once timed, into a sink that keeps nothing; stages a query writes are part of its
time. BENCH_ONE_BY_ONE=1 also times the table built with one aggregate and join per feature.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.compare import session
from checks.one_by_one import wide_table
from checks.queries import queries
from patronlens.sources.adapters import inputs

HEADLINE = [
    "join_log_labels",
    "user_action_totals",
    "user_distinct_items",
    "user_active_days",
    "span_actions",
    "last_purchase_span",
    "fanout_ratio",
    "user_features",
    "month_features",
    "seller_features",
    "pair_features",
    "features_full",
    "features_weighted",
    "features_basic",
    "features_full_events",
    "split_train_test",
    "metric_multiclass",
    "threshold_curve",
    "area_under_curves",
    "threshold_curve_dense",
    "normalized_features",
    "cv_lr",
]


def timed(build, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"), "patronlens-bench")
    registered = queries()
    chosen = {name: registered[name] for name in HEADLINE}
    if os.environ.get("BENCH_ONE_BY_ONE") == "1":
        chosen["one_by_one"] = lambda spark, sf_dir: wide_table(*inputs(spark, sf_dir))
    seconds = {}
    for name, build in chosen.items():
        timed(build, spark, sf_dir)
        seconds[name] = round(timed(build, spark, sf_dir), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds[name] for name in HEADLINE), 3)
    scale = float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()

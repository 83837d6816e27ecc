"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The shared tables (packets -> typed -> full / new features) are materialized
first and timed as ``materialize``; every query then reads them, as a cluster
job would read the written feature table.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "full_features", "rule_violations", "event_timeline", "gap_hist", "describe_all", "mann_whitney",
    "feature_stats", "attack_difficulty", "corr_with_label", "binary_metrics", "roc_curve", "roc_auc",
    "confusion_multi", "degree_centrality", "balance_classes", "time_parts", "rolling10",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from streamguard.plans import catalog, context
    from streamguard.session import local_session
    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) if cpus.isdigit() else 8))
    times: dict[str, float] = {}
    t0 = time.time()
    context.typed(spark, sf_dir)
    context.full(spark, sf_dir)
    context.new(spark, sf_dir)
    times["materialize"] = round(time.time() - t0, 3)
    extra = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    for name in HEADLINE + extra:
        q = catalog.QUERIES[name]
        t = time.time()
        q.build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()

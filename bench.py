"""Benchmark: run the headline queries end to end and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is executed to completion with the no-op sink (nothing collected),
with memoised fits cleared first, so every time includes its whole lineage
from the Parquet scans.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "aov_cells", "expected_aov", "aov_holdout_cells", "holdout_error_by_tier",
    "churn_panel", "latest_order_features", "hazard_curve", "chained_projection",
    "auc_by_stage", "ranking_metrics", "pltv_scores", "pltv_decile_concentration", "pltv_scorecard",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from custval import registry
    from custval.session import build_session
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus), app="custval-bench")
    qs = registry.queries()
    qs["acquisition_cohort"](spark, sf_dir).write.format("noop").mode("overwrite").save()   # warm-up: start-up is no query's time
    times = {}
    for key in HEADLINE:
        registry.reset_caches()
        t0 = time.perf_counter()
        qs[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rstrip("/").split("sf")[-1]
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()

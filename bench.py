"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced to completion with the ``noop`` sink (every row is
computed, nothing is collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelcast.plans import catalog  # noqa: E402
from panelcast.session import local_session  # noqa: E402

HEADLINE = [
    "bars_daily",
    "features_dataframe",
    "features_sql",
    "training_frame",
    "fold_membership",
    "sequences",
    "logistic_scores",
    "threshold_sweep",
    "roc_auc",
    "fold_results",
    "final_metrics",
    "error_cases",
    "feature_consistency",
    "signal_export",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=max(cpus * 2, 8), app="panelcast-bench")
    # JVM / code-generation warm-up on the smallest data set, not timed (it
    # touches neither the measured files nor any cache).
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.exists(f"{warm}/lineitem.parquet"):
        catalog.REGISTRY["training_frame"][0](spark, warm).write.format("noop").mode("overwrite").save()
    else:
        spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    for name in names:
        fn = catalog.REGISTRY[name][0]
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

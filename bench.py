"""Headline benchmark: prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The headline queries run in pipeline order in one session, the way the
analysis runs: the cleaned lines, the RFM table and the feature tables are
built once (written to the checkpoint folder) by the first query that needs
them and reused by the later ones, so each query's time is its incremental
cost and ``value`` is the wall time of the whole pipeline. Every query is
executed with the ``noop`` sink (whole plan, no rows moved to the driver).
``BENCH_ML=1`` (default) includes both modelling steps (three and five Spark
ML models, evaluation, vote, cross-validation, scoring); ``BENCH_FRESH=1`` instead clears the
shared tables before every query (each query from the raw Parquet).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "profile",              # Q1-Q6 single pass over raw lines
    "rfm_table",            # A1-A7, T1-T7 (distributed ranks), L1-L2
    "segment_summary",      # R5 (flagship report)
    "half_trends",          # W1-W6 exact-midpoint trends, all customers
    "ts_features",          # F1-F19
    "ch_features",          # G1-G8
    "ts_feature_table",     # J2 + D1-D5: rfm ⟕ features
    "score_auc",            # V1 distributed AUC
    "roi_best_threshold",   # C2 threshold sweep
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = list(HEADLINE)
    if os.environ.get("BENCH_ML", "1") == "1":
        names += ["model_comparison_ts", "churn_predictions_ts",
                  # the integrated step: five models, vote, cross-validation
                  "model_comparison_ch", "churn_predictions_ch"]
    fresh = os.environ.get("BENCH_FRESH", "0") == "1"
    from churnscope.plans import steps
    from churnscope.plans.catalog import QUERIES
    from churnscope.session import get_spark
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", cpus)))
    # warm-up: JVM, class loading, Parquet footers (not timed)
    QUERIES["analysis_date"](spark, sf_dir).collect()
    times = {}
    steps._MEMO.clear()
    for name in names:
        if fresh:
            steps._MEMO.clear()
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "pipeline_total" if not fresh else "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()

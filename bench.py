"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full into Spark's ``noop`` sink (no driver collect)
and timed; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lacuna.plans import queries  # noqa: E402
from lacuna.session import get_session  # noqa: E402

HEADLINE = [
    "q01_missing_summary", "q03_mean_fill", "q04_median_fill", "q05_mode_fill", "q06b_group_mean_scores",
    "q07_group_median_fill", "q10_conditional_partial_mean", "q12_mcar", "q17_numeric_scores",
    "q20_compare_and_rank", "q27_ffill_per_user", "q29_ffill_global", "q30_linear_interpolation",
    "q33_knn_fill", "q34_enhanced_knn_fill", "q35_similarity_partial_mean", "q36_svd_fill",
    "q39_em_fill", "q41_mixture_fill", "q44_rubin",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    qs = queries()
    spark.range(1000).selectExpr("sum(id)").collect()  # untimed: start the JVM side and Python workers
    times = {}
    for name in names:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  table folder (default /root/testdata/sf0.1)
BENCH_CPUS    cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lexispark.session import local_session  # noqa: E402
from lexispark.workload import all_queries  # noqa: E402

HEADLINES = (
    "b8_length_summary",
    "c11_without_single_chars",
    "c12_stemmed_text",
    "d6_vocabulary",
    "d10_tfidf_test",
    "d11_feature_size_sweep",
    "d12_text_svd",
    "e2_stratified_folds_5",
    "f8_ovr_predictions",
    "f10_knn_predict",
    "f10b_knn_vectors",
    "f12_complement_nb_predict",
    "f13_random_forest_vectors",
    "f15_svd_logistic",
    "g4_cross_validate_complement_nb",
    "g7_g8_grid_search",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus)
    queries, seconds = all_queries(), {}
    # one untimed query starts the Python workers and compiles the common code
    queries["f12_complement_nb_predict"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in HEADLINES:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

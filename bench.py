"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed to completion with the ``noop`` sink (no collect), so
the time covers fitting (model-sized driver round trips) plus the full final
plan.  One warm-up query runs first so JVM/Python-worker start-up is not
charged to the first query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkclust.plans.queries import QUERIES  # noqa: E402
from sparkclust.session import local_session, ship_package  # noqa: E402

HEADLINE = [
    # lineitem: 600k x 4 at sf0.1 (linear operators)
    "column_stats",
    "standardize_columns",
    "covariance_narrow",
    "lineitem_svd",
    "lineitem_assign",
    "lineitem_kmeans",
    "lineitem_em",
    # embeddings: 2,000 x 64 at sf0.1 (model fits and pairwise metrics)
    "impute_mean",
    "svd_wide",
    "project_wide",
    "split_exact",
    "kmeanspp_init",
    "kmeans_3iter",
    "kmeans_predict",
    "pairwise_distance",
    "dunn_index",
    "silhouette",
    "em_2iter",
    "em_full",
    "evaluate_k",
    "prepare",
    # the reference study: 40 principal components, K-means and EM for k = 2, 3
    "kmeans_projected",
    "em_projected",
    "confusion",
    "classification_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="sparkclust-bench")
    # warm-up (JVM, Python workers, Arrow): start-up is not query time
    ship_package(spark)
    QUERIES["matrix_shape"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(64).repartition(int(cpus) if cpus.isdigit() else 8).mapInArrow(
        lambda it: (b for b in it), "id long"
    ).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

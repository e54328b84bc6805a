"""Print the physical plans of the key operators as Markdown (PLANS.md).

Usage: python tools/show_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from sparkclust.operators import decompose, evaluate, gaussian, kmeans, sampling, stats  # noqa: E402
from sparkclust.plans.inputs import load_E, load_L  # noqa: E402
from sparkclust.session import local_session  # noqa: E402


def plan(df) -> str:
    txt = df._jdf.queryExecution().executedPlan().toString()
    txt = re.sub(r"\[\[?-?[0-9.E,\-\[\] ]{200,}\]\]?", "[...literal...]", txt)  # long literals
    txt = re.sub(r"#\d+L?", "", txt)
    lines = [ln[:160] for ln in txt.splitlines()]
    return "\n".join(lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    e, li = load_E(spark, sf), load_L(spark, sf)
    st = stats.fit_column_stats(li, 4)
    z = stats.standardize(li, st)
    model = decompose.svd(e, 64)
    _, seeds = kmeans.first_k_seeds(e, 3)
    mixture = gaussian.em_init(e, 2, "first")
    parts = spark.createDataFrame([(0, [1, 2])], "k int, v array<bigint>")
    scored = evaluate._scored(kmeans.assign_nearest(e, seeds), ["cluster"], "features")
    cases = [
        ("standardize (narrow)", z, "One projection fused with the scan, no exchange; means and inverse stds are inlined constants."),
        ("assign_nearest (K=3, D=64)", kmeans.assign_nearest(e, seeds), "Narrow projection over one array-literal matrix."),
        ("project (40 of 64)", decompose.project(e, model, 40), "One Arrow batch per Python call, no exchange."),
        ("em_predict", gaussian.em_predict(e, mixture), "One Arrow batch per Python call, no exchange."),
        ("exact totals", parts.select("k", F.posexplode("v").alias("pos", "v")).groupBy("k", "pos").agg(F.sum("v").alias("v")),
         "What ends every pass of statistics, Lloyd and EM (the input stands for the rows of the tasks): sums of 64-bit integers that meet before the exchange."),
        ("weighted pick (K-means++ step)", sampling.weighted_pick(e, kmeans.min_dist_to("features", seeds[:1]), 42, 1),
         "One row per task reaches the exchange."),
        ("split_exact", sampling.split_exact(e, frac=0.235), "After the counting passes a narrow filter expression."),
        ("distinct rows of the pairwise metrics", evaluate._weighted(kmeans.assign_nearest(e, seeds), ["cluster"], "features"),
         "Copies of a row meet before the exchange."),
        ("Silhouette, owned blocks", evaluate._row_silhouettes(scored, 128), "N x B rows in, N rows out; no sums are exchanged."),
        ("confusion", evaluate.confusion(kmeans.assign_nearest(e, seeds)), "One row per task."),
    ]
    print("# Physical plans of the key operators\n")
    print(f"Printed by `python tools/show_plans.py` on {os.path.basename(sf)} (local[8], 8 shuffle partitions), long literals elided.\n")
    for name, df, note in cases:
        print(f"## {name}\n\n{note}\n\n```\n{plan(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()

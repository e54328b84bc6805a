"""The reference's whole flow from a raw CSV: read -> binarise -> prepare (40 PCs) -> K-means evaluation."""

import math

from conftest import SF01
from pyspark.sql import functions as F

from sparkclust.plans.workflows import evaluate_kmeans, prepare
from sparkclust.sources import matrix


def test_raw_csv_to_kmeans_evaluation(spark, tmp_path):
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet")
    raw = emb.select(
        F.concat(F.lit("X"), F.col("vec_id").cast("string"), F.lit(".V1")).alias("name"),
        *[F.col("embedding")[i].cast("double").alias(f"X{i + 1}") for i in range(64)],
        (F.col("label") + 1).alias("y"),  # classes 1..10, 1 = positive
    )
    path = str(tmp_path / "data.csv")
    raw.write.option("header", True).csv(path)
    df = matrix.binarize_label(matrix.read_matrix(spark, path, id_mode="hash"))
    assert df.where("id IS NULL").count() == 0
    p = prepare(df, k=40, frac=0.235, seed=42)
    assert p.select(F.size("features").alias("d")).distinct().collect()[0].d == 40
    out = evaluate_kmeans(p.drop("split"), ks=(2,), frac=0.235, seed=42).collect()
    by = {r.split: r for r in out}
    assert by["test"].correct + by["test"].incorrect == math.floor(0.235 * 500)
    assert by["train"].dunn is None or by["train"].dunn >= 0

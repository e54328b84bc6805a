"""Composite flows of the reference programs, built from the operators.

* :func:`prepare` — impute -> z-normalise -> SVD -> project to K components ->
  exact train/test split (the data-preparation program).
* :func:`evaluate_kmeans` / :func:`evaluate_em` — fit on the train rows for
  each K, assign train and test rows, and report confusion metrics with the
  Dunn index (K-means) or Silhouette (EM) of the set being scored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import decompose, evaluate, gaussian, kmeans, sampling, stats
from ..operators.moments import iterative_input


def imputed_stats(obs: stats.ColumnStats) -> stats.ColumnStats:
    """Stats of the mean-imputed matrix, derived from the NaN-aware pass (no second scan).

    Imputed cells equal the column mean, so the mean is unchanged and the
    population variance becomes ``var_observed * count / N``.
    """
    n = obs.n
    std = [s * math.sqrt(c / n) if n and c else 0.0 for s, c in zip(obs.std, obs.count)]
    return stats.ColumnStats(n=n, count=[n] * obs.dim, mean=list(obs.mean), std=std)


def prepare(df: DataFrame, k: int, frac: float | None = None, n_test: int | None = None, seed: int = 42,
            col: str = "features") -> DataFrame:
    """``id, features (K principal-component scores), label, split``."""
    dim = stats.feature_dim(df, col)
    obs = stats.fit_column_stats(df, dim, col)
    imp = stats.impute_mean(df, obs.mean, col)
    z = stats.standardize(imp, imputed_stats(obs), col)
    model = decompose.svd(z, dim, col)
    proj = decompose.project(z, model, k, col)
    return sampling.split_exact(proj, n_test=n_test, frac=frac, seed=seed)


METRIC_COLS = ["accuracy", "tpr", "ppv", "tnr", "f1"]
COUNT_COLS = ["correct", "incorrect", "tp", "tn", "fp", "fn"]


SPLITS = ("train", "test")


def _split(df: DataFrame, frac: float, seed: int) -> DataFrame:
    """The given split, or an exact one; spread over the task slots and persisted."""
    return iterative_input(df if "split" in df.columns else sampling.split_exact(df, frac=frac, seed=seed))


def _metric_rows(spark, counts: list[tuple], extra: list[str]) -> DataFrame:
    """(k, split, counts, metrics, extra) from rows (k, split, counts, extra values)."""
    rows = [(k, name, *[c[x] for x in COUNT_COLS], *more) for k, name, c, more in counts]
    schema = ", ".join(["k int", "split string"] + [f"{c} bigint" for c in COUNT_COLS] + [f"{c} double" for c in extra])
    df = evaluate.metrics_from_confusion(spark.createDataFrame(rows, schema))
    return df.select("k", "split", *COUNT_COLS, *[(F.round(F.col(c), 6) + F.lit(0.0)).alias(c) for c in METRIC_COLS + extra])


def evaluate_kmeans(df: DataFrame, ks=(2, 3), frac: float = 0.235, seed: int = 42, init: str = "first") -> DataFrame:
    """Per (k, split): confusion counts, metrics, min inter / max intra distance, Dunn.

    All models are fitted side by side to their stop rule, and all (k, split) are
    scored with one pass of counts and one distance pass per set, so the number
    of jobs per pass does not depend on the number of models.  Each set is scored
    with its own distances.  A ``split`` column is taken as it is.
    """
    s = _split(df, frac, seed)
    try:
        models = kmeans.kmeans_fit_many(s.where("split = 'train'"), list(ks), init=init, seed=seed, persist=False)
        names = [f"_k{k}" for k in ks]
        scored = s
        for name, model in zip(names, models):
            scored = model.transform(scored, out=name)
        counts = evaluate.confusions(scored, names, "split")
        rows = []
        for part in SPLITS:
            for k, name, d in zip(ks, names, evaluate.dunn_many(scored.where(F.col("split") == part), names)):
                rows.append((k, part, counts.get((name, part), dict.fromkeys(COUNT_COLS, 0)), [d["min_inter"], d["max_intra"], d["dunn"]]))
    finally:
        s.unpersist()
    return _metric_rows(df.sparkSession, rows, ["min_inter", "max_intra", "dunn"])


def evaluate_em(df: DataFrame, ks=(2, 3), frac: float = 0.235, seed: int = 42, resp: str = "softmax",
                max_iter: int | None = None, init: str = "k-means++") -> DataFrame:
    """Per (k, split): confusion counts, metrics, the Euclidean Silhouette, iterations and status; see :func:`evaluate_kmeans`.

    ``failed``: a single predicted cluster, so that the Silhouette is undefined.
    """
    s = _split(df, frac, seed)
    try:
        models = gaussian.em_fit_many(s.where("split = 'train'"), list(ks), init, seed, resp=resp, max_iter=max_iter, persist=False)
        names = [f"_k{k}" for k in ks]
        scored = s
        for name, model in zip(names, models):
            scored = gaussian.em_predict(scored, model, out=name)
        counts = evaluate.confusions(scored, names, "split")
        rows = []
        for part in SPLITS:
            found = evaluate.silhouette_many(scored.where(F.col("split") == part), names)
            for k, name, model, d in zip(ks, names, models, found):
                rows.append((k, part, counts.get((name, part), dict.fromkeys(COUNT_COLS, 0)), [d["silhouette"], float(model.iterations)]))
    finally:
        s.unpersist()
    out = _metric_rows(df.sparkSession, rows, ["silhouette", "iterations"])
    return out.withColumn("status", F.when(F.col("silhouette").isNull(), F.lit("failed")).otherwise(F.lit("ok")))

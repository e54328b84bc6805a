"""Registered queries: one per operator of the SURVEY inventory.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the DuckDB oracle in :mod:`sparkclust.plans.oracles`.  All read
the whole generated tables.  Fitting steps collect only model-sized results
(K x D or D x D numbers); everything else stays a lazy Spark plan.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vector import dists_to
from ..operators import decompose, evaluate, gaussian, kmeans, sampling, stats
from ..operators.moments import iterative_input
from ..session import checkpoint_dir
from ..sources import matrix
from .inputs import (
    LINEITEM_COLS,
    LINEITEM_SEEDS,
    SEED,
    TEST_FRAC,
    load_E,
    load_E_nan,
    load_L,
    lineitem_row_id,
    load_LB,
    rnd,
    sig6,
    sig9,
    table,
)
from .workflows import evaluate_em, evaluate_kmeans, prepare

Query = Callable[[SparkSession, str], DataFrame]
E_DIM = 64


# --- sources / projections ---------------------------------------------------


def q_matrix_shape(spark, d):
    return matrix.shape(load_E(spark, d))


def q_binarize_label(spark, d):
    raw = table(spark, d, "embeddings").select(F.col("vec_id"), F.col("label").alias("label_raw"), F.col("label"))
    return matrix.binarize_label(raw)


def q_with_row_id(spark, d):
    e = table(spark, d, "embeddings").select("vec_id")
    return sampling.with_row_id(e, "vec_id")


def q_explode_columns(spark, d):
    return matrix.explode_columns(load_E(spark, d), E_DIM)


def q_matrix_text(spark, d):
    """The text rows of the CSV writer (K1, K4)."""
    return matrix.matrix_text(load_E(spark, d), E_DIM)


def q_split_text(spark, d):
    """The text rows of the train and test matrices (K5)."""
    return matrix.matrix_text(sampling.split_exact(load_E(spark, d), frac=TEST_FRAC, seed=SEED), E_DIM)


def q_matrix_parse(spark, d):
    """The reader's parsing of text columns with junk cells (S1-S3)."""
    text = matrix.matrix_text(load_E(spark, d), E_DIM)
    junk = [F.when((F.col("id").cast("bigint") + i) % 7 == 0, "abc").otherwise(F.col(str(i))).alias(str(i)) for i in range(E_DIM)]
    m = matrix.parse_matrix(text.select("id", *junk, "label"))
    return m.select(F.col("id").alias("vec_id"), F.posexplode("features").alias("pos", "v"), "label").withColumn(
        "pos", F.col("pos").cast("bigint")
    )


def q_plot_frame(spark, d):
    e = load_E(spark, d)
    _, seeds = kmeans.first_k_seeds(e, 3)
    return matrix.plot_frame(kmeans.assign_nearest(e, seeds)).withColumnRenamed("id", "vec_id")


def q_matrix_round_trip(spark, d):
    """The matrix written as CSV with its header into the shared folder and read back (K1, U1, S1, W1)."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/matrix-{uuid.uuid4().hex}"
    matrix.write_matrix(load_E(spark, d), path, E_DIM)
    back = matrix.read_matrix(spark, path)
    return back.select(F.col("id").alias("vec_id"), F.posexplode("features").alias("pos", "v"), "label").withColumn("pos", F.col("pos").cast("bigint"))


def q_number_text_ids(spark, d):
    """Names as ids, numbered by the reader (S1, S3)."""
    e = table(spark, d, "embeddings")
    named = e.select(
        F.concat(F.lit("X"), F.col("vec_id") % 97, F.lit(".V1.")).alias("name"), F.col("embedding")[0].cast("double").cast("string").alias("x"),
        F.col("label").cast("string").alias("y"),
    )
    m = matrix.parse_matrix(named)
    return m.groupBy(F.col("id").alias("name_id")).agg(F.count(F.lit(1)).alias("n"), rnd(F.avg(F.col("features")[0])).alias("mean0"))


def q_vector_text(spark, d):
    """The lines of the singular values and of the % variance (K2, K3)."""
    _, _, m = _svd_of(load_E(spark, d), E_DIM)
    ev = decompose.explained_variance(m.frame(spark))
    out = None
    for name in ("singular_value", "pct_variance"):
        t = matrix.vector_text(ev, name).select(F.lit(name).alias("name"), F.col("k").cast("bigint").alias("k"), "line")
        out = t if out is None else out.unionByName(t)
    return out


def q_clusters_text(spark, d):
    """The clustered rows as written, cluster first, no id (K6)."""
    e, seeds = _first3(spark, d)
    return matrix.clusters_frame(kmeans.assign_nearest(e, seeds), E_DIM)


def q_em_clusters_text(spark, d):
    """The rows with their mixture component as written, id kept (K7)."""
    e = load_E(spark, d)
    return matrix.clusters_frame(gaussian.em_predict(e, gaussian.em_fit(e, 2, "k-means++", SEED)), E_DIM, keep_id=True)


def q_row_id_repeated(spark, d):
    """Numbering by a text key with few values (P5): the range of numbers that every key gets."""
    li = table(spark, d, "lineitem").select("l_returnflag", "l_linenumber")
    return sampling.with_row_id(li, "l_returnflag").groupBy("l_returnflag").agg(
        F.min("row_id").alias("first_id"), F.max("row_id").alias("last_id"), F.count_distinct("row_id").alias("n")
    )


def q_split_repeated_ids(spark, d):
    """An exact split although ids repeat (T1): two ids in all."""
    lb = load_LB(spark, d).withColumn("id", F.col("label"))
    return sampling.split_exact(lb, frac=TEST_FRAC, seed=SEED).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


# --- statistics ----------------------------------------------------------------


def q_column_means_nan(spark, d):
    s = stats.column_stats(load_E_nan(spark, d), E_DIM)
    return s.select("pos", rnd(F.col("mean")).alias("mean"), "n")


def q_impute_mean(spark, d):
    e = load_E_nan(spark, d)
    means = stats.column_means(e, E_DIM)
    imp = stats.impute_mean(e, means, count_col="n_imputed")
    return imp.select(
        F.col("id").alias("vec_id"), "n_imputed", F.posexplode("features").alias("pos", "value")
    ).select("vec_id", F.col("pos").cast("bigint").alias("pos"), rnd(F.col("value")).alias("value"), F.col("n_imputed").cast("bigint").alias("n_imputed"))


def q_column_stats(spark, d):
    s = stats.column_stats(load_L(spark, d), len(LINEITEM_COLS))
    names = F.element_at(F.lit(LINEITEM_COLS), F.col("pos").cast("int") + 1)
    return s.select(names.alias("column"), sig9(F.col("mean")).alias("mean"), sig9(F.col("std")).alias("std"), "n")


def _long_z(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, F.posexplode("features").alias("pos", "z"))


def q_standardize_columns(spark, d):
    li = load_L(spark, d, keep=("l_linenumber",))
    z, _ = stats.fit_standardize(li, len(LINEITEM_COLS))
    long = _long_z(z, ["l_linenumber"])
    names = F.element_at(F.lit(LINEITEM_COLS), F.col("pos") + 1)
    return long.groupBy("l_linenumber", names.alias("column")).agg(
        rnd(F.avg("z")).alias("avg_z"), rnd(F.min("z")).alias("min_z"), rnd(F.max("z")).alias("max_z")
    ).withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))


def q_standardize_array(spark, d):
    z, _ = stats.fit_standardize(load_E(spark, d), E_DIM)
    return _long_z(z, ["id"]).select(F.col("id").alias("vec_id"), F.col("pos").cast("bigint").alias("pos"), rnd(F.col("z")).alias("z"))


def q_covariance_narrow(spark, d):
    c = stats.covariance(load_L(spark, d), LINEITEM_COLS)
    return c.select("col_i", "col_j", sig9(F.col("cov")).alias("cov"))


def q_covariance_wide(spark, d):
    e = matrix.to_matrix(table(spark, d, "embeddings"))
    cov = stats.covariance_matrix(e, E_DIM)
    c = stats.covariance_frame(spark, cov, [str(i) for i in range(E_DIM)])
    return c.select(F.col("col_i").cast("bigint").alias("i"), F.col("col_j").cast("bigint").alias("j"), sig9(F.col("cov")).alias("cov"))


# --- decomposition ----------------------------------------------------------------


def _svd_of(df: DataFrame, dim: int):
    z, st = stats.fit_standardize(df, dim)
    return z, st, decompose.svd(z, dim)


def q_svd_trace(spark, d):
    _, st, m = _svd_of(load_E(spark, d), E_DIM)
    s2 = sum(s * s for s in m.singular_values)
    row = [(m.n, E_DIM - len(st.constant), float(s2))]
    return spark.createDataFrame(row, "n bigint, d bigint, sum_s2 double").select("n", "d", rnd(F.col("sum_s2"), 4).alias("sum_s2"))


def q_singular_values(spark, d):
    _, _, m = _svd_of(load_E(spark, d), E_DIM)
    return m.frame(spark).select(F.col("k").cast("bigint"), rnd(F.col("singular_value")).alias("singular_value"))


def q_explained_variance(spark, d):
    _, _, m = _svd_of(load_E(spark, d), E_DIM)
    ev = decompose.explained_variance(m.frame(spark))
    return ev.select(F.col("k").cast("bigint"), *[rnd(F.col(c)).alias(c) for c in ("singular_value", "pct_variance", "cum_pct")])


def q_project_k(spark, d):
    z, _, m = _svd_of(load_E(spark, d), E_DIM)
    p = decompose.project(z, m, 1, out="pc")
    return p.select(F.col("id").alias("vec_id"), rnd(F.abs(F.col("pc")[0])).alias("pc1_abs"))


def q_svd_wide(spark, d):
    _, _, m = _svd_of(load_E(spark, d), E_DIM)
    ev = decompose.explained_variance(m.frame(spark))
    return ev.select(F.col("k").cast("bigint"), *[rnd(F.col(c)).alias(c) for c in ("singular_value", "pct_variance", "cum_pct")])


def q_project_wide(spark, d):
    z, _, m = _svd_of(load_E(spark, d), E_DIM)
    p = decompose.project(z, m, 40, out="pc")
    norm = F.sqrt(F.aggregate(F.col("pc"), F.lit(0.0), lambda a, x: a + x * x))
    return p.select(F.col("id").alias("vec_id"), rnd(norm).alias("pc_norm"), rnd(F.abs(F.col("pc")[0])).alias("pc1_abs"))


# --- sampling ----------------------------------------------------------------------


def q_split_exact(spark, d):
    s = sampling.split_exact(load_E(spark, d), frac=TEST_FRAC, seed=SEED)
    return s.select(F.col("id").alias("vec_id"), "split")


def q_uniform_pick(spark, d):
    return sampling.uniform_pick(load_E(spark, d), SEED, 0).select(F.col("id").alias("vec_id"), "u")


def q_weighted_pick(spark, d):
    e = load_E(spark, d)
    _, seeds = kmeans.first_k_seeds(e, 2)
    dmin = kmeans.min_dist_to("features", seeds)
    out = None
    for power in (1, 2):
        w = dmin if power == 1 else dmin * dmin
        p = sampling.weighted_pick(e, w, SEED, 1).where(F.col("race_key").isNotNull()).select(
            F.lit(power).cast("bigint").alias("power"), F.col("id").alias("vec_id")
        )
        out = p if out is None else out.unionByName(p)
    return out


def q_kmeanspp_init(spark, d):
    ids, _ = kmeans.kmeanspp_init(load_E(spark, d), 3, SEED, 1.0)
    return spark.createDataFrame([(i, int(v)) for i, v in enumerate(ids)], "cluster int, vec_id bigint")


def q_kmeanspp_many(spark, d):
    """Twelve seeds: the running minimum distance is carried from step to step (M1, U2)."""
    ids, _ = kmeans.kmeanspp_init(load_E(spark, d), 12, SEED, 1.0)
    return spark.createDataFrame([(i, int(v)) for i, v in enumerate(ids)], "cluster int, vec_id bigint")


# --- distances and K-means -----------------------------------------------------------


def _first3(spark, d):
    e = load_E(spark, d)
    _, seeds = kmeans.first_k_seeds(e, 3)
    return e, seeds


def q_pairwise_distance(spark, d):
    p = evaluate.pairwise_summary(load_E(spark, d))
    return p.select(
        F.col("id").alias("vec_id"), "nearest_id", *[rnd(F.col(c)).alias(c) for c in ("nearest_dist", "farthest_dist", "mean_dist")]
    )


def q_assign_nearest(spark, d):
    e, seeds = _first3(spark, d)
    return kmeans.assign_nearest(e, seeds).select(F.col("id").alias("vec_id"), "cluster")


def q_cluster_means(spark, d):
    e, seeds = _first3(spark, d)
    cm = kmeans.cluster_means_frame(kmeans.assign_nearest(e, seeds), E_DIM)
    return cm.select("cluster", "n", F.posexplode("mean").alias("pos", "mean")).select(
        "cluster", "n", F.col("pos").cast("bigint").alias("pos"), rnd(F.col("mean")).alias("mean")
    )


def _params_rows(df: DataFrame, *keep: str) -> DataFrame:
    """One row per cell of the covariances: cluster, i, j, weight, mean of i, cov."""
    rows = df.select("cluster", *keep, "weight", "mean", F.posexplode("cov").alias("i", "row"))
    cells = rows.select("cluster", *keep, "weight", F.element_at("mean", F.col("i") + 1).alias("mean"), "i", F.posexplode("row").alias("j", "cov"))
    return cells.select(
        "cluster", *keep, F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"),
        *[rnd(F.col(c)).alias(c) for c in ("weight", "mean", "cov")],
    )


def q_cluster_stats(spark, d):
    e = load_E(spark, d)
    _, seeds = kmeans.first_k_seeds(e, 2)
    return _params_rows(gaussian.cluster_stats(kmeans.assign_nearest(e, seeds), E_DIM), "n")


def q_centroid_shift(spark, d):
    e, seeds = _first3(spark, d)
    new, _ = kmeans.lloyd_update(e, seeds, E_DIM)
    shifts = [kmeans.total_shift([a], [b]) for a, b in zip(seeds, new)]
    tot = kmeans.total_shift(seeds, new)
    rows = [(i, float(s), float(tot)) for i, s in enumerate(shifts)]
    return spark.createDataFrame(rows, "cluster int, shift double, total_shift double").select(
        "cluster", rnd(F.col("shift")).alias("shift"), rnd(F.col("total_shift")).alias("total_shift")
    )


def q_kmeans_3iter(spark, d):
    e, seeds = _first3(spark, d)
    cents = kmeans.kmeans_steps(e, seeds, 3)
    return kmeans.assign_nearest(e, cents).select(F.col("id").alias("vec_id"), "cluster")


def q_kmeans_predict(spark, d):
    s = sampling.split_exact(load_E(spark, d), frac=TEST_FRAC, seed=SEED)
    train = s.where(F.col("split") == "train")
    test = s.where(F.col("split") == "test")
    model = kmeans.kmeans_fit(train, 3, "first")
    return kmeans.kmeans_predict(test, model).select(F.col("id").alias("vec_id"), "cluster")


def q_lineitem_assign(spark, d):
    z, _ = stats.fit_standardize(load_L(spark, d), len(LINEITEM_COLS))
    a = kmeans.assign_nearest(z, LINEITEM_SEEDS)
    dist = F.element_at(dists_to("features", LINEITEM_SEEDS), F.col("cluster") + 1)
    return a.groupBy("cluster").agg(F.count(F.lit(1)).cast("bigint").alias("n"), rnd(F.avg(dist)).alias("mean_dist"))


def _dunn(spark, d):
    e, seeds = _first3(spark, d)
    return evaluate.dunn_parts(kmeans.assign_nearest(e, seeds))


def q_min_intercluster(spark, d):
    return _dunn(spark, d).select(rnd(F.col("min_inter")).alias("min_inter"))


def q_max_intracluster(spark, d):
    return _dunn(spark, d).select(rnd(F.col("max_intra")).alias("max_intra"))


def q_dunn_index(spark, d):
    return _dunn(spark, d).select(*[rnd(F.col(c)).alias(c) for c in ("min_inter", "max_intra", "dunn")])


def q_silhouette(spark, d):
    e, seeds = _first3(spark, d)
    s = evaluate.silhouette(kmeans.assign_nearest(e, seeds))
    return s.select(rnd(F.col("silhouette")).alias("silhouette"), "n_clusters")


# --- classification metrics -----------------------------------------------------------


def q_confusion(spark, d):
    return evaluate.confusion(load_LB(spark, d))


METRIC_COLS = ["accuracy", "tpr", "ppv", "tnr", "f1"]


def q_classification_metrics(spark, d):
    lb = load_LB(spark, d)
    cases = {
        "toxic": lb,
        "all_one": lb.withColumn("cluster", F.lit(1)),
        "inverted": lb.withColumn("cluster", F.lit(1) - F.col("label")),
    }
    out = None
    for name, df in cases.items():
        m = evaluate.classification_metrics(df).select(
            F.lit(name).alias("case"), "correct", "incorrect", "tp", "tn", "fp", "fn", *[rnd(F.col(c)).alias(c) for c in METRIC_COLS]
        )
        out = m if out is None else out.unionByName(m)
    return out


def q_metrics_report(spark, d):
    return evaluate.metrics_report(evaluate.classification_metrics(load_LB(spark, d))).select(
        F.col("pos").cast("bigint").alias("pos"), "metric", "value"
    )


# --- Gaussian mixture ----------------------------------------------------------------


def _gmm_cols(model: gaussian.GaussianMixtureModel, spark) -> DataFrame:
    rows = [(i, float(w), m, c) for i, (w, m, c) in enumerate(zip(model.weights, model.means, model.covs))]
    return _params_rows(spark.createDataFrame(rows, "cluster int, weight double, mean array<double>, cov array<array<double>>"))


def _em_init2(spark, d):
    e = load_E(spark, d)
    return e, gaussian.em_init(e, 2, "k-means++", SEED, 1.0)


def q_em_init(spark, d):
    _, m = _em_init2(spark, d)
    return _gmm_cols(m, spark)


def q_em_init_second_moment(spark, d):
    """Initial covariances as uncentred second moments over all rows (A12)."""
    return _gmm_cols(gaussian.em_init(load_E(spark, d), 2, "k-means++", SEED, 1.0, init_cov="second_moment"), spark)


def q_gaussian_logpdf(spark, d):
    e, m = _em_init2(spark, d)
    l = gaussian.gaussian_logpdf(e, m)
    return l.select(F.col("id").alias("vec_id"), rnd(F.col("log_joint")[0]).alias("l0"), rnd(F.col("log_joint")[1]).alias("l1"))


def q_logsumexp(spark, d):
    e, m = _em_init2(spark, d)
    return gaussian.row_logsumexp(e, m).select(F.col("id").alias("vec_id"), rnd(F.col("lse")).alias("lse"))


def _estep(spark, d, mode):
    e, m = _em_init2(spark, d)
    r = gaussian.em_estep(e, m, mode)
    return r.select(F.col("id").alias("vec_id"), rnd(F.col("resp")[0]).alias("r0"), rnd(F.col("resp")[1]).alias("r1"))


def q_em_estep_softmax(spark, d):
    return _estep(spark, d, "softmax")


def q_em_estep_sequential(spark, d):
    return _estep(spark, d, "sequential")


def q_em_mstep(spark, d):
    e, m = _em_init2(spark, d)
    new, _, _ = gaussian.em_mstep(e, m)
    return _gmm_cols(new, spark)


def q_log_likelihood(spark, d):
    e, m = _em_init2(spark, d)
    # the same fused pass also yields the log-likelihood of the starting parameters
    _, ll, n = gaussian.em_mstep(e, m)
    return spark.createDataFrame([(float(ll), int(n))], "ll double, n bigint").select(sig9(F.col("ll")).alias("ll"), "n")


def q_log_likelihood_rows(spark, d):
    e, m = _em_init2(spark, d)
    return gaussian.row_logsumexp(e, m).agg(F.sum("lse").alias("ll"), F.count(F.lit(1)).cast("bigint").alias("n")).select(sig9(F.col("ll")).alias("ll"), "n")


def q_em_2iter(spark, d):
    e, m = _em_init2(spark, d)
    return _gmm_cols(gaussian.em_steps(e, m, 2), spark)


def q_em_predict(spark, d):
    """The mixture fitted on the train rows to its stop rule assigns the test rows (M7, M8)."""
    s = iterative_input(sampling.split_exact(load_E(spark, d), frac=TEST_FRAC, seed=SEED))
    m = gaussian.em_fit(s.where("split = 'train'"), 2, "k-means++", SEED, persist=False)
    s.unpersist()
    return gaussian.em_predict(s.where("split = 'test'"), m).select(F.col("id").alias("vec_id"), "cluster")


def q_em_full(spark, d):
    e = load_E(spark, d)
    m = gaussian.em_fit(e, 2, "k-means++", SEED)
    return gaussian.em_predict(e, m).select(F.col("id").alias("vec_id"), "cluster")


def q_kmeans_fit(spark, d):
    """Full Lloyd fit with the stop rule; the per-iteration shift history (M2, M9)."""
    m = kmeans.kmeans_fit(load_E(spark, d), 3, "k-means++", SEED)
    return m.history_frame(spark).select(F.col("iteration").cast("bigint"), rnd(F.col("total_shift")).alias("total_shift"))


def q_em_history(spark, d):
    """Full EM fit with the stop rule; iteration, shift and log-likelihood (M5, M6, M9)."""
    m = gaussian.em_fit(load_E(spark, d), 2, "k-means++", SEED)
    return m.history_frame(spark).select(
        F.col("iteration").cast("bigint"), rnd(F.col("total_shift")).alias("total_shift"), sig9(F.col("log_likelihood")).alias("log_likelihood"),
        F.when(F.col("ll_change") == float("inf"), F.col("ll_change")).otherwise(sig6(F.col("ll_change"))).alias("ll_change"),
    )


# --- composites ------------------------------------------------------------------------


def q_evaluate_k(spark, d):
    return evaluate_kmeans(load_E(spark, d), ks=(2, 3), frac=TEST_FRAC, seed=SEED)


def q_evaluate_em(spark, d):
    return evaluate_em(load_E(spark, d), ks=(2, 3), frac=TEST_FRAC, seed=SEED)


def q_evaluate_em_failed(spark, d):
    """One component: all predictions are equal, so the status is failed (A24)."""
    return evaluate_em(load_E(spark, d), ks=(1,), frac=TEST_FRAC, seed=SEED)


def _projected(spark, d):
    """The reference study's input: embeddings projected onto 40 principal components."""
    return prepare(load_E(spark, d), k=40, frac=TEST_FRAC, seed=SEED)


def q_kmeans_projected(spark, d):
    """K-means (k = 2, 3; K-means++, full stop rule) on the 40-PC projection, scored on train and test."""
    return evaluate_kmeans(_projected(spark, d), ks=(2, 3), frac=TEST_FRAC, seed=SEED, init="k-means++")


def q_em_projected(spark, d):
    """Gaussian-mixture EM (k = 2, 3) on the 40-PC projection, scored on train and test."""
    return evaluate_em(_projected(spark, d), ks=(2, 3), frac=TEST_FRAC, seed=SEED)


def q_prepare(spark, d):
    p = prepare(load_E(spark, d), k=40, frac=TEST_FRAC, seed=SEED)
    norm = F.sqrt(F.aggregate(F.col("features"), F.lit(0.0), lambda a, x: a + x * x))
    return p.select(F.col("id").alias("vec_id"), "split", rnd(norm).alias("pc_norm"))


# --- scale queries on lineitem (600k x 4 at sf0.1) -----------------------------------------


def q_lineitem_kmeans(spark, d):
    # lineitem has no unique key: a content id makes the seeding independent
    # of file layout and partitioning (identical rows share it and their features)
    li = load_L(spark, d, keep=(lineitem_row_id().alias("id"),))
    z, _ = stats.fit_standardize(li, len(LINEITEM_COLS))
    m = kmeans.kmeans_fit(z, 3, "k-means++", SEED)
    return m.transform(z).groupBy("cluster").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def q_lineitem_em(spark, d):
    """A mixture of three components fitted from given seeds to its stop rule; rows by component."""
    z, _ = stats.fit_standardize(load_L(spark, d), len(LINEITEM_COLS))
    m = gaussian.em_fit(z.withColumn("id", F.lit(0)), 3, list(LINEITEM_SEEDS))
    counts = gaussian.em_predict(z, m).groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()
    return spark.createDataFrame([(r["cluster"], r["n"]) for r in counts], "cluster int, n bigint")


def q_lineitem_svd(spark, d):
    _, _, m = _svd_of(load_L(spark, d), len(LINEITEM_COLS))
    ev = decompose.explained_variance(m.frame(spark))
    return ev.select(F.col("k").cast("bigint"), *[rnd(F.col(c)).alias(c) for c in ("singular_value", "pct_variance", "cum_pct")])


QUERIES: dict[str, Query] = {
    "matrix_shape": q_matrix_shape,
    "binarize_label": q_binarize_label,
    "with_row_id": q_with_row_id,
    "explode_columns": q_explode_columns,
    "matrix_text": q_matrix_text,
    "split_text": q_split_text,
    "matrix_round_trip": q_matrix_round_trip,
    "number_text_ids": q_number_text_ids,
    "vector_text": q_vector_text,
    "clusters_text": q_clusters_text,
    "em_clusters_text": q_em_clusters_text,
    "row_id_repeated": q_row_id_repeated,
    "split_repeated_ids": q_split_repeated_ids,
    "matrix_parse": q_matrix_parse,
    "plot_frame": q_plot_frame,
    "column_means_nan": q_column_means_nan,
    "impute_mean": q_impute_mean,
    "column_stats": q_column_stats,
    "standardize_columns": q_standardize_columns,
    "standardize_array": q_standardize_array,
    "covariance_narrow": q_covariance_narrow,
    "covariance_wide": q_covariance_wide,
    "svd_trace": q_svd_trace,
    "singular_values": q_singular_values,
    "explained_variance": q_explained_variance,
    "project_k": q_project_k,
    "svd_wide": q_svd_wide,
    "project_wide": q_project_wide,
    "split_exact": q_split_exact,
    "uniform_pick": q_uniform_pick,
    "weighted_pick": q_weighted_pick,
    "kmeanspp_init": q_kmeanspp_init,
    "kmeanspp_many": q_kmeanspp_many,
    "pairwise_distance": q_pairwise_distance,
    "assign_nearest": q_assign_nearest,
    "cluster_means": q_cluster_means,
    "cluster_stats": q_cluster_stats,
    "centroid_shift": q_centroid_shift,
    "kmeans_3iter": q_kmeans_3iter,
    "kmeans_predict": q_kmeans_predict,
    "lineitem_assign": q_lineitem_assign,
    "min_intercluster": q_min_intercluster,
    "max_intracluster": q_max_intracluster,
    "dunn_index": q_dunn_index,
    "silhouette": q_silhouette,
    "confusion": q_confusion,
    "classification_metrics": q_classification_metrics,
    "metrics_report": q_metrics_report,
    "em_init": q_em_init,
    "em_init_second_moment": q_em_init_second_moment,
    "gaussian_logpdf": q_gaussian_logpdf,
    "logsumexp": q_logsumexp,
    "em_estep_softmax": q_em_estep_softmax,
    "em_estep_sequential": q_em_estep_sequential,
    "em_mstep": q_em_mstep,
    "log_likelihood": q_log_likelihood,
    "log_likelihood_rows": q_log_likelihood_rows,
    "em_2iter": q_em_2iter,
    "em_predict": q_em_predict,
    "em_full": q_em_full,
    "kmeans_fit": q_kmeans_fit,
    "em_history": q_em_history,
    "evaluate_k": q_evaluate_k,
    "evaluate_em": q_evaluate_em,
    "evaluate_em_failed": q_evaluate_em_failed,
    "prepare": q_prepare,
    "kmeans_projected": q_kmeans_projected,
    "em_projected": q_em_projected,
    "lineitem_kmeans": q_lineitem_kmeans,
    "lineitem_em": q_lineitem_em,
    "lineitem_svd": q_lineitem_svd,
}

"""Results do not depend on the number of input partitions or on row order."""

import numpy as np
from conftest import SF01, frame
from pyspark.sql import functions as F

from sparkclust.operators import evaluate, gaussian, kmeans, moments
from sparkclust.plans.inputs import load_E


def _layouts(e):
    return [e.repartition(1), e.repartition(4), e.repartition(17), e.orderBy(F.rand(7)).repartition(5)]


def test_em_step_layout_invariant(spark):
    e = load_E(spark, SF01)
    m0 = gaussian.em_init(e, 2, "first")
    outs = [gaussian.em_mstep(x, m0) for x in _layouts(e)]
    ref, ll_ref, _ = outs[0]
    for m, ll, n in outs[1:]:
        assert n == 500 and abs(ll - ll_ref) < 1e-9
        assert np.allclose(m.means, ref.means, atol=1e-12)
        assert all(np.allclose(a, b, atol=1e-12) for a, b in zip(m.covs, ref.covs))


def test_metrics_layout_invariant(spark):
    e = load_E(spark, SF01)
    _, seeds = kmeans.first_k_seeds(e, 3)
    res = []
    for x in _layouts(e):
        a = kmeans.assign_nearest(x, seeds)
        d = evaluate.dunn_parts(a, block_rows=100).first()
        s = evaluate.silhouette(a, block_rows=100).first()
        res.append((d.min_inter, d.max_intra, s.silhouette))
    for r in res[1:]:
        assert np.allclose(r, res[0], atol=1e-12)


def test_kmeanspp_layout_invariant(spark):
    e = load_E(spark, SF01)
    ids = [kmeans.kmeanspp_init(x, 4, seed=9)[0] for x in _layouts(e)]
    assert all(i == ids[0] for i in ids)


def test_fits_have_the_same_history_bits_on_any_partitioning(spark):
    e = load_E(spark, SF01).selectExpr("id", "slice(features, 1, 12) AS features")
    runs = [
        (
            kmeans.kmeans_fit(x, 3, persist=False).history,
            kmeans.kmeans_fit(x, 3, persist=False).centroids,
            gaussian.em_fit(x, 2, max_iter=4, persist=False).history,
            gaussian.em_fit(x, 2, "first", max_iter=1, resp="sequential", persist=False).covs,
        )
        for x in (e.repartition(1), e.repartition(4), e.repartition(37))
    ]
    assert runs[0] == runs[1] == runs[2]


def test_assignment_in_the_fit_is_that_of_transform(spark):
    rng = np.random.default_rng(5)
    for d in (2, 5, 40):
        x = rng.integers(-3, 4, (300, d)) / 3.0  # many ties
        points = x[:6]
        df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id bigint, features array<double>")
        got = {r.id: r.cluster for r in kmeans.assign_nearest(df, points.tolist()).collect()}
        assert [got[i] for i in range(len(x))] == kmeans.nearest(x, points).tolist()


def test_models_fitted_side_by_side_are_those_fitted_alone(spark):
    e = load_E(spark, SF01).selectExpr("id", "slice(features, 1, 6) AS features")
    many = kmeans.kmeans_fit_many(e, [2, 3, 5])
    for k, m in zip((2, 3, 5), many):
        alone = kmeans.kmeans_fit(e, k)
        assert (m.centroids, m.history, m.counts, m.seed_ids) == (alone.centroids, alone.history, alone.counts, alone.seed_ids)
    for k, m in zip((2, 3), gaussian.em_fit_many(e, [2, 3], max_iter=3)):
        alone = gaussian.em_fit(e, k, max_iter=3)
        assert (m.means, m.covs, m.history) == (alone.means, alone.covs, alone.history)


def test_packed_rows_take_the_same_passes(spark):
    x = frame(spark, [(i, [i * 0.37 - 3.0, (i * 7919 % 101) / 9.0, -i / 3.0], 0) for i in range(700)]).repartition(3)
    blocks = moments.packed(x, 3)
    assert blocks.columns == ["features"] and blocks.count() < 20
    points = [[0.0, 1.0, 2.0], [3.0, 5.0, -80.0], [9.0, 9.0, -200.0]]
    g = kmeans.fit_grid(x, 3)
    assert vars(kmeans.fit_grid(blocks, 3))["exps"].tolist() == g.exps.tolist()
    assert kmeans.lloyd_pass(blocks, [points], g) == kmeans.lloyd_pass(x, [points], g)
    model = gaussian.em_init(x, 3, points)
    assert gaussian.em_mstep(blocks, model, g=g) == gaussian.em_mstep(x, model, g=g)
    fits = [kmeans.kmeans_fit(x, 3, points, persist=p) for p in (True, False)]
    assert fits[0].history == fits[1].history and fits[0].centroids == fits[1].centroids


def test_columns_give_the_bits_of_rows():
    l = -20 * np.random.default_rng(3).random((9, 400))
    for k in (1, 3, 9):
        assert (gaussian.logsumexp_of(l[:k]) == gaussian.logsumexp_np(np.ascontiguousarray(l[:k].T))).all()
    q = moments.limbs(l, np.full((9, 1), 5))
    want = [sum(int(a) * int(b) for i in range(w + 1) for a, b in zip(q[i][2], q[w - i][4])) for w in range(moments.LIMBS)]
    assert moments.limb_products(q, q)[:, 2, 4].tolist() == want

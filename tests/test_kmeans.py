import numpy as np
from conftest import SF01, frame

from sparkclust.operators import evaluate, kmeans
from sparkclust.plans.inputs import load_E


def test_square_fixture(spark):
    df = frame(spark, [(0, [0.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [10.0, 0.0], 1), (3, [10.0, 1.0], 1)])
    m = kmeans.kmeans_fit(df, 2, init=[[0.0, 1.0], [10.0, 1.0]])
    assert np.allclose(m.centroids, [[0.0, 0.5], [10.0, 0.5]])
    d = evaluate.dunn_parts(m.transform(df)).first()
    assert d.min_inter == 10.0 and d.max_intra == 1.0 and d.dunn == 10.0


def test_tie_goes_to_lowest_cluster(spark):
    df = frame(spark, [(0, [0.0], 0)])
    assert kmeans.assign_nearest(df, [[-1.0], [1.0]]).first().cluster == 0


def test_empty_cluster_keeps_id_and_centroid(spark):
    df = frame(spark, [(i, [0.0], 0) for i in range(3)])
    new, counts = kmeans.lloyd_update(df, [[0.0], [5.0], [9.0]], 1)
    assert new == [[0.0], [5.0], [9.0]] and counts == [3, 0, 0]


def _numpy_lloyd(x, c, steps):
    c = np.array(c)
    for _ in range(steps):
        d = np.sqrt(((x[:, None, :] - c[None]) ** 2).sum(-1))
        a = d.argmin(1)
        c = np.array([x[a == k].mean(0) if (a == k).any() else c[k] for k in range(len(c))])
    return c


def test_lloyd_matches_numpy_and_cost_decreases(spark):
    e = load_E(spark, SF01)
    ids, seeds = kmeans.first_k_seeds(e, 4)
    rows = e.orderBy("id").collect()
    x = np.array([r.features for r in rows])
    ours = kmeans.kmeans_steps(e, seeds, 4)
    assert np.allclose(ours, _numpy_lloyd(x, seeds, 4), atol=1e-12)
    costs = []
    c = seeds
    for _ in range(4):
        d = np.sqrt(((x[:, None, :] - np.array(c)[None]) ** 2).sum(-1)).min(1)
        costs.append((d ** 2).sum())
        c = kmeans.kmeans_steps(e, c, 1)
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))


def test_kmeans_fit_stop_rule_and_history(spark):
    e = load_E(spark, SF01)
    m = kmeans.kmeans_fit(e, 3, init="k-means++", seed=42, max_iter=50)
    assert m.iterations == len(m.history) <= 50
    shifts = [h[1] for h in m.history]
    # every counted pass moved the centroids by more than tol, except possibly the last
    assert all(s > 0.005 for s in shifts[:-1])
    assert sum(m.counts) == e.count()
    # partitioning does not change the fit
    m2 = kmeans.kmeans_fit(e.repartition(7), 3, init="k-means++", seed=42, max_iter=50)
    assert np.allclose(m.centroids, m2.centroids, atol=1e-12)

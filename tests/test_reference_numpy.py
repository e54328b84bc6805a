"""NumPy re-implementations of the fits that have no SQL oracle (D = 64, full stop rules)."""

import math

import numpy as np
from conftest import SF01

from sparkclust.operators import decompose, gaussian, kmeans, stats
from sparkclust.plans.inputs import load_E
from sparkclust.plans.workflows import prepare


def _x(spark):
    e = load_E(spark, SF01)
    rows = e.orderBy("id").collect()
    return e, np.array([r.features for r in rows]), np.array([r.id for r in rows])


def _np_logpdf(x, w, mu, cov):
    s, u = np.linalg.eigh(cov)
    tol = 1e6 * np.finfo(float).eps * np.abs(s).max()
    keep = s > tol
    uu = u[:, keep] / np.sqrt(s[keep])
    y = (x - mu) @ uu
    return math.log(w) - 0.5 * (keep.sum() * math.log(2 * math.pi) + np.log(s[keep]).sum() + (y * y).sum(1))


def _np_em_step(x, ws, mus, covs):
    l = np.stack([_np_logpdf(x, w, m, c) for w, m, c in zip(ws, mus, covs)], 1)
    m = l.max(1, keepdims=True)
    lse = (m + np.log(np.exp(l - m).sum(1, keepdims=True)))[:, 0]
    r = np.exp(l - lse[:, None])
    nk = np.maximum(r.sum(0), 1e-10)
    new_w = nk / len(x)
    new_mu = (r.T @ x) / nk[:, None]
    new_cov = [((x - new_mu[k]) * r[:, [k]]).T @ (x - new_mu[k]) / nk[k] for k in range(len(ws))]
    return new_w, new_mu, new_cov, lse.sum()


def test_em_steps_d64_match_numpy(spark):
    e, x, _ = _x(spark)
    m = gaussian.em_init(e, 2, "k-means++", 42)
    ws, mus, covs = np.array(m.weights), np.array(m.means), [np.array(c) for c in m.covs]
    cur = m
    for _ in range(3):
        cur, ll, n = gaussian.em_mstep(e, cur)
        ws, mus, covs, ll_np = _np_em_step(x, ws, mus, covs)
        assert n == len(x)
        assert math.isclose(ll, ll_np, rel_tol=1e-9)
        assert np.allclose(cur.weights, ws, atol=1e-10)
        assert np.allclose(cur.means, mus, atol=1e-10)
        assert all(np.allclose(a, b, atol=1e-10) for a, b in zip(cur.covs, covs))


def test_em_init_centred_class_covariance(spark):
    e, x, ids = _x(spark)
    seed_ids, seeds = kmeans.first_k_seeds(e, 2)
    m = gaussian.em_init(e, 2, "first")
    d = np.sqrt(((x[:, None, :] - np.array(seeds)[None]) ** 2).sum(-1))
    a = d.argmin(1)
    for k in range(2):
        xs = x[a == k]
        assert math.isclose(m.weights[k], len(xs) / len(x))
        assert np.allclose(m.means[k], xs.mean(0), atol=1e-12)
        assert np.allclose(m.covs[k], np.cov(xs, rowvar=False, bias=True), atol=1e-12)


def test_kmeans_full_stop_rule_matches_numpy(spark):
    e, x, _ = _x(spark)
    m = kmeans.kmeans_fit(e, 3, init="first", max_iter=100)
    _, seeds = kmeans.first_k_seeds(e, 3)
    c = np.array(seeds)
    change, old_change, it = math.inf, 0.0, 0
    while change > 0.005 and it < 100:
        d = np.sqrt(((x[:, None, :] - c[None]) ** 2).sum(-1))
        a = d.argmin(1)
        new = np.array([x[a == k].mean(0) if (a == k).any() else c[k] for k in range(3)])
        change = float(np.sqrt(((new - c) ** 2).sum(1)).sum())
        c = new
        if change == old_change:
            break
        old_change = change
        it += 1
    assert m.iterations == it
    assert np.allclose(m.centroids, c, atol=1e-10)


def test_prepare_matches_numpy(spark):
    e, x, ids = _x(spark)
    p = prepare(e, k=10, frac=0.235, seed=42)
    rows = {r.id: r for r in p.collect()}
    z = (x - x.mean(0)) / x.std(0)
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    y = z @ vt[:10].T
    got = np.array([rows[i].features for i in ids])
    # components are defined up to sign: compare absolute values
    assert np.allclose(np.abs(got), np.abs(y), atol=1e-8)
    assert sum(r.split == "test" for r in rows.values()) == math.floor(0.235 * len(x))


def _lineitem(spark):
    from sparkclust.plans.inputs import load_L

    z, _ = stats.fit_standardize(load_L(spark, SF01), 4)
    x = np.array([r.features for r in load_L(spark, SF01).collect()])
    return z, (x - x.mean(0)) / x.std(0)


def test_lineitem_svd_matches_numpy(spark):
    z, xz = _lineitem(spark)
    m = decompose.svd(z, 4)
    assert np.allclose(m.singular_values, np.linalg.svd(xz, compute_uv=False), rtol=1e-9)


def test_lineitem_em_steps_match_numpy(spark):
    from sparkclust.plans.inputs import LINEITEM_SEEDS

    z, xz = _lineitem(spark)
    m = gaussian.em_init(z, 3, list(LINEITEM_SEEDS))
    ws, mus, covs = np.array(m.weights), np.array(m.means), [np.array(c) for c in m.covs]
    cur = m
    for _ in range(3):
        cur, ll, _ = gaussian.em_mstep(z, cur)
        ws, mus, covs, ll_np = _np_em_step(xz, ws, mus, covs)
        assert math.isclose(ll, ll_np, rel_tol=1e-9)
        assert np.allclose(cur.means, mus, atol=1e-9)
        assert all(np.allclose(a, b, atol=1e-9) for a, b in zip(cur.covs, covs))


def test_lineitem_kmeans_matches_numpy(spark):
    z, xz = _lineitem(spark)
    from pyspark.sql import functions as F

    zi = z.withColumn("id", F.monotonically_increasing_id())
    _, seeds = kmeans.kmeanspp_init(zi, 3, seed=42)
    m = kmeans.kmeans_fit(zi, 3, init=seeds, max_iter=20)
    c = np.array(seeds)
    change, old, it = math.inf, 0.0, 0
    while change > 0.005 and it < 20:
        a = np.sqrt(((xz[:, None, :] - c[None]) ** 2).sum(-1)).argmin(1)
        new = np.array([xz[a == k].mean(0) if (a == k).any() else c[k] for k in range(3)])
        change = float(np.sqrt(((new - c) ** 2).sum(1)).sum())
        c = new
        if change == old:
            break
        old = change
        it += 1
    assert m.iterations == it
    assert np.allclose(m.centroids, c, atol=1e-8)


def test_evaluate_em_consistent(spark):
    from conftest import load_E2
    from sparkclust.plans.workflows import evaluate_em

    rows = evaluate_em(load_E2(spark, SF01), ks=(2,), frac=0.235, seed=42).collect()
    n = load_E2(spark, SF01).count()
    by = {r.split: r for r in rows}
    assert by["test"].correct + by["test"].incorrect == math.floor(0.235 * n)
    assert by["train"].correct + by["train"].incorrect == n - math.floor(0.235 * n)
    for r in rows:
        assert r.status in ("ok", "failed")
        assert r.silhouette is None or -1.0 <= r.silhouette <= 1.0


def test_imputed_stats_equal_second_pass(spark):
    from sparkclust.plans.inputs import load_E_nan
    from sparkclust.plans.workflows import imputed_stats

    e = load_E_nan(spark, SF01)
    obs = stats.fit_column_stats(e, 64)
    derived = imputed_stats(obs)
    second = stats.fit_column_stats(stats.impute_mean(e, obs.mean), 64)
    assert np.allclose(derived.mean, second.mean, atol=1e-15)
    assert np.allclose(derived.std, second.std, rtol=1e-10)

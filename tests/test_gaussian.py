import math

import numpy as np
from conftest import SF01, frame, load_E2

from sparkclust.operators import gaussian
from sparkclust.plans.inputs import load_E


def test_singular_covariance_finite(spark):
    df = frame(spark, [(i, [float(i), 2.0 * i], 0) for i in range(6)])
    m = gaussian.GaussianMixtureModel([1.0], [[2.5, 5.0]], [np.cov(np.array([[i, 2 * i] for i in range(6)]).T, bias=True).tolist()])
    vals = [r.log_joint[0] for r in gaussian.gaussian_logpdf(df, m).collect()]
    assert all(math.isfinite(v) for v in vals)


def test_logpdf_matches_closed_form(spark):
    e2 = load_E2(spark, SF01)
    m = gaussian.em_init(e2, 2, "k-means++", 42)
    rows = gaussian.gaussian_logpdf(e2, m).orderBy("id").collect()
    for r in rows[:50]:
        x = np.array(r.features)
        for k in range(2):
            mu, cov = np.array(m.means[k]), np.array(m.covs[k])
            dx = x - mu
            ref = math.log(m.weights[k]) - 0.5 * (2 * math.log(2 * math.pi) + math.log(np.linalg.det(cov)) + dx @ np.linalg.inv(cov) @ dx)
            assert math.isclose(r.log_joint[k], ref, rel_tol=1e-9, abs_tol=1e-9)


def test_softmax_rows_sum_to_one_and_ll_increases(spark):
    e = load_E(spark, SF01)
    m = gaussian.em_init(e, 2, "k-means++", 42)
    r = gaussian.em_estep(e, m).collect()
    assert all(abs(sum(x.resp) - 1.0) < 1e-9 for x in r)
    lls = []
    for _ in range(4):
        m, ll, n = gaussian.em_mstep(e, m)
        lls.append(ll)
    assert all(b >= a - 1e-6 for a, b in zip(lls, lls[1:]))


def test_sequential_mode_k2_formula(spark):
    e2 = load_E2(spark, SF01)
    m = gaussian.em_init(e2, 2, "first")
    lj = {r.id: r.log_joint for r in gaussian.gaussian_logpdf(e2, m).collect()}
    rs = {r.id: r.resp for r in gaussian.em_estep(e2, m, "sequential").collect()}
    for i in list(lj)[:50]:
        l0, l1 = lj[i]
        r0 = math.exp(l0) / (math.exp(l0) + math.exp(l1))
        r1 = math.exp(l1) / (r0 + math.exp(l1))
        assert math.isclose(rs[i][0], r0, rel_tol=1e-9) and math.isclose(rs[i][1], r1, rel_tol=1e-9)


def test_em_fit_and_predict(spark):
    e = load_E(spark, SF01)
    m = gaussian.em_fit(e, 2, "k-means++", 42, max_iter=20)
    assert 1 <= m.iterations <= 20 and len(m.history) == m.iterations
    assert abs(sum(m.weights) - 1.0) < 1e-9
    p = gaussian.em_predict(e, m)
    assert set(r.cluster for r in p.select("cluster").distinct().collect()) <= {0, 1}

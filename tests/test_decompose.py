import numpy as np
import pytest
from conftest import SF01

from sparkclust.operators import decompose, stats
from sparkclust.plans.inputs import load_E


def _z(spark):
    e = load_E(spark, SF01)
    z, _ = stats.fit_standardize(e, 64)
    return z


def test_svd_matches_numpy(spark):
    z = _z(spark)
    m = decompose.svd(z, 64)
    x = np.array([r.features for r in z.orderBy("id").collect()])
    s = np.linalg.svd(x, compute_uv=False)
    assert np.allclose(m.singular_values, s, rtol=1e-8, atol=1e-7)
    assert abs(sum(v * v for v in m.singular_values) - x.shape[0] * 64) < 1e-6  # sum s^2 = N * D
    v = np.array(m.loadings)
    assert np.allclose(v @ v.T, np.eye(64), atol=1e-9)  # orthonormal loadings


def test_explained_variance_and_projection(spark):
    z = _z(spark)
    m = decompose.svd(z, 64)
    ev = decompose.explained_variance(m.frame(spark)).orderBy("k").collect()
    assert abs(sum(r.pct_variance for r in ev) - 100.0) < 1e-9
    assert abs(ev[-1].cum_pct - 100.0) < 1e-9
    p = decompose.project(z, m, 5, out="pc").orderBy("id").collect()
    x = np.array([r.features for r in p])
    y = np.array([r.pc for r in p])
    v = np.array(m.loadings)[:5]
    assert np.allclose(y, x @ v.T, atol=1e-10)
    # variance captured by the first components equals their squared singular values
    assert np.allclose((y ** 2).sum(0), np.array(m.singular_values[:5]) ** 2, rtol=1e-8)


@pytest.mark.parametrize("d", [3, 64, 178])
def test_small_singular_values_keep_their_digits(spark, d):
    rng = np.random.default_rng(d)
    x = rng.standard_normal((400, d))
    x[:, 2] = x[:, 0] + 1e-9 * rng.standard_normal(400)
    want = np.linalg.svd(x, compute_uv=False)
    assert want[-1] < 1e-7
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(-1, None)], "id bigint, features array<double>")
    for layout in (df.repartition(1), df.repartition(4), df.repartition(23)):
        m = decompose.svd(layout, d)
        assert m.n == 400 and np.abs(np.array(m.singular_values) - want).max() < 1e-10 * want[0]
        assert abs(m.singular_values[-1] - want[-1]) < 1e-6 * want[-1] + 1e-13 * want[0]


def test_fewer_rows_than_columns_and_missing_cells(spark):
    df = spark.createDataFrame([(1, [3.0, 0.0, 4.0])], "id bigint, features array<double>")
    m = decompose.svd(df, 3)
    assert np.allclose(m.singular_values, [5.0, 0.0, 0.0]) and np.allclose(np.abs(m.loadings[0]), [0.6, 0.0, 0.8])
    with pytest.raises(Exception, match="impute"):
        decompose.svd(spark.createDataFrame([(1, [1.0, float("nan")])], "id bigint, features array<double>"), 2)


def test_projection_of_null_vectors_and_any_batch(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rng.standard_normal((50, 7)))] + [(50, None)], "id bigint, features array<double>")
    m = decompose.svd(df, 7)
    got = [{r.id: r.pc for r in decompose.project(x, m, 3, out="pc").collect()} for x in (df.repartition(1), df.repartition(13))]
    assert got[0] == got[1] and got[0][50] is None and len(got[0][0]) == 3

import math

import numpy as np
import pytest
from conftest import SF01, frame
from pyspark.sql import functions as F

from sparkclust.operators import decompose, moments, stats
from sparkclust.plans.inputs import load_E, load_L


def test_nan_col_impute(spark):
    df = frame(spark, [(0, [1.0, float("nan")], 0), (1, [None, 2.0], 0), (2, [3.0, 4.0], 0)])
    st = stats.fit_column_stats(df, 2)
    assert st.mean == [2.0, 3.0]
    out = stats.impute_mean(df, st.mean, count_col="n_imp").orderBy("id").collect()
    assert [list(r.features) for r in out] == [[1.0, 3.0], [2.0, 2.0], [3.0, 4.0]]
    assert [r.n_imp for r in out] == [1, 1, 0]


def test_const_col_standardize(spark):
    df = frame(spark, [(i, [float(i), 5.0], 0) for i in range(6)])
    z, st = stats.fit_standardize(df, 2)
    assert st.constant == [1]
    rows = z.collect()
    assert all(r.features[1] == 0.0 for r in rows)
    col0 = np.array([r.features[0] for r in rows])
    assert abs(col0.mean()) < 1e-12 and abs(col0.std() - 1.0) < 1e-12  # population std
    m = decompose.svd(z, 2)
    assert abs(sum(s * s for s in m.singular_values) - 6 * 1) < 1e-9  # N * D'


def test_population_std_matches_numpy(spark):
    l = load_L(spark, SF01)
    st = stats.fit_column_stats(l, 4)
    x = np.array([r.features for r in l.collect()])
    assert np.allclose(st.mean, x.mean(0), rtol=1e-12)
    assert np.allclose(st.std, x.std(0), rtol=1e-10)


def test_covariance_narrow_equals_wide(spark):
    e = load_E(spark, SF01).selectExpr("id", "slice(features, 1, 8) AS features")
    names = [str(i) for i in range(8)]
    narrow = {(r.col_i, r.col_j): r.cov for r in stats.covariance(e, names).collect()}
    wide = stats.covariance_matrix(e, 8)
    x = np.array([r.features for r in e.collect()])
    ref = np.cov(x, rowvar=False, bias=True)
    for i in range(8):
        for j in range(8):
            assert math.isclose(narrow[(str(i), str(j))], wide[i, j], rel_tol=1e-9, abs_tol=1e-15)
            assert math.isclose(wide[i, j], ref[i, j], rel_tol=1e-9, abs_tol=1e-15)


def _random(n, d, seed=0, missing=0.0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)) * np.exp(rng.uniform(-8, 8, d)) + rng.uniform(-1e6, 1e6, d)
    x[rng.random((n, d)) < missing] = np.nan
    return x


def _frame(spark, x, nulls=0):
    rows = [(i, r.tolist(), 0) for i, r in enumerate(x)] + [(len(x) + i, None, 0) for i in range(nulls)]
    return spark.createDataFrame(rows, "id bigint, features array<double>, label int")


@pytest.mark.parametrize("d", [4, 17, 64])
def test_one_rule_for_null_rows_and_cells_at_every_width(spark, d):
    x = _random(300, d, d, 0.1)
    df = _frame(spark, x, nulls=7)
    st = stats.fit_column_stats(df, d)
    assert (st.n, st.nulls) == (300, 7) and st.count == (~np.isnan(x)).sum(0).tolist()
    assert np.allclose(st.mean, np.nanmean(x, 0), rtol=1e-13) and np.allclose(st.std, np.nanstd(x, 0), rtol=1e-7)
    cov = stats.covariance_matrix(df, d)
    for i, j in [(0, 0), (0, 1), (1, d - 1), (d - 1, 2)]:
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        ref = np.cov(x[both, i], x[both, j], bias=True)[0, 1]
        assert math.isclose(cov[i, j], ref, rel_tol=1e-5, abs_tol=1e-9 * math.sqrt(cov[i, i] * cov[j, j]) + 1e-15)
    stats.impute_mean(df, st.mean, count_col="n_imp").collect()


def test_covariance_far_from_zero_is_that_of_whole_numbers(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-50, 50, (400, 3))
    cov = stats.covariance_matrix(_frame(spark, base + 2.0**40), 3)
    n, s = len(base), base.sum(0)
    exact = [[(n * int((base[:, i] * base[:, j]).sum()) - int(s[i]) * int(s[j])) / (n * n) for j in range(3)] for i in range(3)]
    assert cov.tolist() == exact  # no bit lost


def test_sums_are_the_same_bits_under_any_partitioning(spark):
    x = _random(2000, 6, 3, 0.05)
    df = _frame(spark, x)
    seen = set()
    for layout in (df.repartition(1), df.repartition(4), df.repartition(37), df.orderBy(df.id.desc())):
        st, m = stats.fit_column_stats(layout, 6), moments.co_moments(layout, 6)
        seen.add((tuple(st.mean), tuple(st.std), m.covariance.tobytes(), m.mean.tobytes(), m.gram.tobytes()))
    assert len(seen) == 1


def test_exact_sums_reach_the_nearest_double(spark):
    from fractions import Fraction

    x = np.array([[1e16, 1.0], [1.0, 1e-9], [-1e16, -1.0], [3.0, 1e-9]])
    st = stats.fit_column_stats(_frame(spark, x), 2)
    want = [float(sum(Fraction(v) for v in c) / 4) for c in x.T]
    assert st.mean[0] == want[0] and math.isclose(st.mean[1], want[1], rel_tol=1e-7)


def test_empty_and_infinite_input(spark):
    with pytest.raises(ValueError, match="empty"):
        stats.fit_column_stats(_frame(spark, np.zeros((0, 2)), nulls=3), 2)
    with pytest.raises(ValueError, match="infinite"):
        stats.fit_column_stats(_frame(spark, np.array([[1.0, np.inf]])), 2)


def test_group_co_moments(spark):
    x = _random(200, 5, 9)
    df = _frame(spark, x).withColumn("cluster", (F.col("id") % 3).cast("int"))
    df = df.unionByName(df.limit(5).withColumn("cluster", F.lit(None).cast("int")))
    for k, m in moments.group_co_moments(df, 5, "cluster").items():
        mine = x[k::3]
        assert m.n[0, 0] == len(mine) and np.allclose(m.mean, mine.mean(0), rtol=1e-12)
        assert np.allclose(m.covariance, np.cov(mine, rowvar=False, bias=True), rtol=1e-6)

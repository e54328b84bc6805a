"""Inputs that once gave wrong answers: offsets, near pairs, many blocks, missing and repeated ids, NULLs, NaN."""

import numpy as np
import pytest
from conftest import frame
from pyspark.sql import functions as F

from sparkclust.operators import evaluate, gaussian, kmeans, stats


def test_std_of_wide_rows_far_from_zero_with_a_missing_cell(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((1000, 17)) + 1e8
    x[0, 0] = np.nan
    df = spark.createDataFrame([(i, r.tolist(), 0) for i, r in enumerate(x)], "id bigint, features array<double>, label int")
    got = stats.fit_column_stats(df, 17)
    assert np.allclose(got.mean, np.nanmean(x, axis=0), rtol=1e-12)
    assert np.allclose(got.std, np.nanstd(x, axis=0), atol=1e-6)
    again = stats.fit_column_stats(df.repartition(7).orderBy(F.desc("id")), 17)
    assert np.allclose(got.std, again.std, atol=1e-9)


@pytest.mark.parametrize("far,near", [(1e8, 1e-3), (100.0, 1e-7)])
def test_closest_pair_far_from_the_centre(spark, far, near):
    rows = [(1, [far, 0.0], 0), (2, [far, near], 1), (3, [-far, 0.0], 0), (4, [-far, 50.0], 1)]
    df = frame(spark, rows).withColumnRenamed("label", "cluster")
    assert abs(evaluate.dunn_parts(df, n=4).first().min_inter - near) < 1e-4 * near


def test_results_do_not_depend_on_the_number_of_blocks(spark):
    rng = np.random.default_rng(3)
    df = frame(spark, [(i, rng.standard_normal(3).tolist(), i % 3) for i in range(120)]).withColumnRenamed("label", "cluster")
    a, b = evaluate.dunn_parts(df, n=120).first(), evaluate.dunn_parts(df, n=120, block_rows=5).first()
    assert np.allclose(a[:3], b[:3])  # not the share of pairs visited
    assert abs(evaluate.silhouette(df, n=120).first()[0] - evaluate.silhouette(df, n=120, block_rows=5).first()[0]) < 1e-12


def test_confusion_counts_every_row(spark):
    df = spark.createDataFrame([(1, 1), (0, 0), (None, 1), (1, None), (None, None), (0, 2)], "label int, cluster int")
    r = evaluate.confusion(df).first()
    assert (r.correct, r.incorrect, r.tp, r.tn, r.fp, r.fn) == (2, 4, 1, 1, 3, 1)


def test_missing_cells_raise_instead_of_a_model_of_nan(spark):
    df = frame(spark, [(i, [float(i), float("nan") if i == 3 else 1.0 * i], 0) for i in range(12)])
    with pytest.raises(ValueError):
        kmeans.kmeans_fit(df, 2, init=[[0.0, 0.0], [9.0, 9.0]])
    with pytest.raises(ValueError):
        gaussian.em_fit(df, 2, init=[[0.0, 0.0], [9.0, 9.0]])


def test_fits_run_to_their_stop_rule_and_say_so(spark):
    rng = np.random.default_rng(1)
    df = frame(spark, [(i, rng.standard_normal(2).tolist(), 0) for i in range(200)])
    full, cut = kmeans.kmeans_fit(df, 4), kmeans.kmeans_fit(df, 4, max_iter=1)
    assert full.converged and full.history[-1][1] <= 0.005 and not cut.converged and cut.iterations == 1
    assert not gaussian.em_fit(df, 2, max_iter=1).converged


def test_seed_list_of_the_wrong_length(spark):
    df = frame(spark, [(i, [float(i)], 0) for i in range(5)])
    with pytest.raises(ValueError):
        gaussian.em_init(df, 3, [[0.0], [1.0]])


def test_settled_follows_the_rule():
    assert kmeans.settled([], 0.1) is None and kmeans.settled([0.0], 0.1) == 0
    assert kmeans.settled([3.0, 2.0], 0.1) is None and kmeans.settled([3.0, 3.0], 0.1) == 1 and kmeans.settled([3.0, 0.05], 0.1) == 2

import math

import pytest
from conftest import SF01, frame

from sparkclust.operators import kmeans, sampling
from sparkclust.plans.inputs import load_E


def test_split_exact_count_and_partition_invariance(spark):
    e = load_E(spark, SF01)
    n = e.count()
    base = None
    for p in (1, 4, 17):
        s = sampling.split_exact(e.repartition(p), frac=0.235, seed=7)
        test_ids = sorted(r.id for r in s.where("split = 'test'").select("id").collect())
        assert len(test_ids) == math.floor(0.235 * n)
        base = base or test_ids
        assert test_ids == base


def test_split_exact_digit_by_digit(spark, monkeypatch):
    e = load_E(spark, SF01)
    wide = sorted(r.id for r in sampling.split_exact(e, n_test=123, seed=3).where("split = 'test'").collect())
    monkeypatch.setattr(sampling, "DIGIT", 3)  # many passes
    narrow = sorted(r.id for r in sampling.split_exact(e, n_test=123, seed=3).where("split = 'test'").collect())
    assert len(wide) == 123 and wide == narrow


def test_a_split_needs_no_unique_ids(spark, monkeypatch):
    monkeypatch.setattr(sampling, "COPIES", 7)
    same = frame(spark, [(7, [1.0], 0)] * 30)
    mixed = frame(spark, [(None, [float(i % 3)], 0) for i in range(30)] + [(i, [1.0], 0) for i in range(30)] + [(4, [2.0], 1)] * 9)
    for df, n in ((same, 10), (mixed, 1), (mixed, 23), (mixed, 44), (mixed, 68)):
        split = sampling.split_exact(df, n_test=n)
        assert split.where("split = 'test'").count() == n
        assert sorted(map(str, split.drop("split").collect())) == sorted(map(str, df.collect()))
        again = sampling.split_exact(df.repartition(5), n_test=n)
        assert sorted(map(str, split.collect())) == sorted(map(str, again.collect()))
    no_ids = sampling.split_exact(mixed.drop("id"), frac=0.5, id_col=None)
    assert no_ids.where("split = 'test'").count() == 34


def _numbers(df, key):
    rows = sampling.with_row_id(df, key).collect()
    assert sorted(r.row_id for r in rows) == list(range(len(rows)))
    return [r for r in sorted(rows, key=lambda r: r.row_id)]


def test_with_row_id_on_any_layout(spark):
    e = load_E(spark, SF01).select("id")
    one = {r.id: r.row_id for r in _numbers(e, "id")}
    assert one == {r.id: r.row_id for r in _numbers(e.repartition(13), "id")}
    assert all(one[a] < one[b] for a, b in zip(sorted(one), sorted(one)[1:]))


def test_with_row_id_of_null_text_and_repeated_keys(spark):
    rows = [(None, 1), ("b", 2), ("a", 3), (None, 4), ("", 5), ("é", 6), ("b", 7)] + [("m", i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "key string, v int")
    a, b = _numbers(df.repartition(1), "key"), _numbers(df.repartition(9), "key")
    assert [(r.key, r.v) for r in a] == [(r.key, r.v) for r in b]
    keys = [r.key for r in a]
    assert keys[:2] == [None, None] and keys[2:] == sorted(keys[2:])
    assert sampling.with_row_id(df.limit(0), "key").count() == 0


def test_kmeanspp_few_distinct_raises(spark):
    df = frame(spark, [(0, [1.0, 1.0], 0), (1, [1.0, 1.0], 0), (2, [2.0, 2.0], 0)])
    with pytest.raises(ValueError):
        kmeans.kmeanspp_init(df, 3, seed=1)


def test_kmeanspp_distinct_seeds(spark):
    e = load_E(spark, SF01)
    ids, cents = kmeans.kmeanspp_init(e, 5, seed=11, power=2)
    assert len(set(ids)) == 5 and len(cents) == 5


def test_weighted_pick_only_positive_weight(spark):
    df = frame(spark, [(0, [0.0], 0), (1, [0.0], 0), (2, [3.0], 0)])
    from pyspark.sql import functions as F

    r = sampling.weighted_pick(df, F.col("features")[0], seed=5, step=1).first()
    assert r.id == 2


def test_kmeanspp_carried_state_equals_recompute(spark, monkeypatch):
    e = load_E(spark, SF01)
    a = kmeans.kmeanspp_init(e, 10, seed=5)
    monkeypatch.setattr(kmeans, "RECOMPUTE_SEEDS", 100)
    b = kmeans.kmeanspp_init(e, 10, seed=5)
    assert a[0] == b[0]


def test_split_exact_edges(spark):
    e = load_E(spark, SF01)
    n = e.count()
    assert sampling.split_exact(e, n_test=0).where("split = 'test'").count() == 0
    assert sampling.split_exact(e, n_test=n).where("split = 'test'").count() == n
    assert sampling.split_exact(e, n_test=n + 5).where("split = 'test'").count() == n
    assert sampling.split_exact(e, frac=0.0).where("split = 'test'").count() == 0
    assert sampling.split_exact(e, frac=1.0).where("split = 'test'").count() == n

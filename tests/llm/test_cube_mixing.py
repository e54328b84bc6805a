import numpy as np
from llm_cases import EDGES, SF01, docs
from pyspark.sql import functions as F

from sparkclust.llm import cube_mixing as cm


def brute_targets(sizes):
    """Excess reshared by weight until none is above its ceiling."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: cm.WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not above:
            return {s: 3.0 * sizes[s] if s in full else share[s] for s in names}
        full |= above


def check(df, sizes_of_rows):
    rows = cm.mix(df).collect()
    assert sorted(r.size for r in rows) == sorted(sizes_of_rows)
    per = {}
    for r in rows:
        s = per.setdefault(r.source, [0, 0, 0, r.target, r.source_size])
        s[0] += r.size
        s[1] += r.taken
        s[2] = max(s[2], r.size)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
    want = brute_targets({s: v[0] for s, v in per.items()})
    for s, (size, taken, largest, target, source_size) in per.items():
        assert source_size == size
        assert abs(target - want[s]) <= 1e-6 * max(1, want[s])
        assert abs(taken - target) <= largest + 1, (s, taken, target)
    return rows


def test_targets_and_balance_on_the_table(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = check(df, [len((r.text or "").split()) for r in df.select("text").collect()])
    again = cm.mix(df.repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_uneven_sources_reach_the_ceiling(spark, monkeypatch):
    monkeypatch.setattr(cm, "BUCKET_ROWS", 20)  # several flights
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 60))), s) for i, s in enumerate(["a"] * 400 + ["b"] * 3 + ["c"] * 30 + ["d"] * 2 + [None] * 40)]
    check(docs(spark, rows), [len(t.split()) for _, t, _ in rows])


def test_edges(spark):
    sizes = [len((t or "").replace("\x1c", "x").split()) if i != 6 else len(t.split(" ")) - 1 for i, t, _ in EDGES]
    check(docs(spark, EDGES), sizes)
    assert cm.mix(docs(spark, [])).count() == 0
    only_empty = cm.mix(docs(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [(r.size, r.taken) for r in only_empty] == [(0, 0), (0, 0)]


def test_flight_keeps_the_balance_and_leaves_few():
    rng = np.random.default_rng(0)
    z = np.column_stack([np.ones(500), rng.uniform(1, 9, 500), rng.uniform(0, 1, 500)])
    p = rng.uniform(0.1, 0.9, 500)
    out = cm.flight(p.copy(), z, rng)
    assert ((out > 0) & (out < 1)).sum() <= 3
    assert np.allclose(z.T @ out, z.T @ p)
    assert set(np.unique(cm.land(out, z, rng))) <= {0.0, 1.0}


def test_inclusion_probabilities_are_respected():
    hits = np.zeros(30)
    z = np.column_stack([np.ones(30), np.arange(1, 31.0)])
    p = np.linspace(0.2, 0.8, 30)
    for seed in range(400):
        rng = np.random.default_rng(seed)
        hits += cm.land(cm.flight(p.copy(), z, rng), z, rng)
    assert np.abs(hits / 400 - p).max() < 0.13


def test_hot_source_is_spread(spark):
    df = spark.range(9_000).select(F.col("id").alias("doc_id"), F.lit("w w w").alias("text"), F.lit("hot").alias("source"))
    out = cm.mix(df)
    assert out.agg(F.sum("taken")).first()[0] == 27_000  # one source: its target is its size

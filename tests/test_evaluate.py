import numpy as np
from conftest import SF01, frame
from pyspark.sql import functions as F

from sparkclust.operators import evaluate, kmeans
from sparkclust.plans.inputs import load_E


def _assigned(spark):
    e = load_E(spark, SF01)
    _, seeds = kmeans.first_k_seeds(e, 3)
    a = kmeans.assign_nearest(e, seeds)
    rows = a.orderBy("id").collect()
    x = np.array([r.features for r in rows])
    c = np.array([r.cluster for r in rows])
    ids = np.array([r.id for r in rows])
    return a, x, c, ids


def _brute(x):
    return np.sqrt(((x[:, None, :] - x[None]) ** 2).sum(-1))


def test_dunn_blocks_match_brute_force(spark):
    a, x, c, _ = _assigned(spark)
    d = _brute(x)
    iu = np.triu_indices(len(x), 1)
    same = (c[:, None] == c[None])[iu]
    dd = d[iu]
    for block_rows in (64, 10_000):  # multi-block and single-block paths
        r = evaluate.dunn_parts(a, block_rows=block_rows).first()
        assert np.isclose(r.min_inter, dd[~same].min(), atol=1e-9)
        assert np.isclose(r.max_intra, dd[same].max(), atol=1e-9)


def test_silhouette_blocks_match_brute_force(spark):
    a, x, c, _ = _assigned(spark)
    d = _brute(x)
    s = []
    for i in range(len(x)):
        own = c == c[i]
        n_own = own.sum() - 1
        ai = d[i, own].sum() / n_own if n_own > 0 else 0.0
        bi = min(d[i, c == k].mean() for k in set(c) if k != c[i])
        s.append(0.0 if n_own == 0 else (bi - ai) / max(ai, bi))
    for block_rows in (50, 10_000):
        r = evaluate.silhouette(a, block_rows=block_rows).first()
        assert np.isclose(r.silhouette, np.mean(s), atol=1e-9)


def test_pairwise_summary_blocks(spark):
    a, x, _, ids = _assigned(spark)
    d = _brute(x)
    np.fill_diagonal(d, np.inf)
    near = d.argmin(1)
    got = {r.id: r for r in evaluate.pairwise_summary(a, block_rows=70).collect()}
    full = _brute(x)
    np.fill_diagonal(full, np.nan)
    for i in range(0, len(x), 37):
        r = got[int(ids[i])]
        assert r.nearest_id == ids[near[i]] and np.isclose(r.nearest_dist, d[i, near[i]], atol=1e-9)
        assert np.isclose(r.farthest_dist, np.nanmax(full[i]), atol=1e-9)
        assert np.isclose(r.mean_dist, np.nanmean(full[i]), atol=1e-9)


def test_single_cluster_gives_null(spark):
    df = frame(spark, [(i, [float(i)], 0) for i in range(4)]).withColumn("cluster", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(0))
    assert evaluate.dunn_parts(df).first().dunn is None
    assert evaluate.silhouette(df).first().silhouette is None


def test_relabelling_invariance(spark):
    a, _, _, _ = _assigned(spark)
    from pyspark.sql import functions as F

    b = a.withColumn("cluster", (F.lit(2) - F.col("cluster")).cast("int"))
    assert np.isclose(evaluate.silhouette(a).first().silhouette, evaluate.silhouette(b).first().silhouette)
    assert np.isclose(evaluate.dunn_parts(a).first().dunn, evaluate.dunn_parts(b).first().dunn)


def _clouds(spark, n, copies=0):
    rng = np.random.default_rng(8)
    centres = rng.uniform(-100, 100, (12, 3))
    x = np.vstack([centres[i % 12] + rng.standard_normal(3) for i in range(n)])
    c = np.arange(n) % 12 % 4
    x, c = np.vstack([x, np.repeat(x[:1], copies, axis=0)]), np.concatenate([c, np.repeat(c[:1], copies)])
    rows = [(i, r.tolist(), int(k)) for i, (r, k) in enumerate(zip(x, c))]
    return spark.createDataFrame(rows, "id bigint, features array<double>, cluster int"), x, c


def test_bounds_rule_out_pairs_and_change_no_value(spark):
    df, x, c = _clouds(spark, 600)
    d = _brute(x)
    same = c[:, None] == c[None]
    r = evaluate.dunn_parts(df, block_rows=20).first()
    assert np.isclose(r.min_inter, d[~same].min()) and np.isclose(r.max_intra, d[same].max())
    assert 0 < r.visited < 0.25


def test_copies_of_one_row_count_but_are_one_row_of_the_work(spark):
    df, x, c = _clouds(spark, 120, copies=400)
    d = _brute(x)
    r = evaluate.dunn_parts(df, block_rows=10).first()
    same = c[:, None] == c[None]
    assert np.isclose(r.min_inter, d[~same].min()) and np.isclose(r.max_intra, d[same].max())
    s = []
    for i in range(len(x)):
        a = d[i, c == c[i]].sum() / ((c == c[i]).sum() - 1)
        b = min(d[i, c == k].mean() for k in set(c) - {c[i]})
        s.append((b - a) / max(a, b))
    assert np.isclose(evaluate.silhouette(df, block_rows=16).first().silhouette, np.mean(s))
    per = {r.id: r.s for r in evaluate.silhouette_parts(df, block_rows=16).collect()}
    assert len(per) == len(x) and np.allclose([per[i] for i in range(len(x))], s)
    twins = spark.createDataFrame([(1, [1.0], 0), (2, [1.0], 0), (3, [1.0], 1)], "id bigint, features array<double>, cluster int")
    t = evaluate.dunn_parts(twins).first()
    assert (t.min_inter, t.max_intra, t.dunn) == (0.0, 0.0, None)


def test_rows_without_vector_or_cluster_are_counted_not_scored(spark):
    df, x, c = _clouds(spark, 40)
    more = df.unionByName(spark.createDataFrame([(90, None, 1), (91, [0.0, 0.0, 0.0], None)], df.schema))
    a, b = evaluate.dunn_parts(df).first(), evaluate.dunn_parts(more).first()
    assert (a.min_inter, a.max_intra, a.skipped) == (b.min_inter, b.max_intra, 0) and b.skipped == 2
    assert evaluate.silhouette(more).first().skipped == 2
    nulls = more.select("id", "features")
    assert evaluate.pairwise_summary(nulls).count() == 41


def test_several_labellings_in_one_pass(spark):
    df, x, c = _clouds(spark, 150)
    from pyspark.sql import functions as F

    two = df.withColumn("half", (F.col("id") % 2).cast("int")).withColumn("one", F.lit(7))
    for many, alone in ((evaluate.dunn_many, evaluate.dunn_parts), (evaluate.silhouette_many, evaluate.silhouette)):
        for name, got in zip(("cluster", "half", "one"), many(two, ["cluster", "half", "one"], block_rows=30)):
            want = alone(two, cluster_col=name, block_rows=30).first().asDict()
            for key in set(want) - {"visited"}:
                assert got[key] == want[key] or np.isclose(got[key], want[key])
    assert evaluate.dunn_many(two.limit(0), ["cluster"])[0]["min_inter"] is None
    assert evaluate.silhouette_many(two.limit(0), ["cluster"])[0]["silhouette"] is None


def test_rows_are_sent_to_few_groups_however_many_blocks(spark):
    rng = np.random.default_rng(5)
    df = frame(spark, [(i, rng.normal(size=8).tolist(), i % 3) for i in range(2000)]).withColumnRenamed("label", "cluster")
    s = evaluate._scored(df, ["cluster"], "features")
    balls = evaluate._balls(s, 20)
    fn, group = evaluate._to_pairs(balls, np.ones((len(balls.pivots),) * 2, bool), 8)
    rows = s.rows.select("features", "labels", F.xxhash64("features", "labels").alias("h"))
    sent = rows.mapInArrow(fn, "pair bigint, block bigint, features array<double>, labels array<int>").count()
    s.rows.unpersist()
    assert len(group) >= 100 and sent <= 2000 * 5
    # 2,048 rows a block would send every row 98 times
    assert evaluate._num_owners(200_000, 64, None) == 8
    got = {r.id: r for r in evaluate.pairwise_summary(df).collect()}
    x = np.array([r.features for r in df.orderBy("id").collect()])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    assert [got[i].nearest_id for i in range(2000)] == d.argmin(1).tolist()

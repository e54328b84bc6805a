"""Plan shape: row-wise operators add no shuffle; fits aggregate map-side."""

from conftest import SF01

from sparkclust.operators import decompose, gaussian, kmeans, stats
from sparkclust.plans.inputs import load_E, load_E_nan


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_narrow_operators_have_no_exchange(spark):
    e = load_E(spark, SF01)
    st = stats.fit_column_stats(e, 64)
    z = stats.standardize(e, st)
    m = decompose.svd(z, 64)
    g = gaussian.em_init(load_E(spark, SF01).selectExpr("id", "slice(features, 1, 2) AS features"), 2, "first")
    cases = [
        kmeans.assign_nearest(e, [[0.0] * 64, [1.0] * 64]),
        stats.impute_mean(load_E_nan(spark, SF01), st.mean, count_col="n"),
        z,
        decompose.project(z, m, 10),
        gaussian.em_predict(load_E(spark, SF01).selectExpr("id", "slice(features, 1, 2) AS features"), g),
    ]
    for df in cases:
        assert "Exchange" not in _plan(df)


def test_exact_totals_meet_before_the_exchange(spark):
    from pyspark.sql import functions as F

    parts = spark.createDataFrame([(0, [1, 2])], "k int, v array<bigint>")
    plan = _plan(parts.select("k", F.posexplode("v").alias("pos", "v")).groupBy("k", "pos").agg(F.sum("v").alias("v")))
    assert plan.count("HashAggregate") >= 2 and plan.count("Exchange") == 1


def test_parquet_scan_prunes_columns(spark):
    from sparkclust.plans.inputs import load_L

    plan = _plan(load_L(spark, SF01))
    assert "l_comment" not in plan and "l_shipdate" not in plan
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double>" in plan or "l_orderkey" not in plan

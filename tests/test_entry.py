import math

import pytest
from conftest import SF01

import __spark_entry__ as entry

FAST = ["matrix_shape", "split_exact", "kmeanspp_init", "assign_nearest", "dunn_index", "silhouette",
        "confusion", "classification_metrics", "em_2iter", "singular_values", "covariance_wide", "standardize_columns",
        "lineitem_svd", "lineitem_em", "em_history", "em_predict", "kmeans_predict", "row_id_repeated", "split_repeated_ids",
        "number_text_ids", "matrix_round_trip", "vector_text", "clusters_text", "kmeanspp_many", "evaluate_em_failed"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].correct + rows[0].incorrect == 500


def test_oracle_keys_subset_of_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF01)
    res = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    order = sorted(df.columns)
    a = sorted(tuple(_norm(r[c]) for c in order) for r in df.collect())
    ocols = res.columns
    b = sorted(tuple(_norm(r[ocols.index(c)]) for c in order) for r in res.fetchall())
    assert a == b

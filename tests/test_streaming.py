from conftest import SF01

from sparkclust.operators import kmeans
from sparkclust.plans.inputs import load_E
from sparkclust.sources.matrix import binarize_label, to_matrix
from sparkclust.streaming.scoring import score, start_scoring


def test_stream_scoring_matches_batch(spark, tmp_path):
    e = load_E(spark, SF01)
    model = kmeans.kmeans_fit(e, 3, init="first", max_iter=5)
    schema = spark.read.parquet(f"{SF01}/embeddings.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "embeddings.parquet").parquet(SF01)
    stream = binarize_label(to_matrix(raw))
    q = start_scoring(spark, stream, model, "memory", query_name="scored_stream")
    try:
        q.processAllAvailable()
        got = {r.id: r.cluster for r in spark.sql("SELECT id, cluster FROM scored_stream").collect()}
    finally:
        q.stop()
    want = {r.id: r.cluster for r in score(e, model).collect()}
    assert got == want


def test_a_streaming_query_needs_a_name(spark):
    import pytest

    with pytest.raises(ValueError):
        start_scoring(spark, None, None, "memory", query_name="")

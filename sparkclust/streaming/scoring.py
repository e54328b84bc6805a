"""Scoring a stream of new rows with a fitted model.

The reference scores a holdout file with a fitted model (nearest centroid or
largest posterior).  Both predict operators are narrow projections, so they
apply unchanged to a Structured Streaming DataFrame: no state, no watermark,
no shuffle.  Nothing here is a new operator; it wires the batch predict to a
``readStream`` source and a checkpointed sink.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.gaussian import GaussianMixtureModel, em_predict
from ..operators.kmeans import KMeansModel, assign_nearest
from ..session import checkpoint_dir


def score(df: DataFrame, model, col: str = "features", out: str = "cluster") -> DataFrame:
    """Add ``out`` with the model's cluster for each row (batch or streaming frame)."""
    if isinstance(model, KMeansModel):
        return assign_nearest(df, model.centroids, col, out)
    if isinstance(model, GaussianMixtureModel):
        return em_predict(df, model, col, out)
    raise TypeError("model must be a KMeansModel or a GaussianMixtureModel")


def start_scoring(
    spark: SparkSession,
    stream: DataFrame,
    model,
    sink_format: str,
    query_name: str,
    path: str | None = None,
    col: str = "features",
    output_mode: str = "append",
) -> StreamingQuery:
    """Start a streaming query writing scored rows; progress is checkpointed
    under the session's shared ``spark.checkpoint.dir``, in a folder of the query's
    name: two queries with one name would skip each other's rows."""
    if not query_name:
        raise ValueError("a streaming query needs a name of its own")
    ckpt = os.path.join(checkpoint_dir(spark), f"scoring-{query_name}")
    w = score(stream, model, col).writeStream.format(sink_format).outputMode(output_mode).option("checkpointLocation", ckpt)
    w = w.queryName(query_name)
    return w.start(path) if path else w.start()

"""Singular values, explained variance and principal-component projection.

The SVD of the N x D matrix comes from a QR tree: every task folds its rows into
one D x D triangle (``R`` of the QR factorisation of the triangle so far and the
next rows), triangles are folded in groups of tasks and then all together, and
the singular values and right singular vectors are those of the last ``R``.  Errors
are relative to the largest singular value, not to its square as with a Gram
matrix, so small singular values keep their digits.  Only one triangle reaches
the driver; the N x N ``U`` factor is never formed (the reference computes it and
never reads it).  Projection onto the first K loadings is one matrix product per
Arrow batch, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .moments import ROWS, batch_matrix, row_blocks, vectors
from .stats import feature_dim

#: Groups in which the triangles of the tasks meet before the last fold: balanced up to about a million tasks.
GROUPS = 1024
TRIANGLE = "salt int, n bigint, r array<double>"


@dataclass
class SVDModel:
    n: int
    singular_values: list  # descending
    loadings: list  # D rows, each a loading vector v_k (row k = component k)

    @property
    def dim(self) -> int:
        return len(self.singular_values)

    def explained(self):
        s2 = np.asarray(self.singular_values) ** 2
        tot = s2.sum()
        pct = 100.0 * s2 / tot if tot > 0 else np.zeros_like(s2)
        return pct, np.cumsum(pct)

    def frame(self, spark: SparkSession) -> DataFrame:
        """``(k, singular_value)``; see :func:`explained_variance` for percentages."""
        rows = [(i + 1, float(s)) for i, s in enumerate(self.singular_values)]
        return spark.createDataFrame(rows, "k int, singular_value double")

    def loadings_frame(self, spark: SparkSession, k: int | None = None) -> DataFrame:
        k = self.dim if k is None else k
        return spark.createDataFrame([(i + 1, [float(v) for v in self.loadings[i]]) for i in range(k)], "k int, loading array<double>")


def _fix_sign(v: np.ndarray) -> np.ndarray:
    """Make the largest-magnitude entry of each loading positive (SVD signs are arbitrary)."""
    out = v.copy()
    for j in range(v.shape[1]):
        i = int(np.argmax(np.abs(v[:, j])))
        if v[i, j] < 0:
            out[:, j] = -v[:, j]
    return out


def fold(triangle: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The triangle of the rows so far and ``rows``."""
    return np.linalg.qr(np.vstack((triangle, rows)), mode="r")


def _triangle_batch(salt: int, n: int, triangle: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([salt], pa.int32()), pa.array([n], pa.int64()), pa.array([triangle.ravel().tolist()], pa.list_(pa.float64()))]
    return pa.RecordBatch.from_arrays(columns, names=["salt", "n", "r"])


def _triangles(dim: int, col: str):
    def fn(batches):
        n, r = 0, np.zeros((0, dim))
        for b in batches:
            x = batch_matrix(b, col, dim)
            for rows in row_blocks(x):
                if not np.isfinite(x[rows]).all():
                    raise ValueError("impute missing cells before the decomposition")
                n, r = n + len(x[rows]), fold(r, x[rows])
        if n:
            yield _triangle_batch(TaskContext.get().partitionId() % GROUPS, n, r)

    return fn


def _folded(dim: int):
    def fn(group: pa.Table) -> pa.Table:
        n, r = 0, np.zeros((0, dim))
        for some in group.to_batches(max_chunksize=max(1, ROWS // dim)):
            r = fold(r, np.asarray(some.column("r").flatten()).reshape(-1, dim))
            n += sum(some.column("n").to_pylist())
        return pa.Table.from_batches([_triangle_batch(0, n, r)])

    return fn


def triangle(df: DataFrame, dim: int, col: str = "features") -> tuple[int, np.ndarray]:
    """(rows with a vector, R) with ``R^T R = X^T X``; rows whose vector is NULL are left out."""
    ship_package(df.sparkSession)
    parts = df.select(col).mapInArrow(_triangles(dim, col), TRIANGLE)
    row = parts.groupBy("salt").applyInArrow(_folded(dim), TRIANGLE).groupBy("salt").applyInArrow(_folded(dim), TRIANGLE).first()
    if row is None:
        raise ValueError("empty input")
    return int(row["n"]), np.asarray(row["r"]).reshape(-1, dim)


def svd(df: DataFrame, dim: int | None = None, col: str = "features") -> SVDModel:
    """Singular values (descending) and right singular vectors of the matrix in ``col``."""
    dim = dim if dim is not None else feature_dim(df, col)
    n, r = triangle(df, dim, col)
    square = np.zeros((dim, dim))
    square[: len(r)] = r
    _, s, vt = np.linalg.svd(square)
    vec = _fix_sign(vt.T)
    return SVDModel(n=n, singular_values=[float(v) for v in s], loadings=[list(vec[:, j]) for j in range(dim)])


def explained_variance(sv: DataFrame) -> DataFrame:
    """From ``(k, singular_value)``: % of variance and running total, as window sums.

    The frame holds D rows, so the unpartitioned window is bounded by D.
    """
    s2 = F.col("singular_value") * F.col("singular_value")
    total = Window.partitionBy(F.lit(0))
    run = Window.partitionBy(F.lit(0)).orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pct = F.lit(100.0) * s2 / F.sum(s2).over(total)
    return sv.withColumn("pct_variance", pct).withColumn("cum_pct", F.sum("pct_variance").over(run))


def project(df: DataFrame, model: SVDModel, k: int, col: str = "features", out: str | None = None) -> DataFrame:
    """Scores on the first ``k`` components: ``y_k = z . v_k`` (narrow, no shuffle); NULL vectors stay NULL."""
    if k < 1 or k > model.dim:
        raise ValueError("k must be between 1 and D")
    ship_package(df.sparkSession)
    dim, loadings = model.dim, np.asarray(model.loadings[:k], dtype=np.float64)

    def score(v: pa.Array) -> pa.Array:
        x = batch_matrix(pa.RecordBatch.from_arrays([v], ["f"]), "f", dim)
        # term by term, so that a score does not depend on the rows beside it
        y = np.zeros((len(x), k))
        for j in range(dim):
            y += x[:, j : j + 1] * loadings[:, j]
        return vectors(y, v)

    return df.withColumn(out or col, F.arrow_udf(score, "array<double>")(F.col(col)))

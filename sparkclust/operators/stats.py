"""Column statistics, mean imputation, z-normalisation and covariance.

Fitting takes the exact sums of :mod:`moments` (two scans, partial sums per task);
only ``O(D)`` numbers (or ``O(D^2)`` for covariance) come back to the driver.
Applying a fitted model is a narrow projection with array literals, so it adds
no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vector import _dsql, is_missing, vec_lit
from .moments import BITS, LIMBS, co_moments, column_sums, grid, ratio


# Up to this width element-wise transforms are one code-generated array(...) expression
UNROLL_DIM = 128


def feature_dim(df: DataFrame, col: str = "features") -> int:
    """Width of the feature vectors, read from one row (a LIMIT 1 job)."""
    row = df.select(F.size(col).alias("d")).first()
    if row is None:
        raise ValueError("empty input")
    return int(row["d"])


@dataclass
class ColumnStats:
    n: int
    count: list[int]
    mean: list[float]
    std: list[float]
    nulls: int = 0

    @property
    def dim(self) -> int:
        return len(self.mean)

    @property
    def constant(self) -> list[int]:
        return [i for i, s in enumerate(self.std) if not s > 0]

    def frame(self, spark: SparkSession, names: list[str] | None = None) -> DataFrame:
        rows = [
            (i, names[i] if names else str(i), float(self.mean[i]), float(self.std[i]), int(self.count[i]))
            for i in range(self.dim)
        ]
        return spark.createDataFrame(rows, "pos int, column string, mean double, std double, n bigint")


def fit_column_stats(df: DataFrame, dim: int | None = None, col: str = "features") -> ColumnStats:
    """Per-column mean (ignoring NaN/NULL), population std and count from exact sums; ``n`` counts rows with a vector."""
    dim = dim if dim is not None else feature_dim(df, col)
    g = grid(df, dim, col)
    x, xx = column_sums(df, g, col)
    n, places = g.seen.astype(object), LIMBS * BITS
    mean = ratio(x, n, g.exps - places)
    # n * sum x^2 - (sum x)^2 in whole numbers cannot cancel
    var = ratio(n * xx - x * x, n * n, 2 * (g.exps - places))
    std = np.sqrt(np.nan_to_num(var, nan=0.0))
    return ColumnStats(g.rows, g.seen.tolist(), mean.tolist(), std.tolist(), g.nulls)


def column_means(df: DataFrame, dim: int | None = None, col: str = "features") -> list[float]:
    return fit_column_stats(df, dim, col).mean


def impute_mean(df: DataFrame, means: list[float], col: str = "features", count_col: str | None = None) -> DataFrame:
    """Replace NaN/NULL cells by their column mean (narrow, no shuffle).

    ``count_col`` adds the number of replaced cells per row.
    """
    out = df
    if count_col:
        out = out.withColumn(count_col, F.size(F.filter(F.col(col), is_missing)).cast("int"))
    if len(means) <= UNROLL_DIM:
        c = f"`{col}`"
        cells = [f"IF({c}[{i}] IS NULL OR isnan({c}[{i}]), {_dsql(m)}, {c}[{i}])" for i, m in enumerate(means)]
        return out.withColumn(col, F.when(F.col(col).isNull(), None).otherwise(F.expr("array(" + ", ".join(cells) + ")")))
    return out.withColumn(col, F.zip_with(F.col(col), vec_lit(means), lambda x, m: F.when(is_missing(x), m).otherwise(x)))


def standardize(df: DataFrame, stats: ColumnStats, col: str = "features") -> DataFrame:
    """z = (x - mean) / std with population std; constant columns become 0."""
    inv = [1.0 / s if s > 0 else 0.0 for s in stats.std]
    if stats.dim <= UNROLL_DIM:
        c = f"`{col}`"
        cells = [f"({c}[{i}] - {_dsql(m)}) * {_dsql(v)}" for i, (m, v) in enumerate(zip(stats.mean, inv))]
        return df.withColumn(col, F.when(F.col(col).isNull(), None).otherwise(F.expr("array(" + ", ".join(cells) + ")")))
    return df.withColumn(
        col,
        F.zip_with(
            F.zip_with(F.col(col), vec_lit(stats.mean), lambda x, m: x - m),
            vec_lit(inv),
            lambda c, i: c * i,
        ),
    )


def fit_standardize(df: DataFrame, dim: int | None = None, col: str = "features") -> tuple[DataFrame, ColumnStats]:
    stats = fit_column_stats(df, dim, col)
    return standardize(df, stats, col), stats


def covariance_matrix(df: DataFrame, dim: int, col: str = "features") -> np.ndarray:
    """Population covariance from exact co-moments, each pair over the rows in which both cells are there."""
    return co_moments(df, dim, col).covariance


def covariance(df: DataFrame, names: list[str], col: str = "features") -> DataFrame:
    """``(col_i, col_j, cov)`` of all pairs of the named columns, at any width."""
    return covariance_frame(df.sparkSession, covariance_matrix(df, len(names), col), names)


def covariance_frame(spark: SparkSession, cov: np.ndarray, names: list[str]) -> DataFrame:
    d = cov.shape[0]
    rows = [(names[i], names[j], float(cov[i, j])) for i in range(d) for j in range(d)]
    return spark.createDataFrame(rows, "col_i string, col_j string, cov double")


def column_stats(df: DataFrame, dim: int | None = None, col: str = "features") -> DataFrame:
    """``(pos, mean, std, n)`` frame (population std, NaN/NULL ignored)."""
    st = fit_column_stats(df, dim, col)
    rows = [(i, m if c else None, s if c else None, c) for i, (m, s, c) in enumerate(zip(st.mean, st.std, st.count))]
    return df.sparkSession.createDataFrame(rows, "pos bigint, mean double, std double, n bigint")

"""Column expressions for dense vectors stored as ``ARRAY<DOUBLE>``.

Everything here builds JVM-side Catalyst expressions (higher-order array
functions or plain arithmetic), so the work stays inside Spark's executors and
never round-trips through Python.  Model values (centroids, means, loadings)
enter as array literals: they are K x D numbers at most, so the plan size is
bounded by the model, not by the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Above this many scalar terms a distance is built with higher-order functions
# instead of an unrolled (code-generated) arithmetic tree.
UNROLL_LIMIT = 64


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double_array(c: Column | str) -> Column:
    return col_of(c).cast("array<double>")


def _dsql(v: float) -> str:
    """SQL text of a double that parses back to exactly the same value."""
    v = float(v)
    if math.isfinite(v):
        return repr(v) + "D"
    return "CAST('NaN' AS DOUBLE)" if math.isnan(v) else ("CAST('Infinity' AS DOUBLE)" if v > 0 else "CAST('-Infinity' AS DOUBLE)")


def vec_lit_sql(values: Sequence[float]) -> str:
    return "array(" + ", ".join(_dsql(v) for v in values) + ")"


def vec_lit(values: Sequence[float]) -> Column:
    """An array literal, parsed by Spark in one call (constant-folded to one node)."""
    return F.expr(vec_lit_sql(values))


def mat_lit(rows: Sequence[Sequence[float]]) -> Column:
    return F.expr("array(" + ", ".join(vec_lit_sql(r) for r in rows) + ")")


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def is_missing(x: Column) -> Column:
    return x.isNull() | F.isnan(x)


def vsum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return vsum(F.zip_with(a, b, lambda x, y: x * y))


def sq_dist(a: Column, b: Column) -> Column:
    return vsum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def euclid(a: Column, b: Column) -> Column:
    return F.sqrt(sq_dist(a, b))


def sq_dist_to(a: Column | str, point: Sequence[float]) -> Column:
    """Squared distance from an array column to a fixed point.

    Small dimensionalities are unrolled into one arithmetic tree (whole-stage
    code generation applies); larger ones use ``zip_with`` + ``aggregate``.
    """
    a = col_of(a)
    d = len(point)
    if d <= UNROLL_LIMIT // 4:
        terms = [(a[i] - F.lit(float(p))) * (a[i] - F.lit(float(p))) for i, p in enumerate(point)]
        acc = terms[0]
        for t in terms[1:]:
            acc = acc + t
        return acc
    return sq_dist(a, vec_lit(point))


def dist_to(a: Column | str, point: Sequence[float]) -> Column:
    return F.sqrt(sq_dist_to(a, point))


def dists_to(a: Column | str, points: Sequence[Sequence[float]]) -> Column:
    """``ARRAY<DOUBLE>`` of Euclidean distances from ``a`` to each point."""
    a = col_of(a)
    k, d = len(points), len(points[0])
    if k * d <= UNROLL_LIMIT:
        return F.array(*[dist_to(a, p) for p in points])
    return F.transform(mat_lit(points), lambda c: F.sqrt(sq_dist(a, c)))


def argmin(arr: Column) -> Column:
    """0-based position of the smallest element; ties go to the lowest index."""
    return (F.array_position(arr, F.array_min(arr)) - 1).cast("int")


def argmax(arr: Column) -> Column:
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def logsumexp(arr: Column) -> Column:
    m = F.array_max(arr)
    s = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + F.exp(x - m))
    return F.when(m == float("-inf"), m).otherwise(m + F.log(s))


# Fixed values of the reproducible draw shared with the SQL oracle:
# u = (integer of the first 13 hex digits of md5("seed|step|id") + 0.5) / 2^52
DRAW_HEX_DIGITS = 13
DRAW_BITS = 4 * DRAW_HEX_DIGITS
DRAW_SCALE = float(1 << DRAW_BITS)


def draw_int(seed: int, step: int, id_col: Column | str) -> Column:
    """Deterministic draw of ``DRAW_BITS`` bits per row, independent of partitioning."""
    key = F.concat_ws("|", F.lit(str(int(seed))), F.lit(str(int(step))), col_of(id_col).cast("string"))
    return F.conv(F.substring(F.md5(key), 1, DRAW_HEX_DIGITS), 16, 10).cast("bigint")


def draw_u(seed: int, step: int, id_col: Column | str) -> Column:
    """The draw as a uniform number in (0, 1)."""
    return (draw_int(seed, step, id_col).cast("double") + F.lit(0.5)) / F.lit(DRAW_SCALE)

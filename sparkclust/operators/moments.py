"""Sums that are the same bits under any partitioning, and what follows from them.

Floating-point sums depend on their order, and Spark fixes no order.  Here a
first scan finds the largest magnitude of every column (a maximum needs no
order).  It fixes a grid per column: every value is cut into ``LIMBS`` whole
numbers of ``BITS`` bits, which stand for it to ``LIMBS * BITS`` = 60 binary places
below the column's largest value.  Products of two limbs, summed over ``ROWS`` rows,
stay below 2**53, so matrix products of limbs are exact in any order; they are
added up as 64-bit integers, in tasks and then by one ``groupBy(position).sum``
whose partial results meet before the exchange.  The totals are exact integers,
so counts, sums and co-moments merge by addition, whatever the cells, the width
or the number of tasks, and means and covariances are rounded once, at the end.

Rows whose vector is NULL are left out and counted in ``nulls``; NULL and NaN cells
are missing cells: they are left out of every sum that needs them, at any width.
Infinite cells raise.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

BITS = 20
LIMBS = 3
#: Rows of a block: two limbs and these rows need 2 * 20 + 13 = 53 bits.
ROWS = 8192
#: Totals travel as two 64-bit numbers: whole multiples of 2**CARRY and the rest.
CARRY = 30

PARTS = "k int, v array<bigint>"


def num_partitions(df: DataFrame) -> int:
    try:
        return max(1, df.rdd.getNumPartitions())
    except Exception:  # pragma: no cover - e.g. Spark Connect
        return 8


def spread(df: DataFrame) -> DataFrame:
    """Repartition by row hash when the input has fewer partitions than task slots.

    Only matters for inputs stored as a few large files (one Parquet row group
    is one scan task); at cluster scale inputs already have far more
    partitions than slots and this is a no-op.  Call it on scan-level frames:
    the partition count of a plan with an exchange is only known after the
    exchange has run.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if num_partitions(df) >= slots:
        return df
    # hash of the row: deterministic on retry without the local sort that a
    # round-robin repartition needs
    return df.repartition(slots, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))


def iterative_input(df: DataFrame) -> DataFrame:
    """Input of a multi-pass fit: spread over the task slots and persisted
    (MEMORY_AND_DISK; lost blocks are recomputed from the one-scan lineage)."""
    return spread(df).persist(StorageLevel.MEMORY_AND_DISK)


# --- rows of a batch -----------------------------------------------------------


#: Bytes of a packed block: small ones keep the batches that Spark cuts by rows small too.
PACKED_BYTES = 8192


def packed(df: DataFrame, dim: int, col: str = "features") -> DataFrame:
    """The vectors of ``df`` as blocks of bytes, which passes read without a conversion per row."""
    ship_package(df.sparkSession)
    step = max(1, PACKED_BYTES // (8 * dim))

    def fn(batches):
        for b in batches:
            x = batch_matrix(b, col, dim)
            yield pa.RecordBatch.from_arrays([pa.array([x[at : at + step].tobytes() for at in range(0, len(x), step)], pa.binary())], names=[col])

    return df.select(col).mapInArrow(fn, f"`{col}` binary")


def batch_matrix(batch: pa.RecordBatch, col: str, dim: int) -> np.ndarray:
    """Dense ``n x dim`` matrix of the rows that have a vector (or of packed rows); missing cells are NaN."""
    arr = batch.column(batch.schema.get_field_index(col))
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type):
        offsets = np.frombuffer(arr.buffers()[1], np.int32 if pa.types.is_binary(arr.type) else np.int64)[arr.offset : arr.offset + len(arr) + 1]
        lo, hi = (int(offsets[0]), int(offsets[-1])) if len(arr) else (0, 0)
        return np.frombuffer(arr.buffers()[2], np.float64, (hi - lo) // 8, lo).reshape(-1, dim) if hi > lo else np.empty((0, dim))
    x = np.asarray(arr.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    n = len(arr) - arr.null_count
    if x.size != n * dim:
        raise ValueError(f"feature vectors must all have length {dim}")
    return x.reshape(n, dim)


def vectors(y: np.ndarray, like: pa.Array) -> pa.Array:
    """Rows of ``y`` as lists, NULL where ``like`` is."""
    there = np.asarray(like.is_valid())
    ends = np.concatenate(([0], np.cumsum(there))) * y.shape[1]
    mask = None if there.all() else pa.array(~there)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(y.ravel(), pa.float64()), mask=mask)


def row_blocks(x: np.ndarray) -> Iterator[slice]:
    for at in range(0, len(x), ROWS):
        yield slice(at, at + ROWS)


def columns(x: np.ndarray) -> Iterator[np.ndarray]:
    """``x`` transposed in blocks whose columns are contiguous, of at most ``ROWS`` rows and a size that caches hold."""
    step = min(ROWS, max(512, 32_768 // x.shape[1]))
    for at in range(0, len(x), step):
        yield np.ascontiguousarray(x[at : at + step].T)


def limbs(x: np.ndarray, exps: np.ndarray) -> np.ndarray:
    """Whole numbers ``q_s`` (|q_s| <= 2**20) with ``x = sum q_s * 2**(exps - 20 s)`` to 60 places."""
    places = BITS - np.asarray(exps)
    # a power of two that is a normal number scales as ldexp does
    rest = x * np.ldexp(1.0, places) if np.abs(places).max(initial=0) < 1000 else np.ldexp(x, places)
    out = np.empty((LIMBS, *rest.shape))
    for i in range(LIMBS):
        np.rint(rest, out=out[i])
        if i + 1 < LIMBS:
            rest -= out[i]
            rest *= float(1 << BITS)
    return out


def limb_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``LIMBS x rows of a x rows of b``: products of limbs of whole columns, added up by their weight."""
    out = np.zeros((LIMBS, a.shape[1], b.shape[1]), np.int64)
    for i in range(LIMBS):
        some = b[: LIMBS - i].reshape(-1, b.shape[2])
        out[i:] += (a[i] @ some.T).astype(np.int64).reshape(a.shape[1], LIMBS - i, -1).transpose(1, 0, 2)
    return out


# --- exact totals --------------------------------------------------------------


class Sums:
    """Named integer totals of one task."""

    def __init__(self, shapes: dict[str, tuple]):
        self.high = {name: np.zeros(shape, np.int64) for name, shape in shapes.items()}
        self.low = {name: np.zeros(shape, np.int64) for name, shape in shapes.items()}

    def add(self, name: str, values, at=...) -> None:
        """Adds whole numbers below 2**53."""
        v = np.asarray(values).astype(np.int64)
        self.high[name][at] += v >> CARRY
        self.low[name][at] += v & ((1 << CARRY) - 1)

    def vector(self) -> list[int]:
        high = np.concatenate([a.ravel() for a in self.high.values()])
        low = np.concatenate([a.ravel() for a in self.low.values()])
        return np.concatenate((high + (low >> CARRY), low & ((1 << CARRY) - 1))).tolist()


def part_rows(parts: dict[int, Sums]) -> Iterator[pa.RecordBatch]:
    """The totals of a task as rows (k, v)."""
    if parts:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(parts), pa.int32()), pa.array([s.vector() for s in parts.values()], pa.list_(pa.int64()))], names=["k", "v"]
        )


def total(df: DataFrame, fn: Callable, shapes: dict[str, tuple]) -> dict[int, dict[str, np.ndarray]]:
    """Runs ``fn`` on the batches of every task and adds up its rows: arrays of Python integers by k and name."""
    ship_package(df.sparkSession)
    parts = df.mapInArrow(fn, PARTS)
    summed = parts.select("k", F.posexplode("v").alias("pos", "v")).groupBy("k", "pos").agg(F.sum("v").alias("v")).toArrow()
    size = sum(math.prod(s) for s in shapes.values())
    k, pos, v = (summed.column(c).to_numpy() for c in ("k", "pos", "v"))
    out = {}
    for one in np.unique(k):
        mine = k == one
        flat = np.zeros(2 * size, object)
        flat[pos[mine]] = v[mine].astype(object)
        whole, at, named = flat[:size] * (1 << CARRY) + flat[size:], 0, {}
        for name, shape in shapes.items():
            n = math.prod(shape)
            named[name] = whole[at : at + n].reshape(shape)
            at += n
        out[int(one)] = named
    return out


def joined(weights: np.ndarray) -> np.ndarray:
    """One integer per cell from the totals of its limb weights (first axis, largest first)."""
    out = weights[0]
    for w in weights[1:]:
        out = out * (1 << BITS) + w
    return out


def rounded(whole, exps) -> np.ndarray:
    """``whole * 2**exps`` as the nearest doubles."""
    whole, exps = np.broadcast_arrays(np.asarray(whole, object), exps)
    return np.array([math.ldexp(float(a), int(e)) for a, e in zip(whole.ravel(), exps.ravel())]).reshape(whole.shape)


def ratio(top, bottom, exps) -> np.ndarray:
    """``top / bottom * 2**exps``, each quotient of integers rounded once; NaN where ``bottom`` is 0."""
    top, bottom, exps = np.broadcast_arrays(np.asarray(top, object), np.asarray(bottom, object), exps)
    cells = (math.ldexp(a / b, int(e)) if b else math.nan for a, b, e in zip(top.ravel(), bottom.ravel(), exps.ravel()))
    return np.array(list(cells)).reshape(top.shape)


# --- grid and column sums --------------------------------------------------------


@dataclass
class Grid:
    """What the first scan finds: rows with and without a vector, cells seen and binary exponent per column."""

    rows: int
    nulls: int
    seen: np.ndarray
    exps: np.ndarray

    @property
    def dim(self) -> int:
        return len(self.seen)

    @property
    def complete(self) -> bool:
        return bool((self.seen == self.rows).all())


def grid(df: DataFrame, dim: int, col: str = "features") -> Grid:
    """One scan: rows, NULL vectors, cells seen and the power of two above every column's largest magnitude."""
    ship_package(df.sparkSession)

    def fn(batches):
        rows = nulls = 0
        seen, top = np.zeros(dim, np.int64), np.zeros(dim)
        for b in batches:
            nulls += b.column(0).null_count
            x = batch_matrix(b, col, dim)
            rows += len(x)
            if len(x):
                missing = np.isnan(x)
                seen += len(x) - missing.sum(0)
                top = np.maximum(top, np.where(missing, 0.0, np.abs(x)).max(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-2, dim), pa.int32()), pa.array([rows, nulls, *seen.tolist()], pa.int64()), pa.array([0.0, 0.0, *top.tolist()])],
            names=["pos", "n", "top"],
        )

    found = df.select(col).mapInArrow(fn, "pos int, n bigint, top double").groupBy("pos").agg(F.sum("n").alias("n"), F.max("top").alias("top"))
    by = {r["pos"]: (int(r["n"]), float(r["top"])) for r in found.collect()}
    if not by or by[-2][0] == 0:
        raise ValueError("empty input")
    top = np.array([by[i][1] for i in range(dim)])
    if not np.isfinite(top).all():
        raise ValueError("infinite cells")
    return Grid(by[-2][0], by[-1][0], np.array([by[i][0] for i in range(dim)]), np.frexp(top)[1])


def column_sums(df: DataFrame, g: Grid, col: str = "features") -> tuple[np.ndarray, np.ndarray]:
    """Exact ``sum x`` (times 2**(60 - exps)) and ``sum x**2`` (times 2**(120 - 2 exps)) of the cells seen."""
    dim, exps = g.dim, g.exps
    shapes = {"x": (LIMBS, dim), "xx": (2 * LIMBS - 1, dim)}

    def fn(batches):
        s, some = Sums(shapes), False
        for b in batches:
            x = batch_matrix(b, col, dim)
            for rows in row_blocks(x):
                some = True
                q = limbs(np.nan_to_num(x[rows], nan=0.0), exps)
                for i in range(LIMBS):
                    s.add("x", q[i].sum(0), i)
                    for j in range(i, LIMBS):
                        s.add("xx", (q[i] * q[j]).sum(0) * (1 if i == j else 2), i + j)
        yield from part_rows({0: s} if some else {})

    got = total(df.select(col), fn, shapes)[0]
    return joined(got["x"]), joined(got["xx"])


# --- co-moments --------------------------------------------------------------------


@dataclass
class CoMoments:
    """Exact counts, sums and products of columns over the rows in which both cells are there."""

    grid: Grid
    n: np.ndarray  # (D, D) rows with both cells
    s: np.ndarray  # (D, D) sum of column i over those rows, times 2**(60 - exps[i])
    g: np.ndarray  # (D, D) sum of products, times 2**(120 - exps[i] - exps[j])

    @property
    def mean(self) -> np.ndarray:
        """Of every column over its own cells."""
        return ratio(np.diagonal(self.s), np.diagonal(self.n), self.grid.exps - LIMBS * BITS)

    @property
    def covariance(self) -> np.ndarray:
        """Population covariance of every pair over the rows in which both cells are there (NaN if there are none)."""
        e = self.grid.exps
        return ratio(self.n * self.g - self.s * self.s.T, self.n * self.n, e[:, None] + e[None, :] - 2 * LIMBS * BITS)

    @property
    def gram(self) -> np.ndarray:
        e = self.grid.exps
        return rounded(self.g, e[:, None] + e[None, :] - 2 * LIMBS * BITS)


def _square(upper: np.ndarray, dim: int) -> np.ndarray:
    out = np.zeros((dim, dim), object)
    i, j = np.triu_indices(dim)
    out[i, j] = out[j, i] = upper
    return out


def co_shapes(dim: int, complete: bool) -> dict[str, tuple]:
    pairs = dim * (dim + 1) // 2
    shapes = {"n": (1,), "x": (LIMBS, dim), "g": (2 * LIMBS - 1, pairs)}
    return shapes if complete else shapes | {"both": (pairs,), "pair": (LIMBS, dim, dim)}


def add_rows(s: Sums, x: np.ndarray, exps: np.ndarray, complete: bool) -> None:
    """Adds the co-moments of at most ``ROWS`` rows."""
    upper = np.triu_indices(x.shape[1])
    s.add("n", len(x), 0)
    q = limbs(np.nan_to_num(x, nan=0.0), exps)
    if not complete:
        there = (~np.isnan(x)).astype(np.float64)
        s.add("both", (there.T @ there)[upper])
    for i in range(LIMBS):
        s.add("x", q[i].sum(0), i)
        if not complete:
            s.add("pair", q[i].T @ there, i)
        for j in range(i, LIMBS):
            p = q[i].T @ q[j]
            s.add("g", (p if i == j else p + p.T)[upper], i + j)


def co_moments_of(got: dict[str, np.ndarray], g: Grid) -> CoMoments:
    dim = g.dim
    products = _square(joined(got["g"]), dim)
    if g.complete:
        n = np.full((dim, dim), int(got["n"][0]), object)
        s = np.repeat(joined(got["x"])[:, None], dim, axis=1)
    else:
        n, s = _square(got["both"], dim), joined(got["pair"])
    return CoMoments(g, n, s, products)


def co_moments(df: DataFrame, dim: int, col: str = "features") -> CoMoments:
    """Two scans: the grid, then exact sums of products of all column pairs."""
    g = grid(df, dim, col)
    shapes, exps, complete = co_shapes(dim, g.complete), g.exps, g.complete

    def fn(batches):
        s, some = Sums(shapes), False
        for b in batches:
            x = batch_matrix(b, col, dim)
            for rows in row_blocks(x):
                some = True
                add_rows(s, x[rows], exps, complete)
        yield from part_rows({0: s} if some else {})

    return co_moments_of(total(df.select(col), fn, shapes)[0], g)


def group_co_moments(df: DataFrame, dim: int, group: str, col: str = "features") -> dict[int, CoMoments]:
    """Co-moments by the integer column ``group`` (rows without a group are left out)."""
    g = grid(df.where(F.col(group).isNotNull()), dim, col)
    shapes, exps, complete = co_shapes(dim, g.complete), g.exps, g.complete

    def fn(batches):
        parts: dict[int, Sums] = {}
        for b in batches:
            b = b.filter(b.column(1).is_valid())
            x, group_of = batch_matrix(b, col, dim), b.column(0).to_numpy()
            for one in np.unique(group_of):
                mine = x[group_of == one]
                for rows in row_blocks(mine):
                    add_rows(parts.setdefault(int(one), Sums(shapes)), mine[rows], exps, complete)
        yield from part_rows(parts)

    rows = df.select(F.col(group).cast("int").alias("_group"), col).where(F.col("_group").isNotNull())
    return {k: co_moments_of(got, g) for k, got in total(rows, fn, shapes).items()}

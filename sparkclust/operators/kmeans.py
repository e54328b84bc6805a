"""K-means: K-means++ seeding, Lloyd iterations, assignment of new rows.

* ``assign_nearest`` is a narrow projection: distances to K literal centroids,
  arg-min with ties to the lowest cluster id.  No join, no shuffle.
* One Lloyd iteration is ONE Spark job for any width and any number of models: a
  ``mapInArrow`` pass with the same distances bit for bit, exact per-cluster sums
  per task (:mod:`moments`) and one aggregate of them, whatever the cluster sizes
  (a cluster holding a third of the rows costs nothing extra).
* Seeding is K small jobs, each a scan + ``min_by``.  For small K the running
  minimum distance is recomputed from the chosen seeds (literals); for larger K a
  ``min_d`` column is carried with periodic reliable checkpoints.
* The input is persisted (MEMORY_AND_DISK) for the loop, as packed blocks of
  numbers, which no pass converts row by row; lost blocks are recomputed from the
  source by lineage, which stays one scan deep.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vector import argmin, dist_to, dists_to
from ..session import cut_lineage
from .moments import BITS, LIMBS, Grid, Sums, batch_matrix, columns, grid, joined, limbs, packed, part_rows, ratio, row_blocks, spread, total
from .sampling import uniform_pick, weighted_pick
from .stats import feature_dim


def assign_nearest(df: DataFrame, centroids, col: str = "features", out: str = "cluster") -> DataFrame:
    """Add ``out`` = index of the nearest centroid (Euclidean; ties -> lowest index)."""
    return df.withColumn(out, argmin(dists_to(col, [list(map(float, c)) for c in centroids])))


def min_dist_to(col: str, points) -> F.Column:
    """Distance from each row to the nearest of ``points`` (running minimum over chosen seeds)."""
    ds = [dist_to(col, p) for p in points]
    return ds[0] if len(ds) == 1 else F.least(*ds)


def first_k_seeds(df: DataFrame, k: int, id_col: str = "id", col: str = "features"):
    """The K rows with the lowest id as seeds (deterministic test seeding)."""
    rows = df.select(id_col, col).orderBy(id_col).limit(k).collect()
    if len(rows) < k:
        raise ValueError("fewer rows than k")
    return [r[id_col] for r in rows], [list(map(float, r[col])) for r in rows]


# Up to this many seeds the running minimum distance is recomputed from the
# chosen seeds (literals, no state); beyond it a min_d column is carried.
RECOMPUTE_SEEDS = 8
# with a carried min_d column, cut the lineage every this many seeds
CHECKPOINT_EVERY = 8


def kmeanspp_init(
    df: DataFrame,
    k: int,
    seed: int = 42,
    power: float = 1.0,
    col: str = "features",
    id_col: str = "id",
):
    """K-means++ seeding.

    The first seed is the row with the smallest draw ``u(seed, 0, id)``.  Seed
    ``s`` is drawn with weight ``d^power`` where ``d`` is the distance to the
    nearest chosen seed (``power=1`` is what the reference programs run,
    ``power=2`` the textbook rule).  Raises ``ValueError`` when fewer than K
    distinct points exist.  Returns ``(ids, centroids)``.

    Each step is one scan + top-1.  For small K the nearest-seed distance is
    recomputed from the chosen seeds; for larger K a ``min_d`` column is
    carried from step to step (``least(min_d, dist_to_new_seed)``, O(K) work
    per row in total) and the lineage is cut with a reliable checkpoint into
    ``spark.checkpoint.dir`` every ``CHECKPOINT_EVERY`` seeds.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    base = df.select(id_col, col)
    first = uniform_pick(base, seed, 0, id_col).first()
    if first is None:
        raise ValueError("empty input")
    ids = [first[id_col]]
    cents = [list(map(float, first[col]))]
    carried = prev = None
    try:
        for s in range(1, k):
            if k <= RECOMPUTE_SEEDS:
                src, d = base, min_dist_to(col, cents)
            else:
                step = dist_to(col, cents[-1])
                prev = carried
                nxt = (base.withColumn("min_d", step) if prev is None
                       else prev.withColumn("min_d", F.least(F.col("min_d"), step)))
                if s % CHECKPOINT_EVERY == 0:
                    carried = cut_lineage(nxt)
                else:
                    carried = nxt.persist(StorageLevel.MEMORY_AND_DISK)
                src, d = carried, F.col("min_d")
            w = d if power == 1 else F.pow(d, F.lit(float(power)))
            pick = weighted_pick(src, w, seed, s, id_col).first()  # also fills the new cache
            if k > RECOMPUTE_SEEDS and prev is not None:
                prev.unpersist()
            if pick is None or pick["race_key"] is None:
                raise ValueError(f"fewer than k={k} distinct points")
            ids.append(pick[id_col])
            cents.append(list(map(float, pick[col])))
    finally:
        if carried is not None:
            carried.unpersist()
    return ids, cents


def distances(x: np.ndarray, points) -> np.ndarray:
    """``n x K`` Euclidean distances, coordinate by coordinate as the column expressions add them: the same bits."""
    out = np.empty((len(x), len(points)))
    for k, d in enumerate(column_distances(np.ascontiguousarray(x.T), points)):
        out[:, k] = d
    return out


def column_distances(columns: np.ndarray, points) -> Iterator[np.ndarray]:
    """The distances to each point in turn, of rows that are given by their columns."""
    d = np.empty(columns.shape[1])
    for point in points:
        acc = np.zeros(columns.shape[1])
        for c, v in zip(columns, point):
            np.subtract(c, v, out=d)
            d *= d
            acc += d
        yield np.sqrt(acc, out=acc)


def nearest_of(columns: np.ndarray, points) -> np.ndarray:
    """As :func:`nearest`, of rows that are given by their columns."""
    best, at = np.full(columns.shape[1], np.inf), np.zeros(columns.shape[1], np.int64)
    for k, d in enumerate(column_distances(columns, points)):
        at[d < best] = k
        np.minimum(best, d, out=best)
    return at


def nearest(x: np.ndarray, points) -> np.ndarray:
    """Index of the nearest point (ties -> lowest index), as :func:`assign_nearest` gives it."""
    return np.argmin(distances(x, points), axis=1)


def _group_sums(df: DataFrame, dim: int, group: str, col: str) -> dict[int, tuple[int, np.ndarray]]:
    """(rows, mean) of every group from exact sums."""
    g = grid(df.where(F.col(group).isNotNull()), dim, col)
    if not g.complete:
        raise ValueError("impute missing cells before averaging clusters")
    shapes, exps = {"n": (1,), "x": (LIMBS, dim)}, g.exps

    def fn(batches):
        parts: dict[int, Sums] = {}
        for b in batches:
            b = b.filter(b.column(1).is_valid())
            x, group_of = batch_matrix(b, col, dim), b.column(0).to_numpy()
            for one in np.unique(group_of):
                mine = x[group_of == one]
                s = parts.setdefault(int(one), Sums(shapes))
                for rows in row_blocks(mine):
                    s.add("n", len(mine[rows]), 0)
                    for i, q in enumerate(limbs(mine[rows], exps)):
                        s.add("x", q.sum(0), i)
        yield from part_rows(parts)

    rows = df.select(F.col(group).cast("int").alias("_group"), col).where(F.col("_group").isNotNull())
    found = total(rows, fn, shapes)
    return {k: (int(t["n"][0]), ratio(joined(t["x"]), t["n"][0], exps - LIMBS * BITS)) for k, t in found.items()}


def cluster_means_frame(assigned: DataFrame, dim: int, col: str = "features", cluster_col: str = "cluster") -> DataFrame:
    """``(cluster, n, mean ARRAY<DOUBLE>)`` of the clusters that have rows with a vector; exact sums, rounded once."""
    found = _group_sums(assigned, dim, cluster_col, col)
    rows = [(k, n, mean.tolist()) for k, (n, mean) in sorted(found.items())]
    return assigned.sparkSession.createDataFrame(rows, f"{cluster_col} int, n bigint, mean array<double>")


def fit_grid(df: DataFrame, dim: int, col: str = "features") -> Grid:
    """The grid of a fit's input; missing cells raise."""
    g = grid(df, dim, col)
    if not g.complete:
        raise ValueError("impute missing cells before fitting")
    return g


def lloyd_pass(df: DataFrame, models: list, g: Grid, col: str = "features") -> list[tuple[list, list[int]]]:
    """One scan for any number of models: (new centroids, counts) of each.

    Sums are exact, so the new centroids are the same bits under any
    partitioning.  The exchange carries the sums of every task, however large a
    cluster is.  A cluster that receives no rows keeps its old centroid and id.
    """
    dim, exps, width = g.dim, g.exps, max(len(m) for m in models)
    shapes = {"n": (width,), "x": (LIMBS, width, dim)}
    points = [np.asarray(m, dtype=np.float64) for m in models]

    def fn(batches):
        parts: dict[int, Sums] = {}
        for b in batches:
            for x in columns(batch_matrix(b, col, dim)):
                q = limbs(x, exps[:, None]).reshape(LIMBS * dim, -1)
                for m, centers in enumerate(points):
                    mine = (nearest_of(x, centers) == np.arange(width)[:, None]).astype(np.float64)
                    s = parts.setdefault(m, Sums(shapes))
                    s.add("n", mine.sum(1))
                    s.add("x", (mine @ q.T).reshape(width, LIMBS, dim).transpose(1, 0, 2))
        yield from part_rows(parts)

    found, out = total(df.select(col), fn, shapes), []
    for m, old in enumerate(models):
        counts = [int(c) for c in found[m]["n"][: len(old)]]
        means = ratio(joined(found[m]["x"]), found[m]["n"][:, None], exps - LIMBS * BITS)
        out.append(([means[k].tolist() if counts[k] else list(c) for k, c in enumerate(old)], counts))
    return out


def lloyd_update(df: DataFrame, centroids, dim: int, col: str = "features", g: Grid | None = None):
    """Assign to ``centroids`` and return (new centroids, counts)."""
    return lloyd_pass(df, [centroids], g or fit_grid(df, dim, col), col)[0]


def settled(moves: list[float], tol: float) -> int | None:
    """Number of counted passes if the fit is over after these movements, else None."""
    if not moves:
        return None
    if moves[-1] == (moves[-2] if len(moves) > 1 else 0.0):
        return len(moves) - 1
    return len(moves) if moves[-1] <= tol else None


def total_shift(old, new) -> float:
    return float(sum(np.sqrt(np.sum((np.asarray(a) - np.asarray(b)) ** 2)) for a, b in zip(old, new)))


@dataclass
class KMeansModel:
    centroids: list
    iterations: int
    history: list = field(default_factory=list)  # (iteration, total_shift)
    counts: list = field(default_factory=list)
    seed_ids: list = field(default_factory=list)
    converged: bool = True

    @property
    def k(self) -> int:
        return len(self.centroids)

    def transform(self, df: DataFrame, col: str = "features", out: str = "cluster") -> DataFrame:
        return assign_nearest(df, self.centroids, col, out)

    def centroids_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, [float(v) for v in c], int(self.counts[i]) if self.counts else None) for i, c in enumerate(self.centroids)]
        return spark.createDataFrame(rows, "cluster int, centroid array<double>, n bigint")

    def history_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(int(i), float(s)) for i, s in self.history], "iteration int, total_shift double")


def kmeans_fit(
    df: DataFrame,
    k: int,
    init: str | list = "k-means++",
    seed: int = 42,
    power: float = 1.0,
    tol: float = 0.005,
    max_iter: int | None = None,
    col: str = "features",
    id_col: str = "id",
    persist: bool = True,
) -> KMeansModel:
    """Lloyd's algorithm with the reference stop rule.

    Stop when the summed centroid movement is <= ``tol``, when it equals the
    previous movement exactly (that pass is not counted; the first pass is
    compared with 0).  Movements are the same bits under any partitioning.  There
    is no limit unless ``max_iter`` gives one; a fit that it ends has
    ``converged`` False.  Missing cells raise.
    ``init``: ``"k-means++"``, ``"first"`` (lowest ids) or a list of centroids.
    """
    return kmeans_fit_many(df, [k], init, seed, power, tol, max_iter, col, id_col, persist)[0]


def kmeans_fit_many(
    df: DataFrame,
    ks: list[int],
    init: str | list = "k-means++",
    seed: int = 42,
    power: float = 1.0,
    tol: float = 0.005,
    max_iter: int | None = None,
    col: str = "features",
    id_col: str = "id",
    persist: bool = True,
) -> list[KMeansModel]:
    """The fits of all ``ks`` side by side: each scan updates every model that has not settled.

    Both seedings choose the seeds of a smaller k first, so one seeding serves all.
    """
    if min(ks) < 1:
        raise ValueError("k must be >= 1")
    # rows without a feature vector cannot be assigned; impute NaN cells beforehand
    data = df.select(id_col, col).where(F.col(col).isNotNull())
    held: list[DataFrame] = []
    try:
        if persist:
            data = spread(data)
            if isinstance(init, str):
                held.append(data.persist(StorageLevel.MEMORY_AND_DISK))
        dim = feature_dim(data, col)
        seed_ids: list = []
        if isinstance(init, str):
            if init == "k-means++":
                seed_ids, seeds = kmeanspp_init(data, max(ks), seed, power, col, id_col)
            elif init == "first":
                seed_ids, seeds = first_k_seeds(data, max(ks), id_col, col)
            else:
                raise ValueError(f"unknown init {init!r}")
        else:
            seeds = [list(map(float, c)) for c in init]
            if len(seeds) != max(ks):
                raise ValueError("init must hold k centroids")
        if persist:
            data = packed(data, dim, col).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(data)
        g = fit_grid(data, dim, col)
        for one in held[:-1]:  # only the seeding needs rows; this scan has packed them
            one.unpersist()
        cents = [[list(c) for c in seeds[:k]] for k in ks]
        moves: list[list[float]] = [[] for _ in ks]
        counts: list[list] = [[] for _ in ks]
        while going := [m for m in range(len(ks)) if settled(moves[m], tol) is None and (max_iter is None or len(moves[m]) < max_iter)]:
            for m, (new, n) in zip(going, lloyd_pass(data, [cents[m] for m in going], g, col)):
                moves[m].append(total_shift(cents[m], new))
                cents[m], counts[m] = new, n
        models = []
        for m, k in enumerate(ks):
            counted = settled(moves[m], tol)
            history = list(enumerate(moves[m] if counted is None else moves[m][:counted], start=1))
            models.append(KMeansModel(cents[m], len(history), history, counts[m], seed_ids[:k], converged=counted is not None))
        return models
    finally:
        for one in held:
            one.unpersist()


def kmeans_steps(df: DataFrame, centroids, steps: int, col: str = "features"):
    """Exactly ``steps`` Lloyd updates from ``centroids`` (no stop rule)."""
    g = fit_grid(df, len(centroids[0]), col)
    cents = [list(c) for c in centroids]
    for _ in range(steps):
        cents, _ = lloyd_update(df, cents, g.dim, col, g)
    return cents


def kmeans_predict(df: DataFrame, model: KMeansModel, col: str = "features", out: str = "cluster") -> DataFrame:
    return model.transform(df, col, out)


def cluster_means(df: DataFrame, centroids, col: str = "features") -> DataFrame:
    """Assign to ``centroids`` and return ``(cluster, n, mean)``."""
    return cluster_means_frame(assign_nearest(df, centroids, col), len(centroids[0]), col)


def centroid_shift(df: DataFrame, centroids, col: str = "features"):
    """One Lloyd update from ``centroids``: ``(new centroids, per-cluster shift, total shift)``."""
    new, _ = lloyd_update(df, centroids, len(centroids[0]), col)
    per = [total_shift([a], [b]) for a, b in zip(centroids, new)]
    return new, per, float(sum(per))

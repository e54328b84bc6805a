"""Cluster quality and classification metrics.

The pairwise metrics are exact.

* Equal rows (labels and vector) count once with their number, so copies of a row,
  however many, are one row of the distance work.
* **Dunn index**: every row goes to the nearest of a few pivots; per pivot and
  cluster one aggregate gives the largest and least distance to the pivot.  The
  triangle inequality then bounds every pair of such balls from both sides, and
  only pairs of balls that the bounds cannot rule out are visited, large balls in
  parts of ``block_rows`` rows.  Rows are sent to pairs of groups of such parts, of
  ``HELD_BYTES`` each: up to that size a row is sent to as many pairs as the task
  slots need, however many rows there are.  ``visited`` states the share of row pairs
  whose distance was computed.
* **Silhouette, nearest-neighbour summary**: a task owns a block of rows and streams
  all other rows past it, a batch at a time.  Every row is sent to each owner, so
  blocks are as large as ``HELD_BYTES`` and the task slots allow, and only the
  finished values of the owned rows come out: no partial sums are shuffled.
* Several labellings of the same rows are scored in one pass.

Rows without a vector or label are left out and counted in ``skipped``.  Work grows
with the pairs that are visited; memory per task is that of one block and a batch.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .kmeans import distances
from .moments import batch_matrix

DEFAULT_BLOCK_ROWS = 2048
#: Pivots at most: their distances among each other are one matrix per task.
MAX_PIVOTS = 4096
#: Rows that are compared with a block at once.
STEP = 1024
#: Bounds are loosened by this share, for the rounding of the distances behind them.
SLACK = 1e-9
INF = float("inf")


# --- confusion matrix and metrics -------------------------------------------


def confusion(df: DataFrame, label_col: str = "label", pred_col: str = "cluster") -> DataFrame:
    """``correct, incorrect, tp, tn, fp, fn`` under the reference rule.

    Correct: prediction equals label -> TN if the label is 0, else TP.
    Wrong: FN if the label is 1, otherwise FP (so label 0 / cluster 2 is FP).
    A NULL label or prediction equals nothing, so that every row is counted.
    """
    lab, pred = F.col(label_col), F.col(pred_col)
    eq = F.coalesce(lab == pred, F.lit(False))
    positive = F.coalesce(lab == 1, F.lit(False))
    return df.agg(
        F.count_if(eq).cast("bigint").alias("correct"),
        F.count_if(~eq).cast("bigint").alias("incorrect"),
        F.count_if(eq & (lab != 0)).cast("bigint").alias("tp"),
        F.count_if(eq & (lab == 0)).cast("bigint").alias("tn"),
        F.count_if(~eq & ~positive).cast("bigint").alias("fp"),
        F.count_if(~eq & positive).cast("bigint").alias("fn"),
    )


def confusions(df: DataFrame, pred_cols: list[str], by: str, label_col: str = "label") -> dict[tuple, dict[str, int]]:
    """Confusion counts of several predictions in one pass: {(prediction column, value of ``by``): counts}."""
    lab, counts = F.col(label_col), []
    positive = F.coalesce(lab == 1, F.lit(False))
    for p in pred_cols:
        eq = F.coalesce(lab == F.col(p), F.lit(False))
        rules = {"correct": eq, "incorrect": ~eq, "tp": eq & (lab != 0), "tn": eq & (lab == 0), "fp": ~eq & ~positive, "fn": ~eq & positive}
        counts += [F.count_if(rule).alias(f"{p}:{name}") for name, rule in rules.items()]
    rows = df.groupBy(by).agg(*counts).collect()
    return {(p, r[by]): {c.split(":")[-1]: int(r[c]) for c in r.asDict() if c.startswith(f"{p}:")} for r in rows for p in pred_cols}


def _ratio(num, den):
    """100 * num / den, +inf when den == 0 (ANSI-safe: no division by zero)."""
    return F.when(den == 0, F.lit(INF)).otherwise(F.lit(100.0) * num.cast("double") / den.cast("double"))


def metrics_from_confusion(conf: DataFrame) -> DataFrame:
    """Add accuracy, TPR, PPV, TNR and F1 (percent) with the reference's inf rules."""
    c = F.col
    n = c("correct") + c("incorrect")
    out = conf.select(
        "*",
        F.when(n == 0, F.lit(None).cast("double")).otherwise(F.lit(100.0) * c("correct") / n).alias("accuracy"),
        _ratio(c("tp"), c("tp") + c("fn")).alias("tpr"),
        _ratio(c("tp"), c("tp") + c("fp")).alias("ppv"),
        _ratio(c("tn"), c("tn") + c("fp")).alias("tnr"),
    )
    s = c("ppv") + c("tpr")
    return out.withColumn("f1", F.when(s == 0, F.lit(INF)).otherwise(F.lit(2.0) * c("ppv") * c("tpr") / s))


def classification_metrics(df: DataFrame, label_col: str = "label", pred_col: str = "cluster") -> DataFrame:
    return metrics_from_confusion(confusion(df, label_col, pred_col))


def metrics_report(metrics: DataFrame) -> DataFrame:
    """Long ``(metric, value)`` text rows as printed by the reference programs."""

    def pct(x):
        # Python-style text for the special values: inf, -inf, nan
        txt = (
            F.when(F.isnan(x), F.lit("nan"))
            .when(x == float("inf"), F.lit("inf"))
            .when(x == float("-inf"), F.lit("-inf"))
            .otherwise(F.format_string("%.2f", F.round(x, 2)))
        )
        return F.concat(txt, F.lit("%"))

    rows = [
        ("Accuracy", pct(F.col("accuracy"))),
        ("True Positives", F.col("tp").cast("string")),
        ("True Negatives", F.col("tn").cast("string")),
        ("False Positives", F.col("fp").cast("string")),
        ("False Negatives", F.col("fn").cast("string")),
        ("True Positive Rate (sensitivity)", pct(F.col("tpr"))),
        ("Positive Prediction Value (precision)", pct(F.col("ppv"))),
        ("True Negative Rate (specificity)", pct(F.col("tnr"))),
        ("F1 Score", pct(F.col("f1"))),
    ]
    arr = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(name).alias("metric"), v.alias("value")) for i, (name, v) in enumerate(rows)])
    return metrics.select(F.inline(arr))


# --- rows and blocks -------------------------------------------------------------


@dataclass
class Scored:
    """Distinct rows (features, labels, w) of the labellings, persisted."""

    rows: DataFrame
    n: int
    skipped: int
    distinct: int
    most: int  # copies of the most frequent row
    dim: int
    sizes: list[dict[int, int]]  # per labelling: rows by cluster


def _weighted(df: DataFrame, labels: list[str], col: str) -> DataFrame:
    """Distinct (features, labels) with their number of rows ``w``; summed up before the exchange."""
    there = F.col(col).isNotNull()
    for c in labels:
        there = there & F.col(c).isNotNull()
    rows = df.where(there).select(F.col(col).alias("features"), F.array(*[F.col(c).cast("int") for c in labels]).alias("labels"))
    return rows.groupBy("features", "labels").agg(F.count(F.lit(1)).alias("w"))


def _scored(df: DataFrame, labels: list[str], col: str) -> Scored:
    rows = _weighted(df, labels, col).persist(StorageLevel.MEMORY_AND_DISK)
    cells = rows.select("w", F.size("features").alias("d"), F.posexplode("labels").alias("m", "label"))
    found = cells.groupBy("m", "label").agg(F.sum("w").alias("n"), F.count(F.lit(1)).alias("rows"), F.max("w").alias("most"), F.max("d").alias("d")).collect()
    first = [r for r in found if r["m"] == 0]
    n = sum(r["n"] for r in first)
    sizes = [{r["label"]: r["n"] for r in found if r["m"] == m} for m in range(len(labels))]
    dim = max((r["d"] for r in found), default=0)
    return Scored(rows, n, df.count() - n, sum(r["rows"] for r in first), max((r["most"] for r in found), default=0), dim, sizes)


def _num_blocks(n: int, block_rows: int) -> int:
    """Blocks of about ``block_rows`` rows, and enough block pairs for all task slots."""
    slots = SparkSession.getActiveSession().sparkContext.defaultParallelism
    return max(1, math.ceil(n / max(1, block_rows)), min(n // 2, math.ceil(math.sqrt(6 * slots))))


#: Bytes of the vectors that one task holds at once, and rows of them that meet a batch together.
HELD_BYTES = 1 << 25
TILE = 512


def _num_owners(n: int, dim: int, block_rows: int | None) -> int:
    """Parts of the rows that tasks hold whole: every row is sent to each, so as few as memory and the task slots allow, or of ``block_rows``."""
    if block_rows:
        return _num_blocks(n, block_rows)
    slots = SparkSession.getActiveSession().sparkContext.defaultParallelism
    return max(1, min(n // 2, max(2 * slots, math.ceil(n * 8 * dim / HELD_BYTES))))


def _tiles(n: int) -> Iterator[slice]:
    for at in range(0, n, TILE):
        yield slice(at, at + TILE)


def _dist_matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances; both sides shifted by a common centre.

    Where the squared distance is small against the squared lengths the
    expansion cancels: those pairs are subtracted directly.
    """
    c = np.vstack([a, b]).mean(axis=0) if len(a) + len(b) else 0.0
    a = a - c
    b = b - c
    size = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
    d2 = (2.0 * a) @ b.T
    np.subtract(size, d2, out=d2)
    np.maximum(d2, 0.0, out=d2)
    if d2.min(initial=INF) < 1e-6 * size.max(initial=0.0):
        i, j = np.nonzero(d2 < 1e-6 * size)
        for s in range(0, len(i), 65_536):
            p, q = i[s : s + 65_536], j[s : s + 65_536]
            d2[p, q] = ((a[p] - b[q]) ** 2).sum(1)
    return np.sqrt(d2, out=d2)



def _labels(batch: pa.RecordBatch, models: int) -> np.ndarray:
    return batch.column("labels").flatten().to_numpy().reshape(-1, models)


# --- Dunn index --------------------------------------------------------------------


@dataclass
class Balls:
    """Pivots and, per labelling, cluster and pivot, the range of distances to the pivot and the number of rows."""

    pivots: np.ndarray
    parts: np.ndarray  # blocks of every pivot's rows
    clusters: list[list[int]]
    far: list[np.ndarray]  # (clusters, pivots); -inf where there is no row
    near: list[np.ndarray]
    count: list[np.ndarray]

    def combinations(self, m: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(cluster, cluster, least, largest possible distance by pivot pair)."""
        between = distances(self.pivots, self.pivots)
        for a in range(len(self.clusters[m])):
            for b in range(len(self.clusters[m])):
                reach = self.far[m][a][:, None] + self.far[m][b][None, :]
                there = np.isfinite(reach)
                low = np.where(there, np.maximum(between - reach, 0.0), INF)
                yield a, b, low, np.where(there, between + reach, -INF)

    def best(self, m: int) -> tuple[float, float]:
        """(a distance between clusters that some pair does not pass, one within a cluster that some pair reaches)."""
        between, closest, widest = distances(self.pivots, self.pivots), INF, 0.0
        off = ~np.eye(len(self.pivots), dtype=bool)
        for a in range(len(self.clusters[m])):
            for b in range(len(self.clusters[m])):
                both = np.isfinite(self.near[m][a])[:, None] & np.isfinite(self.near[m][b])[None, :]
                reach = np.where(both, self.near[m][a][:, None] + self.near[m][b][None, :], 0.0)
                if a != b:
                    closest = min(closest, np.where(both, between + reach, INF).min())
                else:
                    widest = max(widest, np.where(both & off, between - reach, 0.0).max())
            inner = self.count[m][a] > 1
            widest = max(widest, float((self.far[m][a][inner] - self.near[m][a][inner]).max(initial=0.0)))
        return closest * (1 + SLACK), widest * (1 - SLACK)

    def open(self) -> list[dict[tuple[int, int], np.ndarray]]:
        """Per labelling, by pair of clusters: the pivot pairs that the bounds cannot rule out."""
        out = []
        for m in range(len(self.clusters)):
            closest, widest = self.best(m)
            out.append({(a, b): (low * (1 - SLACK) <= closest if a != b else (high * (1 + SLACK) >= widest) & (high > -INF)) & np.isfinite(low)
                        for a, b, low, high in self.combinations(m)})
        return out


def _balls(s: Scored, block_rows: int) -> Balls:
    """Pivots are the rows with the least hashes; one pass assigns all rows."""
    blocks = min(MAX_PIVOTS, _num_blocks(s.distinct, block_rows))
    chosen = s.rows.orderBy(F.xxhash64("features", "labels")).limit(blocks).select("features").collect()
    pivots = np.array([r["features"] for r in chosen], dtype=np.float64)
    dim, models = s.dim, len(s.sizes)

    def place(batches):
        for b in batches:
            d = distances(batch_matrix(b, "features", dim), pivots)
            cell = np.argmin(d, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell]), b.column("labels")], names=["cell", "d", "labels"])

    cells = s.rows.select("features", "labels").mapInArrow(place, "cell int, d double, labels array<int>")
    exploded = cells.select("cell", "d", F.posexplode("labels").alias("m", "label"))
    found = exploded.groupBy("cell", "m", "label").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("far"), F.min("d").alias("near")).collect()
    clusters = [sorted(sizes) for sizes in s.sizes]
    shape = [(len(c), len(pivots)) for c in clusters]
    far, near = [np.full(x, -INF) for x in shape], [np.full(x, INF) for x in shape]
    count = [np.zeros(x, np.int64) for x in shape]
    for r in found:
        at = clusters[r["m"]].index(r["label"]), r["cell"]
        far[r["m"]][at], near[r["m"]][at], count[r["m"]][at] = r["far"], r["near"], r["n"]
    parts = np.maximum(1, -(-count[0].sum(0) // block_rows))
    assert models == len(clusters)
    return Balls(pivots, parts, clusters, far, near, count)


def _groups(balls: Balls, dim: int) -> np.ndarray:
    """Group of every block: neighbouring blocks that two tasks' rows may hold, so that a row is sent to few pairs of groups."""
    rows = np.repeat(balls.count[0].sum(0) / balls.parts, balls.parts)
    slots = SparkSession.getActiveSession().sparkContext.defaultParallelism
    groups = max(math.ceil(math.sqrt(6 * slots)), math.ceil(rows.sum() * 8 * dim / HELD_BYTES))
    return np.unique(np.floor((np.cumsum(rows) - rows) / max(rows.sum(), 1) * groups), return_inverse=True)[1]


def _to_pairs(balls: Balls, wanted: np.ndarray, dim: int):
    """Sends every row to the pairs of groups in which a block of its pivot is wanted."""
    pivots, parts = balls.pivots, balls.parts
    first = np.cumsum(parts) - parts
    owner, group = np.repeat(np.arange(len(parts)), parts), _groups(balls, dim)
    groups = int(group.max()) + 1
    # groups that hold a block which the rows of a pivot must meet
    meets = np.zeros((len(parts), groups), bool)
    for one in range(groups):
        meets[:, one] = wanted[:, np.unique(owner[group == one])].any(1)

    def fn(batches):
        for b in batches:
            cell = np.argmin(distances(batch_matrix(b, "features", dim), pivots), axis=1)
            block = first[cell] + np.mod(b.column("h").to_numpy(), parts[cell])
            for one in np.unique(block):
                rows = np.flatnonzero(block == one)
                others = np.flatnonzero(meets[owner[one]])
                pair = np.minimum(others, group[one]) * groups + np.maximum(others, group[one])
                for at in range(0, pair.size, max(1, 100_000 // rows.size)):
                    some = pair[at : at + max(1, 100_000 // rows.size)]
                    take = b.take(pa.array(np.tile(rows, some.size)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(some, rows.size)), pa.array(np.full(len(take), one)), take.column("features"), take.column("labels")],
                        names=["pair", "block", "features", "labels"],
                    )

    return fn, group


PAIR_RESULT = "m int, low double, high double, visited bigint"


def _pair_extremes(balls: Balls, open_: list, wanted: np.ndarray, group: np.ndarray, dim: int):
    """Least distance between clusters and largest within one, over the wanted pairs of blocks of one pair of groups."""
    owner = np.repeat(np.arange(len(balls.parts)), balls.parts)
    models, groups = len(balls.clusters), int(group.max()) + 1
    known = [np.array(c) for c in balls.clusters]

    def fn(rows_of_pair: pa.Table) -> pa.Table:
        left, right = divmod(rows_of_pair.column("pair")[0].as_py(), groups)
        batch = rows_of_pair.combine_chunks().to_batches()[0]
        x, labels, block = batch_matrix(batch, "features", dim), _labels(batch, models), batch.column("block").to_numpy()
        at = [np.searchsorted(known[m], labels[:, m]) for m in range(models)]
        members = {int(b): np.flatnonzero(block == b) for b in np.unique(block)}
        low, high, visited = [INF] * models, [-INF] * models, 0
        for a in members:
            for b in members:
                if group[a] != left or group[b] != right or (left == right and b < a) or not wanted[owner[a], owner[b]]:
                    continue
                use = []
                for m in range(models):
                    table = np.zeros((len(known[m]), len(known[m])), bool)
                    for (i, j), pairs in open_[m].items():
                        table[i, j] = pairs[owner[a], owner[b]]
                    use.append((table, at[m]))
                # rows that stand in an open combination of any labelling
                rows, others = members[a], members[b]
                rows = rows[np.any([t.any(1)[k[rows]] for t, k in use], axis=0)]
                others = others[np.any([t.any(0)[k[others]] for t, k in use], axis=0)]
                for start in range(0, rows.size if others.size else 0, STEP):
                    some = rows[start : start + STEP]
                    d = _dist_matrix(x[some], x[others])
                    valid = some[:, None] < others[None, :] if a == b else np.ones(d.shape, bool)
                    visited += int(valid.sum())
                    for m, (table, k) in enumerate(use):
                        open_here = valid & table[k[some]][:, k[others]]
                        same = k[some][:, None] == k[others][None, :]
                        low[m] = min(low[m], d[open_here & ~same].min(initial=INF))
                        high[m] = max(high[m], d[open_here & same].max(initial=-INF))
        return pa.table({"m": pa.array(range(models), pa.int32()), "low": low, "high": high, "visited": pa.array([visited] * models, pa.int64())})

    return fn


def dunn_many(df: DataFrame, label_cols: list[str], block_rows: int = DEFAULT_BLOCK_ROWS, col: str = "features") -> list[dict]:
    """Per labelling: ``min_inter``, ``max_intra``, ``dunn``, ``visited`` (share of pairs of distinct rows), ``skipped``."""
    ship_package(df.sparkSession)
    s = _scored(df, label_cols, col)
    try:
        out = [{"min_inter": None, "max_intra": 0.0 if s.most > 1 else None, "dunn": None, "visited": 0.0, "skipped": s.skipped} for _ in label_cols]
        if s.distinct > 1:
            balls = _balls(s, block_rows)
            open_ = balls.open()
            wanted = np.zeros((len(balls.pivots),) * 2, bool)
            for m in open_:
                for pairs in m.values():
                    wanted |= pairs | pairs.T
            fn, group = _to_pairs(balls, wanted, s.dim)
            rows = s.rows.select("features", "labels", F.xxhash64("features", "labels").alias("h"))
            sent = rows.mapInArrow(fn, "pair bigint, block bigint, features array<double>, labels array<int>")
            found = sent.groupBy("pair").applyInArrow(_pair_extremes(balls, open_, wanted, group, s.dim), PAIR_RESULT)
            pairs = s.distinct * (s.distinct - 1) // 2
            for r in found.groupBy("m").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("visited").alias("visited")).collect():
                one = out[r["m"]]
                one["min_inter"] = r["low"] if r["low"] < INF else None
                one["max_intra"] = max(r["high"], one["max_intra"] or 0.0) if r["high"] > -INF else one["max_intra"]
                one["visited"] = r["visited"] / pairs
        for one in out:
            if one["max_intra"] and one["min_inter"] is not None:
                one["dunn"] = one["min_inter"] / one["max_intra"]
        return out
    finally:
        s.rows.unpersist()


def dunn_parts(df: DataFrame, n: int | None = None, block_rows: int = DEFAULT_BLOCK_ROWS, col: str = "features",
               cluster_col: str = "cluster", id_col: str = "id") -> DataFrame:
    """One row: ``min_inter`` (closest pair in different clusters), ``max_intra``, ``dunn``, ``visited``, ``skipped``.

    NULL when no pair of the kind exists (single cluster / only singletons).
    """
    one = dunn_many(df, [cluster_col], block_rows, col)[0]
    schema = "min_inter double, max_intra double, dunn double, visited double, skipped bigint"
    return df.sparkSession.createDataFrame([tuple(one.values())], schema)


# --- owned blocks: Silhouette and nearest neighbours ---------------------------------


def _to_owners(rows: DataFrame, blocks: int, key: Column) -> DataFrame:
    """Every row once per owner of a block; within an owner its own rows come first."""
    block = F.pmod(key, F.lit(blocks)).cast("int")
    sent = rows.withColumn("_block", block).withColumn("_owner", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    sent = sent.withColumn("_other", F.col("_owner") != F.col("_block")).drop("_block")
    return sent.repartition("_owner").sortWithinPartitions("_owner", "_other")


def _owned(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch | None]]:
    """("own", rows of the owned block), then ("past", rows) pieces of all rows, the own ones included, then ("end", None)."""
    now, own, open_ = None, [], False
    for batch in batches:
        owner, other = batch.column("_owner").to_numpy(), batch.column("_other").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(owner) != 0) | (np.diff(other.astype(np.int8)) != 0)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(owner)]):
            if owner[lo] != now:
                if now is not None:
                    yield from _past(own, open_)
                    yield "end", None
                now, own, open_ = owner[lo], [], False
            piece = batch.slice(lo, hi - lo)
            if other[lo]:
                if not open_:
                    yield from _past(own, False)
                    open_ = True
                for at in range(0, len(piece), STEP):
                    yield "past", piece.slice(at, STEP)
            else:
                own.append(piece)
    if now is not None:
        yield from _past(own, open_)
        yield "end", None


def _past(own: list[pa.RecordBatch], done: bool) -> Iterator[tuple[str, pa.RecordBatch]]:
    """The owned block as a whole, then past itself."""
    if not done:
        whole = pa.Table.from_batches(own).combine_chunks().to_batches()[0] if own else None
        yield "own", whole
        if whole is not None:
            for at in range(0, len(whole), STEP):
                yield "past", whole.slice(at, STEP)


def _silhouettes(sizes: list[dict[int, int]], dim: int):
    """Finished (features, labels, w, a, b, s) of the owned rows: a, b, s by labelling."""
    models = len(sizes)
    known = [np.array(sorted(s)) for s in sizes]
    rows_of = [np.array([s[k] for k in sorted(s)], dtype=np.float64) for s in sizes]

    def fn(batches):
        own = x = labels = sums = None
        for what, rows in _owned(batches):
            if what == "own":
                own = rows
                if own is not None:
                    x, labels = batch_matrix(own, "features", dim), _labels(own, models)
                    sums = [np.zeros((len(x), len(k))) for k in known]
            elif own is None:
                continue
            elif what == "past":
                y, w, passing = batch_matrix(rows, "features", dim), rows.column("w").to_numpy(), _labels(rows, models)
                of = [(passing[:, m : m + 1] == known[m]).astype(np.float64) for m in range(models)]
                for tile in _tiles(len(x)):
                    d = _dist_matrix(x[tile], y) * w
                    for m in range(models):
                        sums[m][tile] += d @ of[m]
            else:
                a, b, s = (np.zeros((len(x), models)) for _ in range(3))
                for m in range(models):
                    at = np.searchsorted(known[m], labels[:, m])
                    alone = rows_of[m][at] <= 1
                    a[:, m] = np.where(alone, 0.0, sums[m][np.arange(len(x)), at] / np.maximum(rows_of[m][at] - 1, 1))
                    means = sums[m] / rows_of[m]
                    means[np.arange(len(x)), at] = INF
                    b[:, m] = means.min(1)
                    top = np.maximum(a[:, m], b[:, m])
                    with np.errstate(invalid="ignore"):
                        s[:, m] = np.where(alone | (top == 0), 0.0, (b[:, m] - a[:, m]) / np.where(top == 0, 1.0, top))
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, x.shape[0] * models + 1, models), pa.int32()), pa.array(v.ravel())) for v in (a, b, s)]
                yield pa.RecordBatch.from_arrays(
                    [own.column("features"), own.column("labels"), own.column("w"), *lists], names=["features", "labels", "w", "a", "b", "s"]
                )

    return fn


SILHOUETTE = "features array<double>, labels array<int>, w bigint, a array<double>, b array<double>, s array<double>"


def _row_silhouettes(s: Scored, block_rows: int | None) -> DataFrame:
    sent = _to_owners(s.rows, _num_owners(s.distinct, s.dim, block_rows), F.xxhash64("features", "labels"))
    return sent.mapInArrow(_silhouettes(s.sizes, s.dim), SILHOUETTE)


def silhouette_many(df: DataFrame, label_cols: list[str], block_rows: int | None = None, col: str = "features") -> list[dict]:
    """Per labelling: mean Silhouette (None unless 2 <= clusters <= N-1), ``n_clusters``, ``skipped``."""
    ship_package(df.sparkSession)
    s = _scored(df, label_cols, col)
    try:
        means: dict[int, float] = {}
        if s.distinct:
            per = _row_silhouettes(s, block_rows).select("w", F.posexplode("s").alias("m", "s"))
            means = {r["m"]: r["v"] / s.n for r in per.groupBy("m").agg(F.sum(F.col("w") * F.col("s")).alias("v")).collect()}
        return [
            {"silhouette": means[m] if 2 <= len(sizes) <= s.n - 1 else None, "n_clusters": len(sizes), "skipped": s.skipped}
            for m, sizes in enumerate(s.sizes)
        ]
    finally:
        s.rows.unpersist()


def silhouette_parts(df: DataFrame, n: int | None = None, block_rows: int | None = None, col: str = "features",
                     cluster_col: str = "cluster", id_col: str = "id") -> DataFrame:
    """Per-row ``(id, cluster, a, b, s)`` of the Euclidean Silhouette.

    ``a`` = mean distance to the other members of the own cluster, ``b`` =
    smallest mean distance to another cluster (inf if there is none),
    ``s = (b - a) / max(a, b)``, 0 for a singleton cluster.
    """
    ship_package(df.sparkSession)
    s = _scored(df, [cluster_col], col)
    s.rows.unpersist()
    found = _row_silhouettes(s, block_rows).select("features", F.col("labels")[0].alias("_label"), *[F.col(c)[0].alias(c) for c in "abs"])
    rows = df.select(id_col, cluster_col, F.col(col).alias("features"), F.col(cluster_col).cast("int").alias("_label"))
    return rows.join(found, ["features", "_label"]).select(id_col, cluster_col, "a", "b", "s")


def silhouette(df: DataFrame, n: int | None = None, block_rows: int | None = None, col: str = "features",
               cluster_col: str = "cluster", id_col: str = "id") -> DataFrame:
    """One row: mean Silhouette (NULL unless 2 <= clusters <= N-1), number of clusters, rows skipped."""
    one = silhouette_many(df, [cluster_col], block_rows, col)[0]
    return df.sparkSession.createDataFrame([tuple(one.values())], "silhouette double, n_clusters bigint, skipped bigint")


def _neighbours(dim: int, id_col: str):
    """Nearest other row (ties -> least id), farthest distance and mean distance of the owned rows."""

    def fn(batches):
        own = x = ids = None
        for what, rows in _owned(batches):
            if what == "own":
                own = rows
                if own is not None:
                    x, ids = batch_matrix(own, "features", dim), own.column(id_col).to_numpy()
                    near, near_id = np.full(len(x), INF), np.full(len(x), np.iinfo(np.int64).max)
                    far, total, n = np.zeros(len(x)), np.zeros(len(x)), np.zeros(len(x), np.int64)
            elif own is None:
                continue
            elif what == "past":
                # by id, so that the first of several nearest rows has the least id
                order = np.argsort(rows.column(id_col).to_numpy(), kind="stable")
                others, y = rows.column(id_col).to_numpy()[order], batch_matrix(rows, "features", dim)[order]
                met = np.isin(ids, others)
                for tile in _tiles(len(x)):
                    d = _dist_matrix(x[tile], y)
                    passed = len(others)
                    if met[tile].any():
                        itself = ids[tile, None] == others[None, :]
                        passed = passed - itself.sum(1)
                        d[itself] = 0.0
                    total[tile] += d.sum(1)
                    n[tile] += passed
                    far[tile] = np.maximum(far[tile], d.max(1))
                    if met[tile].any():
                        d[itself] = INF
                    at = d.argmin(1)
                    least = d[np.arange(len(d)), at]
                    first = np.where(least < INF, others[at], np.iinfo(np.int64).max)
                    near_id[tile] = np.where(least < near[tile], first, np.where(least == near[tile], np.minimum(first, near_id[tile]), near_id[tile]))
                    near[tile] = np.minimum(near[tile], least)
            else:
                some = np.flatnonzero(n > 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v[some]) for v in (ids, near_id, near, far, total / np.maximum(n, 1))],
                    names=["id", "nearest_id", "nearest_dist", "farthest_dist", "mean_dist"],
                )

    return fn


def pairwise_summary(df: DataFrame, n: int | None = None, block_rows: int | None = None, col: str = "features",
                     id_col: str = "id") -> DataFrame:
    """Per row: nearest other row (id, distance; ties -> lowest id), farthest distance, mean distance.

    Rows are told apart by id; rows without a vector or id are left out.
    """
    ship_package(df.sparkSession)
    rows = df.where(F.col(col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias(id_col), F.col(col).alias("features"))
    head = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("d")).first()
    sent = _to_owners(rows, _num_owners(n or head["n"], head["d"] or 1, block_rows), F.xxhash64(id_col))
    schema = "id bigint, nearest_id bigint, nearest_dist double, farthest_dist double, mean_dist double"
    return sent.mapInArrow(_neighbours(head["d"] or 0, id_col), schema).withColumnRenamed("id", id_col)


def dunn_index(df: DataFrame, **kw) -> DataFrame:
    """``min_inter, max_intra, dunn`` of an assigned frame (``cluster, features``)."""
    return dunn_parts(df, **kw)


def min_intercluster(df: DataFrame, **kw) -> DataFrame:
    return dunn_parts(df, **kw).select("min_inter")


def max_intracluster(df: DataFrame, **kw) -> DataFrame:
    return dunn_parts(df, **kw).select("max_intra")


def pairwise_distance(df: DataFrame, **kw) -> DataFrame:
    """Per-row summary of all pairwise distances (nearest, farthest, mean); pairs are never materialised."""
    return pairwise_summary(df, **kw)

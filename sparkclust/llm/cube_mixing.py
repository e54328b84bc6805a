"""Mixing sources to target weights by cube-method balanced sampling.

Targets: sources in code-point order, null last, weigh 1, 2, 3, 1, ... and
share all words; a target stops at ``CEILING`` times its source's size and the
excess is shared anew.  That is a water level: target = min(ceiling, level *
weight), found in closed form with one ordered window over the sources.

Every document of a source is wanted ``target / source size`` times.  The whole
part is taken outright; the fractional part is an inclusion probability.  The
cube method moves the vector of probabilities through the null space of the
balancing constraints (number of documents, words, and further columns) until
all but a few are 0 or 1; this is the flight.  Flights run in buckets of each
source, so a source of any size is spread over many tasks; what stays
fractional, at most as many as there are constraints per bucket, flies again in
fewer buckets, until one bucket per source is left, whose last few are landed
by trying the choices that keep the words nearest to their total.

Draws come from hashes of the rows, so reruns agree.  Null or empty texts have
size 0 and take 0 words; repeated rows are units of their own.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkclust.llm.common import stored, text_of, words_of

WEIGHTS = (1, 2, 3)
CEILING = 3
#: Documents in one flight.
BUCKET_ROWS = 4_000
SEED = 20_240_501
EPS = 1e-9


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, n_docs, target) from rows (source, size); one row per source.

    The water level: sources by ceiling / weight; the first i are at their
    ceiling where the level that the others then share does not reach theirs.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    n = F.row_number().over(order)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), F.pmod(n - 1, F.lit(len(WEIGHTS))) + 1)
    per = per.withColumn("weight", weight).withColumn("top", (CEILING * F.col("source_size")).cast("double"))
    by = Window.orderBy(F.col("top") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    per = per.select(
        "*",
        F.sum("source_size").over(whole).cast("double").alias("total"),
        F.sum("weight").over(whole).alias("weights"),
        F.coalesce(F.sum("top").over(before), F.lit(0.0)).alias("full"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("full_weight"),
    )
    # the level if exactly the sources before this one are at their ceiling
    level = (F.col("total") - F.col("full")) / (F.col("weights") - F.col("full_weight"))
    per = per.withColumn("level", level)
    open_ = F.col("level") * F.col("weight") <= F.col("top")
    per = per.withColumn("water", F.min(F.when(open_, F.struct("full_weight", "level"))).over(whole)["level"])
    target = F.least(F.col("top"), F.coalesce(F.col("water") * F.col("weight"), F.col("top")))
    return per.select("source", "source_size", "n_docs", target.alias("target"))


def flight(p: np.ndarray, balance: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Flight phase: rows of ``balance`` (units x constraints) keep their weighted sums.

    Works on a window of constraints + 1 fractional units at a time; each step
    moves along a null vector of their constraints until a unit is 0 or 1.
    Returns probabilities of which at most ``constraints`` are fractional.
    """
    p = np.where(p < EPS, 0.0, np.where(p > 1 - EPS, 1.0, p))
    q = balance.shape[1]
    waiting = iter(np.flatnonzero((p > 0) & (p < 1)))
    window: list[int] = []
    while True:
        window += list(itertools.islice(waiting, q + 1 - len(window)))
        if not window:
            return p
        rows = balance[window]
        # a null vector exists where there are more units than independent constraints
        _, s, vt = np.linalg.svd(rows.T, full_matrices=True)
        rank = int((s > 1e-10 * max(s[0], 1e-300)).sum()) if s.size else 0
        if rank >= len(window):
            return p
        u = vt[-1]
        u = np.where(np.abs(u) < 1e-12, 0.0, u)
        x = p[window]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - x) / u, np.where(u < 0, -x / u, np.inf)).min()
            down = np.where(u > 0, x / u, np.where(u < 0, (x - 1) / u, np.inf)).min()
        x = x + (up if rng.random() * (up + down) < down else -down) * u
        x = np.where(x < EPS, 0.0, np.where(x > 1 - EPS, 1.0, x))
        p[window] = x
        window = [i for i, v in zip(window, x, strict=True) if 0 < v < 1]


def land(p: np.ndarray, balance: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Landing phase: 0 or 1 for the few units that are left.

    Of all choices of the rounded-down or rounded-up number of units, the one
    whose balance is nearest to what is left to place; ties by the draw.
    """
    left = np.flatnonzero((p > 0) & (p < 1))
    if left.size == 0:
        return p
    scale = np.abs(balance).mean(axis=0) + 1e-300
    want = (balance[left] * p[left, None]).sum(axis=0) / scale
    best = None
    for choice in itertools.product((0.0, 1.0), repeat=left.size):
        off = np.abs((balance[left] * np.array(choice)[:, None]).sum(axis=0) / scale - want)
        key = (round(float(off[-1]), 9), round(float(off.sum()), 9), rng.random())
        if best is None or key < best[0]:
            best = (key, choice)
    p = p.copy()
    p[left] = best[1]
    return p


def _fly(last: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_order", "_tie", "size"], kind="stable").reset_index(drop=True)
        seed = [SEED, int(pdf["_bucket"].iloc[0]) % 2**32, int(pdf["_order"].iloc[0]) % 2**32, int(last)]
        rng = np.random.default_rng(seed)
        p = pdf["_p"].to_numpy(float)
        sizes = pdf["size"].to_numpy(float)
        balance = np.column_stack([np.ones_like(sizes), sizes / max(sizes.mean(), 1.0)])
        p = flight(p.copy(), balance, rng)
        pdf["_p"] = land(p, balance, rng) if last else p
        return pdf

    return run


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken (words)."""
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(text_of(text_col)).alias("size"),
    )
    # sizes are read by the targets and by the flights: stored once, without texts
    sized = stored(sized, "mix-sizes")
    targets = source_targets(sized).select(
        F.col("source").alias("_source"), "source_size", "n_docs", "target"
    )
    # a few numbers per source; no broadcast hint, the optimiser sees the size
    df = sized.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    want = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    df = df.withColumn("_want", want).withColumn("_whole", F.floor(F.col("_want") + EPS).cast("int"))
    df = df.withColumn("_p", F.greatest(F.col("_want") - F.col("_whole"), F.lit(0.0)))
    order = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(SEED))
    df = df.withColumn("_order", order).withColumn("_tie", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    buckets = F.ceil(F.col("n_docs") / BUCKET_ROWS).cast("long")
    df = df.withColumn("_buckets", F.greatest(buckets, F.lit(1).cast("long")))
    df = df.withColumn("_bucket", F.pmod(F.shiftrightunsigned(F.col("_order"), 8), F.col("_buckets")))
    names = ["doc_id", "source", "size", "source_size", "target", "_whole", "_p", "_order", "_tie", "_buckets", "_bucket"]
    df = df.select(*names)
    done: list[DataFrame] = []
    while True:
        flown = df.groupBy("source", "_bucket").applyInPandas(_fly(False), df.schema)
        flown = stored(flown, "mix-flight")
        open_ = (F.col("_p") > 0) & (F.col("_p") < 1)
        done.append(flown.where(~open_))
        df = flown.where(open_)
        # what is left: at most two units per bucket
        most = flown.agg(F.max("_buckets")).first()[0] or 1
        shrink = F.ceil(F.col("_buckets") / (BUCKET_ROWS // 2)).cast("long")
        df = df.withColumn("_buckets", shrink).withColumn("_bucket", F.pmod(F.col("_bucket"), shrink)).select(*names)
        if most <= BUCKET_ROWS // 2:
            done.append(df.groupBy("source", "_bucket").applyInPandas(_fly(True), df.schema))
            break
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    copies = (F.col("_whole") + F.round("_p").cast("int")).cast("int")
    return out.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (F.col("size") * copies).cast("long").alias("taken"),
    )

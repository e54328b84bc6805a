"""Reproducible draws, exact splits, row numbering and weighted picks.

All randomness comes from :func:`draw_u` (md5 of ``seed|step|id``), so every
result is independent of partitioning, task retries and row order.  No
operator sorts the whole table in one task, and none takes another way for
small inputs:

* ``split_exact`` finds the n-th smallest draw digit by digit: every pass counts
  the rows by the next ``DIGIT`` bits (at most ``2**DIGIT`` numbers reach the
  driver), then marks rows with a narrow filter expression.
* ``with_row_id`` deals rows into ranges of (key, row hash), sorts each range and
  adds the sizes of the ranges before it.
* picks use ``min_by(row, key)``: one partial row per task, merged by a shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vector import DRAW_BITS, col_of, draw_int, draw_u
from ..session import cut_lineage

#: Bits of a draw that one pass decides.
DIGIT = 12
#: Copies of a row that one task writes at once.
COPIES = 65_536


def with_draw(df: DataFrame, seed: int, step: int = 0, id_col: str = "id", out: str = "u") -> DataFrame:
    return df.withColumn(out, draw_u(seed, step, id_col))


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of all columns."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def _digits(value: Column, bits: int) -> list[Column]:
    """The digits of a non-negative whole number, highest first."""
    out, top = [], bits
    while top > 0:
        low = max(0, top - DIGIT)
        out.append(F.shiftright(value, low).bitwiseAND((1 << (top - low)) - 1))
        top = low
    return out


def _copies(df: DataFrame, n: str) -> DataFrame:
    """Every row ``n`` times, dealt over tasks."""
    starts = df.where(F.col(n) > 0).withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1, F.lit(COPIES).cast("bigint"))))
    dealt = starts.repartition(F.col("_from"))
    last = F.least(F.col("_from") + COPIES, F.col(n)) - 1
    return dealt.withColumn("_copy", F.explode(F.sequence(F.col("_from"), last))).drop("_from", "_copy", n)


def split_exact(
    df: DataFrame,
    n_test: int | None = None,
    frac: float | None = None,
    seed: int = 42,
    id_col: str | None = "id",
    out: str = "split",
) -> DataFrame:
    """Mark exactly ``n_test`` rows (the smallest draws) as ``test``, the rest ``train``.

    Give ``n_test`` directly or ``frac`` (``n_test = floor(frac * N)``).  Ids may
    repeat, be NULL or be absent (``id_col=None``: rows are drawn by their hash):
    equal draws are decided by the row hash, and of rows that are equal in every
    column as many copies as needed are marked.
    """
    if n_test is None and frac is None:
        raise ValueError("give n_test or frac")
    if n_test is not None and n_test < 0:
        raise ValueError("n_test must be >= 0")
    if n_test == 0:
        return df.withColumn(out, F.lit("train"))
    hashed = F.shiftrightunsigned(row_hash(df), 1)
    draw = draw_int(seed, 0, id_col if id_col is not None else hashed)
    inside, below, need, found = F.lit(True), F.lit(False), n_test, 0
    for level, digit in enumerate(_digits(draw, DRAW_BITS) + _digits(hashed, 63)):
        counts = sorted((r["d"], r["n"]) for r in df.where(inside).groupBy(digit.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect())
        total = sum(n for _, n in counts)
        if level == 0:
            need = int(math.floor(frac * total)) if need is None else need
            if need == 0 or need >= total:
                return df.withColumn(out, F.lit("test" if need else "train"))
        at = 0
        while counts[at][1] < need:
            need -= counts[at][1]
            at += 1
        below = below | (inside & (digit < counts[at][0]))
        inside = inside & (digit == counts[at][0])
        found = counts[at][1]
        if found == need:
            return df.withColumn(out, F.when(below | inside, "test").otherwise("train"))
    # rows with one draw and one hash: copies of a row; groups of them go to the test set until it is full
    rest = df.where(~inside).withColumn(out, F.when(below, "test").otherwise("train"))
    names = [F.col(f"`{c}`") for c in df.columns]
    groups = df.where(inside).groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.orderBy(F.to_json(F.struct(*names))))
    test = F.greatest(F.least(F.col("_n"), need - upto + F.col("_n")), F.lit(0).cast("bigint"))
    shares = F.array(F.struct(F.lit("test").alias(out), F.col("_test").alias("_m")), F.struct(F.lit("train").alias(out), (F.col("_n") - F.col("_test")).alias("_m")))
    shared = groups.withColumn("_test", test).withColumn("_share", F.explode(shares))
    return rest.unionByName(_copies(shared.select(*names, "_share.*"), "_m"))


def with_row_id(df: DataFrame, order_col: str, out: str = "row_id") -> DataFrame:
    """Dense 0..N-1 numbering in the order of ``order_col`` (NULL first), of any type that can be ordered.

    Rows with equal keys are in the order of their hashes; copies of a row are
    dealt by place, so neither a frequent key nor a frequent row fills one range.
    The sorted rows are checkpointed once, since range bounds are sampled anew by
    every evaluation; the sizes of the ranges (one row per range) are broadcast.
    """
    order = [F.col(f"`{order_col}`").asc_nulls_first(), "_hash", "_salt"]
    salted = df.withColumns({"_hash": row_hash(df), "_salt": F.xxhash64(F.monotonically_increasing_id())})
    ranges = salted.repartitionByRange(*order).sortWithinPartitions(*order).drop("_hash", "_salt")
    # upper bits: the range; lower 33 bits: the place in it
    placed = cut_lineage(ranges.withColumn("_place", F.monotonically_increasing_id()))
    part, at = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(before), "_part")
    return numbered.withColumn(out, (F.col("_before") + at).cast("bigint")).drop("_part", "_place", "_before")


def _least_row(df: DataFrame, key: Column) -> DataFrame:
    """The row with the smallest key (none for an empty frame): an aggregate with partial results, one row at the end."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.agg(F.min_by(row, key).alias("_row")).where(F.col("_row").isNotNull()).select("_row.*")


def uniform_pick(df: DataFrame, seed: int, step: int = 0, id_col: str = "id") -> DataFrame:
    """The row with the smallest draw ``u(seed, step, id)`` (ties: lowest id)."""
    u = draw_u(seed, step, id_col)
    return _least_row(df.withColumn("u", u), F.struct("u", id_col))


def weighted_pick(df: DataFrame, weight: Column | str, seed: int, step: int, id_col: str = "id") -> DataFrame:
    """One row drawn with probability proportional to ``weight`` (exponential race).

    ``key = -ln(u) / w`` for rows with ``w > 0`` (NULL otherwise); the smallest
    key wins, ties to the lowest id.  One pass, no normalisation of the
    weights.  The weight is used in a single projection (no separate filter:
    a pushed-down filter would evaluate the weight expression twice per row).
    A NULL ``race_key`` in the result means no row has a positive weight.
    """
    w = col_of(weight)
    u = draw_u(seed, step, id_col)
    raced = df.withColumn("race_key", F.when(w > 0, -F.log(u) / w))
    return _least_row(raced, F.struct(F.col("race_key").isNull(), "race_key", id_col))

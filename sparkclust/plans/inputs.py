"""Derived inputs shared by the registered queries (see FIXTURES.md part B).

Every input is read from the generated tables; nothing is synthesised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.matrix import binarize_label, to_matrix

# Fixed parameters of the registered queries
SEED = 42
TEST_FRAC = 0.235
LINEITEM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINEITEM_SEEDS = [[-1.0, -1.0, -1.0, -1.0], [0.0, 0.0, 0.0, 0.0], [1.0, 1.0, 1.0, 1.0]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_E(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, features ARRAY<DOUBLE> (64), label`` with label 1 -> 1, others -> 0."""
    return binarize_label(to_matrix(table(spark, sf_dir, "embeddings")))


def load_E_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E with NaN where ``(id + pos) % 7 = 0`` (pos from 0)."""
    e = load_E(spark, sf_dir)
    return e.withColumn(
        "features",
        F.transform("features", lambda x, i: F.when((F.col("id") + i) % 7 == 0, F.lit(float("nan"))).otherwise(x)),
    )


def load_L(spark: SparkSession, sf_dir: str, keep: tuple = ()) -> DataFrame:
    """The four numeric lineitem columns as one feature array (no unique key: id = NULL)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(*keep, F.array(*[F.col(c).cast("double") for c in LINEITEM_COLS]).alias("features"))


# Fixed values of the lineitem content id shared with the SQL oracle:
# id = integer of the first 13 hex digits of md5 of
#   "l_orderkey|l_partkey|l_suppkey|l_linenumber|round(100*l_quantity)|round(100*l_extendedprice)|round(100*l_discount)|round(100*l_tax)"
LINEITEM_ID_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def lineitem_row_id():
    """Layout-independent content id of a lineitem row (lineitem has no unique key)."""
    parts = [F.col(c).cast("bigint").cast("string") for c in LINEITEM_ID_KEYS]
    parts += [F.round(F.col(c) * 100).cast("bigint").cast("string") for c in LINEITEM_COLS]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("bigint")


def load_LB(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, label = quality, cluster = toxic`` (prediction column)."""
    lb = table(spark, sf_dir, "labels")
    return lb.select(F.col("doc_id").cast("bigint").alias("id"), F.col("quality").alias("label"), F.col("toxic").alias("cluster"))


def rnd(c, digits: int = 6):
    """Round and turn -0.0 into 0.0 (the oracle does the same)."""
    return F.round(c, digits) + F.lit(0.0)


def sig9(c):
    """Round to 9 significant digits (for large magnitudes, e.g. lineitem covariances)."""
    e = F.floor(F.log10(F.abs(c)))
    p = F.pow(F.lit(10.0), F.abs(e))
    scaled = F.when(e >= 0, c / p).otherwise(c * p)
    r = F.round(scaled, 8)
    return F.when(c == 0, F.lit(0.0)).otherwise(F.when(e >= 0, r * p).otherwise(r / p)) + F.lit(0.0)


def sig6(c):
    """Round to 6 significant digits (differences of large numbers)."""
    p = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))))
    return F.when(c == 0, F.lit(0.0)).otherwise(F.round(c / p, 5) * p) + F.lit(0.0)

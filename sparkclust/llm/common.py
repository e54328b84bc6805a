"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkclust.session import checkpoint_dir, ship_package

#: Characters that separate words, and the pattern of the runs of them.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"\s+"  # in Java's patterns exactly [\x20\x09-\x0D]+


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; also makes the package importable in Python workers."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The column with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text (none: empty array)."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))


def drawn(digest: Column, share: float | Column) -> Column:
    """Whether a 64-bit hash falls into ``share`` of all, however small the share."""
    share = share if isinstance(share, Column) else F.lit(float(share))
    return (F.shiftrightunsigned(digest, 1).cast("double") < share * float(1 << 63)) | (share >= 1.0)


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage with files that every executor sees, so the loss of an
    executor repeats nothing above the write.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Gives freed memory back to the system: Python workers are kept for later tasks, beside other workers."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)

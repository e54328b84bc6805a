"""Matrix sources and sinks.

Canonical frame: ``id BIGINT, features ARRAY<DOUBLE>, label INT`` (plus
``cluster INT`` after assignment).  Readers and writers are plain
``DataFrameReader`` / ``DataFrameWriter`` calls; nothing passes through the
driver.  Id texts are numbered by range (:func:`number_texts`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vector import as_double_array
from ..operators.sampling import with_row_id


def read_matrix(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    header: bool = True,
    partitions: int | None = None,
    id_mode: str = "auto",
) -> DataFrame:
    """Read a numeric matrix: first column id, last column label, the rest features.

    Cells that do not parse as numbers (junk, empty cells) become NULL; the
    header line is skipped by the reader.  A missing path raises Spark's
    ``PATH_NOT_FOUND`` error.  ``id_mode`` says what the first column is:
    ``"auto"`` takes whole numbers as they are if all ids are such, and else
    numbers the id texts; ``"number"`` always numbers them (see
    :func:`number_texts`); ``"parse"`` reads numbers and makes other texts NULL;
    ``"hash"`` derives a 52-bit id from the text (first 13 hex digits of its md5).
    """
    if fmt == "parquet":
        raw = spark.read.parquet(path)
    else:
        raw = spark.read.option("header", header).option("mode", "PERMISSIVE").csv(path)
    out = parse_matrix(raw, id_mode)
    return out.repartition(partitions) if partitions else out


ID_MODES = ("auto", "number", "parse", "hash")


def number_texts(df: DataFrame, col: str, out: str) -> DataFrame:
    """Adds ``out``: the rank from 0 of the row's text among the distinct texts of ``col``; NULL for NULL.

    Distinct texts are found with partial results per task and numbered by range,
    so no two texts share a number and no task holds all of them; the numbers are
    joined back by text, where a frequent text is split by the optimiser.
    """
    texts = df.select(F.col(f"`{col}`").alias("_text")).where(F.col("_text").isNotNull()).distinct()
    numbers = with_row_id(texts, "_text", out)
    return df.withColumn("_text", F.col(f"`{col}`")).join(numbers, "_text", "left").drop("_text")


def parse_matrix(raw: DataFrame, id_mode: str = "auto") -> DataFrame:
    """Canonical frame from columns of text: first id, last label, the rest features (rules of ``read_matrix``)."""
    if id_mode not in ID_MODES:
        raise ValueError(f"id_mode must be one of {', '.join(ID_MODES)}")
    cols = raw.columns
    if len(cols) < 3:
        raise ValueError("a matrix needs an id column, at least one feature and a label column")
    id_c, label_c, feat_c = cols[0], cols[-1], cols[1:-1]

    def num(c: str) -> Column:
        return F.col(f"`{c}`").try_cast("double")

    text = F.trim(F.col(f"`{id_c}`").cast("string"))
    real = num(id_c)
    whole = F.coalesce(text.try_cast("bigint"), F.when(real == F.floor(real), real.try_cast("bigint")))
    if id_mode == "auto":
        names = raw.agg(F.count_if((text != "") & whole.isNull()).alias("n")).first()["n"]
        id_mode = "number" if names else "parse"
    rid = {
        "hash": F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint"),
        "number": F.when(text != "", text),
        "parse": whole,
    }[id_mode]
    out = raw.select(
        rid.alias("id"),
        F.array(*[num(c) for c in feat_c]).alias("features"),
        num(label_c).cast("int").alias("label"),
    )
    if id_mode == "number":
        out = number_texts(out.withColumnRenamed("id", "_name"), "_name", "id").select("id", "features", "label")
    return out


def to_matrix(
    df: DataFrame,
    id_col: str = "vec_id",
    features: str | Sequence[str] = "embedding",
    label_col: str | None = "label",
    dims: int | None = None,
) -> DataFrame:
    """Canonical frame from a table holding an array column or numeric columns.

    ``dims`` keeps only the first ``dims`` coordinates (``slice``).
    """
    if isinstance(features, str):
        f = as_double_array(features)
    else:
        f = F.array(*[F.col(c).cast("double") for c in features])
    if dims is not None:
        f = F.slice(f, 1, int(dims))
    cols = [F.col(id_col).cast("bigint").alias("id"), f.alias("features")]
    if label_col is not None:
        cols.append(F.col(label_col).cast("int").alias("label"))
    return df.select(*cols)


def binarize_label(df: DataFrame, positive: int = 1, col: str = "label") -> DataFrame:
    """1 stays 1 (the positive class), every other value becomes 0."""
    return df.withColumn(col, F.when(F.col(col) == positive, 1).otherwise(0).cast("int"))


def shape(df: DataFrame, col: str = "features") -> DataFrame:
    """One row: number of rows and width of the feature vectors."""
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.max(F.size(col)).cast("bigint").alias("n_dims"),
    )


def explode_columns(df: DataFrame, dims: int, col: str = "features", names: Sequence[str] | None = None) -> DataFrame:
    """Feature array -> numbered columns ``0..dims-1`` between id and label."""
    names = list(names) if names is not None else [str(i) for i in range(dims)]
    keep = [c for c in df.columns if c != col]
    front = [c for c in keep if c in ("cluster", "id")]
    back = [c for c in keep if c not in front]
    return df.select(*front, *[F.col(col)[i].alias(n) for i, n in enumerate(names)], *back)


def plot_frame(df: DataFrame, dims: int = 3, group_col: str = "cluster") -> DataFrame:
    """Group (cluster or label) plus the first ``dims`` coordinates, for 3-D plots."""
    return df.select("id", group_col, *[F.col("features")[i].alias(f"pc{i + 1}") for i in range(dims)])


# --- sinks -----------------------------------------------------------------


def _text_frame(df: DataFrame, dims: int, decimals: int | None, int_cols: Sequence[str] = ()) -> DataFrame:
    cols = []
    for c in df.columns:
        if c == "features":
            for i in range(dims):
                x = F.col("features")[i]
                cols.append((F.format_string(f"%.{decimals}f", x) if decimals is not None else x).alias(str(i)))
        elif c in int_cols or decimals is None:
            cols.append(F.col(c))
        elif dict(df.dtypes)[c] == "string":
            cols.append(F.col(c))
        else:
            cols.append(F.format_string(f"%.{decimals}f", F.col(c).cast("double")).alias(c))
    return df.select(*cols)


def write_matrix(
    df: DataFrame,
    path: str,
    dims: int,
    fmt: str = "csv",
    decimals: int | None = 4,
    mode: str = "overwrite",
) -> None:
    """Write ``(id, features, label)``: Parquet as is, CSV with numbered header.

    ``decimals=4`` gives the fixed 4-decimal text of the reference output;
    ``None`` keeps full precision.
    """
    if fmt == "parquet":
        df.write.mode(mode).parquet(path)
        return
    out = _text_frame(df, dims, decimals, int_cols=("id", "label"))
    out.write.mode(mode).option("header", True).csv(path)


def vector_text(df: DataFrame, value_col: str, order_col: str = "k") -> DataFrame:
    """``(order_col, line)``: the lines that :func:`write_vector` writes."""
    return df.select(order_col, F.format_string("%.4f", F.col(value_col)).alias("line"))


def write_vector(df: DataFrame, path: str, value_col: str, order_col: str = "k", mode: str = "overwrite") -> None:
    """One number per line in ``order_col`` order (singular values, % variance)."""
    vector_text(df, value_col, order_col).orderBy(order_col).select("line").write.mode(mode).text(path)


def matrix_text(df: DataFrame, dims: int, decimals: int | None = 4) -> DataFrame:
    """The rows that the CSV writers write: features with ``decimals`` places, ids and labels as whole numbers."""
    return _text_frame(df, dims, decimals, int_cols=("id", "label"))


def write_split(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", decimals: int | None = None
) -> None:
    """Write train and test rows into ``split=train`` / ``split=test`` folders.

    ``decimals=4`` gives the reference's text: features as ``%.4f``, labels as ``%d``.
    """
    w = df.write.mode(mode).partitionBy("split")
    if fmt == "parquet":
        w.parquet(path)
    else:
        d = df.select(F.max(F.size("features"))).first()[0] or 0
        _text_frame(df, d, decimals, ("id", "label") if decimals is not None else ()).write.mode(mode).partitionBy("split").option("header", True).csv(path)


def clusters_frame(df: DataFrame, dims: int, keep_id: bool = False) -> DataFrame:
    """The rows that :func:`write_clusters` writes: cluster first, then the features as numbered columns."""
    return explode_columns(df.select("cluster", *(["id"] if keep_id else []), "features"), dims)


def write_clusters(
    df: DataFrame,
    path: str,
    dims: int,
    fmt: str = "csv",
    keep_id: bool = False,
    mode: str = "overwrite",
) -> None:
    """Write clustered rows: cluster first, then the features (full precision)."""
    if fmt == "parquet":
        df.select("cluster", *(["id"] if keep_id else []), "features").write.mode(mode).parquet(path)
    else:
        clusters_frame(df, dims, keep_id).write.mode(mode).option("header", True).csv(path)

"""The corpus pipeline: documents through the operators of ``sparkclust.llm``, stage by stage.

Every stage works on all rows of its predecessor and returns the columns of
``documents``; the last one returns the mix.  Null ids and texts pass through
all stages: a null or empty text fails the quality rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkclust.llm import bag_minhash, cube_mixing, decontaminate, quality_rules, secret_scan
from sparkclust.llm.common import ship_package, stored, table

#: Columns of ``documents``, which every stage but the last returns.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules (6): documents that fail the fixed rule or the learned list go."""
    rules = quality_rules.learn(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs.select(*COLUMNS), rules).where("kept").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup (5): of each class the document with the least id stays, once.

    A document is its id and its text: texts that share an id are documents of
    their own, which are told apart here by a digest.
    """
    ship_package(spark)
    digest = F.hex(F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    docs = docs.select(*COLUMNS).withColumn("_document", F.concat_ws("|", "doc_id", digest))
    found = bag_minhash.near_duplicates(docs, key=F.col("_document"))
    kept = found.where("kept").select(F.col("row_key").alias("_document")).distinct()
    return docs.join(kept, "_document", "left_semi").dropDuplicates(["_document"]).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (9): documents that hold a benchmark item go."""
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans (1): every span found is replaced in the text; no document goes."""
    docs = docs.select(*COLUMNS)
    clean = secret_scan.redact(secret_scan.scan(docs, secret_scan.learn_null(docs)))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing (2): the documents that the mix takes, with their copies and words."""
    ship_package(spark)
    return cube_mixing.mix(docs).where("copies > 0")


STAGES = [
    ("quality rules", reject_low_quality),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("source mixing", mix_sources),
]

#: The stages learn models, hash and draw, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

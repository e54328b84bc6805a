import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("sparkclust-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sparkclust-test-ckpt-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in ("embeddings", "lineitem", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF01}/{t}.parquet'")
    return con


def frame(spark, rows, with_label=True):
    """Canonical frame from python rows of (id, [features], label)."""
    schema = "id bigint, features array<double>, label int" if with_label else "id bigint, features array<double>"
    return spark.createDataFrame(rows, schema)


def load_E2(spark, sf_dir):
    """The embeddings on their first two coordinates, for closed forms."""
    from sparkclust.plans.inputs import load_E

    return load_E(spark, sf_dir).selectExpr("id", "slice(features, 1, 2) AS features", "label")

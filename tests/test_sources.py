import os
import tempfile

from conftest import SF01

from sparkclust.plans.inputs import load_E
from sparkclust.sources import matrix


def test_read_matrix_csv_edge(spark):
    d = tempfile.mkdtemp(prefix="sparkclust-csv-")
    p = os.path.join(d, "m.csv")
    with open(p, "w") as f:
        f.write("0,0,1,2\n")
        f.write("a1,1.5,abc,1\n")
        f.write("7,2.5,,0\n")
    df = matrix.read_matrix(spark, p, id_mode="parse").orderBy("label").collect()
    assert df[0].id == 7 and df[0].features == [2.5, None]
    assert df[1].id is None and df[1].features == [1.5, None] and df[1].label == 1


def test_write_read_round_trip(spark):
    e = load_E(spark, SF01).limit(20)
    d = tempfile.mkdtemp(prefix="sparkclust-rt-")
    matrix.write_matrix(e, os.path.join(d, "full"), 64, decimals=None)
    back = matrix.read_matrix(spark, os.path.join(d, "full")).orderBy("id").collect()
    orig = e.orderBy("id").collect()
    assert [r.id for r in back] == [r.id for r in orig]
    assert all(a.features == b.features for a, b in zip(back, orig))
    matrix.write_matrix(e, os.path.join(d, "fixed"), 64, decimals=4)
    txt = spark.read.option("header", True).csv(os.path.join(d, "fixed"))
    assert txt.columns[:3] == ["id", "0", "1"] and "." in txt.first()["0"]
    matrix.write_matrix(e, os.path.join(d, "pq"), 64, fmt="parquet")
    assert spark.read.parquet(os.path.join(d, "pq")).count() == 20


def test_write_clusters_and_split(spark):
    from pyspark.sql import functions as F

    e = load_E(spark, SF01).limit(30).withColumn("cluster", (F.col("id") % 2).cast("int"))
    d = tempfile.mkdtemp(prefix="sparkclust-cl-")
    matrix.write_clusters(e, os.path.join(d, "c"), 64)
    c = spark.read.option("header", True).csv(os.path.join(d, "c"))
    assert c.columns[0] == "cluster" and len(c.columns) == 65
    s = e.withColumn("split", F.when(F.col("id") < 10, "test").otherwise("train"))
    matrix.write_split(s, os.path.join(d, "s"))
    back = spark.read.parquet(os.path.join(d, "s"))
    assert back.where("split = 'test'").count() == s.where("split = 'test'").count()


def test_shape_and_binarize(spark):
    e = load_E(spark, SF01)
    r = matrix.shape(e).first()
    assert (r.n_rows, r.n_dims) == (500, 64)
    assert set(x.label for x in e.select("label").distinct().collect()) <= {0, 1}


def test_read_reference_text_format(spark, tmp_path):
    # "%3.4f, " separated values, integer label last, numbered header line
    p = tmp_path / "train.txt"
    p.write_text("0.0000, 0.0000, 1.0000, 2.0000\n17.0000, -1.2345, 0.5000, 1\n18.0000, 2.5000, -0.2500, 0\n")
    rows = matrix.read_matrix(spark, str(p)).orderBy("id").collect()
    assert [(r.id, list(r.features), r.label) for r in rows] == [(17, [-1.2345, 0.5], 1), (18, [2.5, -0.25], 0)]


def test_write_vector_one_per_line(spark, tmp_path):
    df = spark.createDataFrame([(2, 3.14159), (1, 338.82741), (3, 2.39291)], "k int, singular_value double")
    out = str(tmp_path / "sv")
    matrix.write_vector(df, out, "singular_value")
    lines = [r.value for r in spark.read.text(out).collect()]
    assert sorted(lines) == sorted(["338.8274", "3.1416", "2.3929"])


def test_read_matrix_text_ids_hash(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text('"",X1,X2,y\n"X21.V1.791",1.5,2.5,4\n"X15.V1.924",3.0,4.0,1\n')
    rows = matrix.read_matrix(spark, str(p), id_mode="hash").collect()
    assert all(r.id is not None for r in rows) and len({r.id for r in rows}) == 2
    assert sorted(r.label for r in rows) == [1, 4]


def test_text_ids_are_numbered_by_default(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text('"",X1,X2,y\n"X21.V1.791",1.5,2.5,4\n"X15.V1.924",3.0,4.0,1\n,5.0,6.0,2\n"X21.V1.791",7.0,8.0,3\n')
    rows = {r.label: r.id for r in matrix.read_matrix(spark, str(p)).collect()}
    assert rows == {1: 0, 4: 1, 3: 1, 2: None}


def test_whole_number_ids_stay_and_others_are_numbered(spark):
    whole = spark.createDataFrame([("9007199254740993", "1", "0"), ("17.0000", "2", "1"), ("", "3", "1")], "id string, x string, y string")
    assert sorted(str(r.id) for r in matrix.parse_matrix(whole).collect()) == ["17", "9007199254740993", "None"]
    mixed = spark.createDataFrame([("17", "1", "0"), ("1.5", "2", "1"), ("1.6", "3", "1")], "id string, x string, y string")
    assert {r.features[0]: r.id for r in matrix.parse_matrix(mixed).collect()} == {1.0: 2, 2.0: 0, 3.0: 1}
    big = spark.range(3000).selectExpr("concat('k', id % 1000) AS id", "'1' AS x", "'0' AS y").repartition(11)
    ids = [r.id for r in matrix.parse_matrix(big).collect()]
    assert len(ids) == 3000 and set(ids) == set(range(1000))

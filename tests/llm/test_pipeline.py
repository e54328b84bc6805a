import corpus_pipeline as cp
from llm_cases import EDGES, SF01, docs
from pyspark.sql import functions as F

import __spark_entry__ as entry


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names}
    assert [n for n, _ in cp.STAGES] == ["quality rules", "near duplicates", "decontamination", "secret scans", "source mixing"]


def test_stages_on_the_table(spark):
    """Each stage against a plain reading of its contract, on what the stage before kept."""
    from sparkclust.llm import bag_minhash, decontaminate, quality_rules, secret_scan

    docs_ = spark.read.parquet(f"{SF01}/documents.parquet")
    out = {}
    for name, stage in cp.STAGES:
        before, docs_ = docs_, stage(spark, docs_, SF01).persist()
        out[name] = docs_
        if name != "source mixing":
            assert docs_.columns == cp.COLUMNS
        ids, old = ({r.doc_id for r in x.select("doc_id").collect()} for x in (docs_, before))
        assert ids <= old
        if name == "quality rules":
            rules = quality_rules.learn(before, spark.read.parquet(f"{SF01}/labels.parquet"))
            assert ids == {r.doc_id for r in quality_rules.judge(before, rules).where("kept").collect()}
        if name == "near duplicates":
            classes = bag_minhash.near_duplicates(before).collect()
            assert ids == {r.class_id for r in classes} and docs_.count() == len(ids)
        if name == "decontamination":
            hit = {r.doc_id for r in decontaminate.find(before, spark.read.parquet(f"{SF01}/benchmark.parquet")).collect()}
            assert hit and ids == old - hit
        if name == "secret scans":
            assert ids == old
            found = secret_scan.scan(docs_, secret_scan.learn_null(docs_))
            assert found.where(F.size("_base") > 0).count() == 0
            assert docs_.where("n_chars != length(text)").count() == 0
    mixed = out["source mixing"]
    assert mixed.where("copies < 1 or taken > 3 * size").count() == 0


def test_texts_that_share_an_id_both_stay(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(7, " ".join(words[:60]), "a"), (7, " ".join(words[100:160]), "a"), (7, " ".join(words[:60]), "a"), (8, " ".join(words[:59] + ["x"]), "a"), (None, " ".join(words[60:90]), "b")]
    for layout in (1, 5):
        got = cp.drop_near_duplicates(spark, docs(spark, rows).repartition(layout), SF01)
        assert sorted((str(r.doc_id), r.text[:4]) for r in got.collect()) == [("7", "w0 w"), ("7", "w100"), ("None", "w60 ")]


def test_edges(spark, tmp_path):
    rows = EDGES + [(20 + i, f"text number {i} of the table with more than twenty different words so that it may stay here {i} one two three four five", "z") for i in range(9)]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(21, 1, 0), (22, 0, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "text number 7 of the table with more than twenty"), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id for r in cp.run(spark, str(tmp_path)).collect()}
    assert 27 not in got and got <= {r[0] for r in rows} and not got & {2, 3, 4}

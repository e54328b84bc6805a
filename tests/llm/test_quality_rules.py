import re
from collections import Counter

from llm_cases import EDGES, SF01, docs
from pyspark.sql import functions as F

from sparkclust.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    hit = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
            n < 20 or 100 * len(hit) > 30 * n)


def stats(df, rules=None):
    return qr.judge(df, rules or qr.DecisionList()).select(
        "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def test_statistics_equal_brute_force(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet").where("length(text) < 9000")
    rows = stats(df).collect()
    assert len(rows) > 900
    for r in rows:
        assert tuple(r)[1:7] == brute(r.text), r.text[:80]


def test_edges(spark):
    extra = ["a b c d e f g h " * 3, "a b c d e f g h i a b c d e f g h", "\n\nx\n \nx\nx", "w " * 500, "a b c d e f g h\x0b" * 2 + "\x85   z"]
    df = docs(spark, EDGES + [(50 + i, t, "s") for i, t in enumerate(extra)])
    for r in stats(df).collect():
        assert tuple(r)[1:7] == brute(r.text)
        assert r.kept == (not r.base_failed)  # an empty list rejects nothing more
    assert stats(docs(spark, [])).count() == 0


def test_learned_list_separates_labelled_documents(spark):
    d = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    rules = qr.learn(d, labels)
    assert rules.rules
    got = qr.judge(d, rules).join(labels, "doc_id").where("not base_failed")
    good = got.agg(F.avg(F.when(F.col("quality") == 1, F.col("kept").cast("int"))), F.avg(F.when(F.col("quality") == 0, 1 - F.col("kept").cast("int")))).first()
    assert good[0] >= 0.99 and good[1] >= 0.8


def test_learning_without_rows_or_classes_keeps_everything(spark):
    d = docs(spark, EDGES)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert qr.learn(d, none).rules == []
    one = spark.createDataFrame([(1, 1), (5, 1), (None, 0), (6, None)], "doc_id long, quality int")
    assert qr.learn(d, one).rules == []


def test_grow_and_prune_find_a_planted_rule(spark):
    rows = [(int(x > 60 and y <= 20), i % 3, float(x), float(y)) for i, (x, y) in enumerate((x, y) for x in range(0, 100, 4) for y in range(0, 60, 3))]
    df = spark.createDataFrame(rows, "_bad int, _part int, x double, y double")
    for n in qr.FEATURES:
        df = df.withColumn(f"_f_{n}", F.col("x") if n == "n_words" else F.col("y") if n == "line_words" else F.lit(0.0))
    rules = qr.fit(df)
    wrong = df.where((rules.rule_number().isNotNull()).cast("int") != F.col("_bad")).count()
    assert wrong <= 0.05 * len(rows)


def test_no_python_in_the_plan(spark):
    plan = stats(spark.read.parquet(f"{SF01}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

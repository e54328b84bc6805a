import zlib

import numpy as np
from llm_cases import EDGES, SF1, SF01, docs
from pyspark.sql import functions as F

from sparkclust.llm import toxicity as tx


def test_gradient_equals_differences(monkeypatch):
    monkeypatch.setattr(tx, "WINDOW", 6)
    rng = np.random.default_rng(0)
    model = tx.fit([], [], 0.5)
    for k, v in model.p.items():
        model.p[k] = (v + rng.standard_normal(v.shape) * 0.05).astype(np.float64)
    data = np.frombuffer(b"you are a moron and so on he said once more", np.uint8)
    row, index, word, gram, owner = tx.tokens(data, np.array([0, data.size]))
    _, begin, size = np.zeros(2), np.array([0, 4]), np.array([6, 5])
    d = np.array([0.7, -0.4])

    def value():
        x = model.embed(word, gram, owner)
        return float(d @ model.forward(x, model.gates(x), index, begin, size))

    x = model.embed(word, gram, owner)
    _, kept = model.forward(x, model.gates(x), index, begin, size, keep=True)
    grad = model.backward(kept, d, word, gram, owner)
    for k, v in model.p.items():
        flat = np.flatnonzero(grad[k])
        for i in flat[:: max(1, flat.size // 4)][:4]:
            old = v.flat[i]
            v.flat[i] = old + 1e-4
            up = value()
            v.flat[i] = old - 1e-4
            down = value()
            v.flat[i] = old
            assert abs((up - down) / 2e-4 - grad[k].flat[i]) < 2e-3, k


def test_windows_cover_every_word():
    row = np.repeat([0, 1, 3], [tx.WINDOW * 3 + 5, 7, tx.WINDOW])
    owner, begin, size = tx.window_starts(row, 5)
    seen = np.zeros(row.size, bool)
    for o, b, s in zip(owner, begin, size):
        assert (row[b : b + s] == o).all()
        seen[b : b + s] = True
    assert seen.all()


def test_held_out_rows_follow_crc32(spark):
    got = {r.doc_id: r.h for r in spark.range(200).select(F.col("id").alias("doc_id")).select("doc_id", tx.held_out().alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)}


def test_held_out_accuracy(spark):
    d, labels = (spark.read.parquet(f"{SF1}/{t}.parquet") for t in ("documents", "labels"))
    got = tx.score(d, tx.learn(d, labels)).join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    score, truth = np.array([r.score for r in got]), np.array([r.toxic for r in got])
    pred = np.array([r.predicted for r in got])
    order = np.argsort(score)
    rank = np.empty(order.size)
    rank[order] = np.arange(order.size)
    auc = (rank[truth == 1].mean() - (truth.sum() - 1) / 2) / (truth == 0).sum()
    recall, precision = pred[truth == 1].mean(), truth[pred == 1].mean()
    assert auc > 0.9 and recall > 0.8 and precision > 0.8, (auc, recall, precision)


def test_edges(spark):
    d = docs(spark, EDGES)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in tx.score(d, tx.learn(d, none)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    assert {r.score for r in tx.score(d, tx.learn(d, one)).collect()} == {0.0}
    assert tx.score(docs(spark, []), tx.learn(d, none)).count() == 0
    both = spark.createDataFrame([(1, 1), (5, 0), (6, 0)], "doc_id long, toxic int")
    rows = tx.score(d, tx.learn(d, both)).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.score <= 1 for r in rows)


def test_scores_depend_on_the_text_alone(spark):
    d, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    model = tx.learn(d, labels)
    again = tx.learn(d.repartition(3), labels)
    a = {r.doc_id: r.score for r in tx.score(d, model).collect()}
    b = {r.doc_id - 10**6: r.score for r in tx.score(d.withColumn("doc_id", F.col("doc_id") + 10**6).repartition(5), again).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-5 for k in a)


def test_a_passage_lies_whole_in_a_window_wherever_it_stands():
    """Any passage of up to WINDOW - STRIDE words is inside some window, at every offset of a long text."""
    assert tx.STRIDE <= 16
    n = 300
    _, begin, size = tx.window_starts(np.zeros(n, np.int64), 1)
    for at in range(n - (tx.WINDOW - tx.STRIDE)):
        assert any(b <= at and at + tx.WINDOW - tx.STRIDE <= b + s for b, s in zip(begin, size))


def test_the_same_toxic_sentence_scores_alike_at_every_offset(spark):
    docs_ = spark.read.parquet(f"{SF1}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF1}/labels.parquet")
    model = tx.learn(docs_, labels)
    clean = [r.text for r in docs_.join(labels.where("toxic = 0"), "doc_id").where("length(text) between 1500 and 4000").orderBy("doc_id").limit(40).collect()]
    data = lambda ts: (np.frombuffer(b"".join(t.encode() for t in ts), np.uint8), np.concatenate(([0], np.cumsum([len(t.encode()) for t in ts]))))
    base = next(t for t, s in zip(clean, model.scores(*data(clean))) if s < 0.1).split()
    toxic = [r.text for r in docs_.join(labels.where("toxic = 1"), "doc_id").where("length(text) < 400").orderBy("doc_id").limit(40).collect()]
    if not toxic:
        return
    scored = sorted(zip(model.scores(*data(toxic)), toxic), reverse=True)
    passage = scored[0][1].split()[: tx.WINDOW - tx.STRIDE]
    texts = [" ".join(base[:k] + passage + base[k:]) for k in range(0, 120, 5)]
    got = model.scores(*data(texts))
    alone = model.scores(*data([" ".join(passage)]))[0]
    if alone > 0.8:
        assert got.min() > 0.3

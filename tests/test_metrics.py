import math

from sparkclust.operators import evaluate


def _pred(spark, pairs):
    return spark.createDataFrame([(i, l, p) for i, (l, p) in enumerate(pairs)], "id bigint, label int, cluster int")


def test_confusion_k2_golden(spark):
    # published train confusion matrix (k=2): TN 7064, FP 3, FN 1527, TP 206
    pairs = [(0, 0)] * 7064 + [(0, 1)] * 3 + [(1, 0)] * 1527 + [(1, 1)] * 206
    m = evaluate.classification_metrics(_pred(spark, pairs)).first()
    assert (m.tn, m.fp, m.fn, m.tp) == (7064, 3, 1527, 206)
    assert round(m.accuracy, 2) == 82.61
    assert round(m.tpr, 2) == 11.89
    assert round(m.ppv, 2) == 98.56
    assert round(m.tnr, 2) == 99.96


def test_three_ids_rule(spark):
    # label 0 / cluster 2 is a false positive, label 1 / cluster 2 a false negative
    m = evaluate.confusion(_pred(spark, [(0, 2), (1, 2), (2, 2)])).first()
    assert (m.fp, m.fn, m.tp, m.tn, m.correct) == (1, 1, 1, 0, 1)


def test_no_positive_inf_rules(spark):
    m = evaluate.classification_metrics(_pred(spark, [(0, 0), (0, 0)])).first()
    assert m.tpr == math.inf and m.ppv == math.inf and math.isnan(m.f1)
    assert m.accuracy == 100.0


def test_all_wrong(spark):
    m = evaluate.classification_metrics(_pred(spark, [(1, 0), (0, 1)])).first()
    assert m.tpr == 0.0 and m.ppv == 0.0 and m.f1 == math.inf


def test_metrics_report_format(spark):
    rep = evaluate.metrics_report(evaluate.classification_metrics(_pred(spark, [(1, 1), (0, 1), (0, 0)]))).collect()
    d = {r.metric: r.value for r in rep}
    assert d["Accuracy"] == "66.67%"
    assert d["True Positives"] == "1"
    assert d["F1 Score"] == "66.67%"


def test_metrics_report_special_values(spark):
    rep = evaluate.metrics_report(evaluate.classification_metrics(_pred(spark, [(0, 0), (0, 0)]))).collect()
    d = {r.metric: r.value for r in rep}
    assert d["True Positive Rate (sensitivity)"] == "inf%"
    assert d["Positive Prediction Value (precision)"] == "inf%"
    assert d["F1 Score"] == "nan%"
    assert d["Accuracy"] == "100.00%"

"""Golden formula fixtures: literal inputs whose expected values are read off
the detector's shipped reports (see FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from flowlens.operators import metrics_binary as MB
from flowlens.operators import metrics_multi as MM


def _scores(spark, groups):
    """groups: list of (score, label, count) -> rows."""
    rows = [(float(s), int(y)) for s, y, n in groups for _ in range(n)]
    return spark.createDataFrame(rows, "s double, y int").withColumn("g", F.lit("a"))


def test_ties_auc_and_average_precision(spark):
    df = _scores(spark, [(0.9, 1, 11), (0.5, 1, 2), (0.5, 0, 1), (0.1, 0, 2286)])
    r = MB.binary_report(df, ["g"], "s", "y", digits=None).first()
    assert r["roc_auc"] == pytest.approx(0.9999663650734925, abs=1e-12)
    assert r["pr_auc"] == pytest.approx(0.989010989010989, abs=1e-12)


def test_perfect_split_best_f1(spark):
    df = _scores(spark, [(0.99, 1, 1263), (0.01, 0, 298)])
    r = MB.binary_report(df, ["g"], "s", "y", digits=None).first()
    assert r["best_f1"] == pytest.approx(0.9999999999995, abs=1e-15)
    assert r["best_threshold"] == pytest.approx(0.99)
    assert r["roc_auc"] == 1.0


def test_recall_at_fpr_no_interpolation(spark):
    # highest score is a negative: no point with FPR <= 0.001 has any recall
    df = _scores(spark, [(0.95, 0, 1), (0.9, 1, 50), (0.2, 0, 501)])
    r = MB.binary_report(df, ["g"], "s", "y", digits=None).first()
    assert r["recall_at_fpr_001"] == 0.0
    assert r["recall_at_fpr_01"] == 1.0


def test_class_weight(spark):
    df = _scores(spark, [(0.5, 0, 1536), (0.5, 1, 5746)])
    r = MB.class_weight(df, ["g"], "y").first()
    assert r["scale_pos_weight"] == pytest.approx(0.2673163940132266, abs=1e-6)


def test_one_class_note(spark):
    df = _scores(spark, [(0.2, 0, 10), (0.7, 0, 5)])
    r = MB.one_class_eval(df, ["g"], "s", "y").first()
    assert r["note"] == "single_class"
    assert r["accuracy_default_thresh"] == pytest.approx(10 / 15, abs=1e-6)
    assert MB.binary_report(df, ["g"], "s", "y").first()["roc_auc"] is None


def _pairs(spark, matrix):
    rows = [("a", y, p, n) for y, row in enumerate(matrix) for p, n in enumerate(row) if n]
    return spark.createDataFrame(rows, "g string, y int, pred int, n long")


def test_absent_classes_macro_f1(spark):
    cm = [[1229515, 0, 0, 0, 5], [0, 0, 0, 0, 0], [1, 0, 0, 0, 0], [0, 0, 0, 0, 0], [337632, 0, 0, 0, 0]]
    r = MM.accuracy_f1_from_pairs(_pairs(spark, cm), ["g"], digits=None).first()
    assert r["accuracy"] == pytest.approx(0.7845532631466104, abs=1e-12)
    assert r["f1_macro"] == pytest.approx(0.29309044429537817, abs=1e-12)
    assert r["f1_weighted"] == pytest.approx(0.6898379987213501, abs=1e-12)


def test_unseen_label_stays_in_f1_but_leaves_matrix(spark):
    rows = [("a", 0, [0.9, 0.05, 0.05])] * 35 + [("a", 3, [0.8, 0.1, 0.1])]
    df = spark.createDataFrame(rows, "g string, y int, probs array<double>")
    sc = MM.with_prediction(df, "probs", "y", 3)
    r = MM.accuracy_f1(sc, ["g"], "y", digits=None).first()
    assert r["accuracy"] == pytest.approx(0.9722222, abs=1e-6)
    assert r["f1_macro"] == pytest.approx(0.4929577, abs=1e-6)
    cm = MM.confusion_matrix(sc, ["g"], "y", 3)
    assert cm.agg(F.sum("n")).first()[0] == 35
    assert cm.count() == 9
    es = MM.eval_summary(sc, ["g"], "probs", "y", 3).first()
    assert es["n_outside"] == 1
    assert es["logloss"] is None


def test_degenerate_multiclass(spark):
    df = spark.createDataFrame([("a", 0, [1.0])] * 4, "g string, y int, probs array<double>")
    sc = MM.with_prediction(df, "probs", "y", 1)
    r = MM.eval_summary(sc, ["g"], "probs", "y", 1).first()
    assert r["note"] == "degenerate_num_class_1"
    assert r["f1_macro"] is None and r["f1_weighted"] is None
    assert r["logloss"] == 0.0
    assert r["accuracy"] == 1.0


def test_empty_evaluation_note(spark):
    df = spark.createDataFrame([], "y int, probs array<double>")
    sc = MM.with_prediction(df, "probs", "y", 3)
    r = MM.eval_summary(sc, [], "probs", "y", 3).first()
    assert r["n"] == 0 and r["note"] == "no_rows"


def test_chosen_threshold_one_class_validation(spark):
    two = _scores(spark, [(0.8, 1, 5), (0.3, 0, 5)]).withColumn("g", F.lit("two"))
    one = _scores(spark, [(0.8, 0, 4)]).withColumn("g", F.lit("one"))
    val = MB.binary_report(two.unionByName(one), ["g"], "s", "y")
    got = {r.g: r.chosen_threshold for r in MB.chosen_threshold(val, ["g"]).collect()}
    assert got == {"two": 0.8, "one": 0.5}

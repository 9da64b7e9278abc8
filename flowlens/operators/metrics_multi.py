"""Multiclass evaluation (A10-A17, A35-A37) grouped by keys.

The only pass over the scored rows is one aggregate to (group, y, pred) pair
counts plus one scalar aggregate; every per-class figure is derived from the
small pair table. Macro F1 averages over the labels seen in truth or
prediction (not over K); labels outside 0..K-1 stay in accuracy and F1 but
leave the confusion matrix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.constants import LOGLOSS_EPS


def argmax(probs: Column) -> Column:
    """0-based arg-max, first class on ties."""
    return F.array_position(probs, F.array_max(probs)) - 1


def with_prediction(df: DataFrame, probs: str, label: str, num_class: int,
                    pred_out: str = "pred") -> DataFrame:
    """Add the predicted class and ``p_true`` (null when the label is outside 0..K-1).

    A one-class model (K <= 1) predicts 0 (A16)."""
    y = F.col(label)
    inside = (y >= 0) & (y < num_class)
    pred = argmax(F.col(probs)) if num_class > 1 else F.lit(0)
    return df.withColumns({
        pred_out: pred.cast("int"),
        "p_true": F.when(inside, F.try_element_at(F.col(probs), (y + 1).cast("int"))),
    })


def pair_counts(scored: DataFrame, by, label: str, pred: str = "pred") -> DataFrame:
    return scored.groupBy(*by, F.col(label).alias("y"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(scored: DataFrame, by, label: str, num_class: int, pred: str = "pred") -> DataFrame:
    """Counts over the full K x K grid per group (zeros kept), for any K.
    Labels outside 0..K-1 leave the matrix; a group of such labels only has a
    grid of zeros."""
    return confusion_from_pairs(pair_counts(scored, by, label, pred), by, num_class)


def confusion_from_pairs(pairs: DataFrame, by, num_class: int) -> DataFrame:
    """The K x K grid from (group, y, pred, n) cells in one pass: each group's
    cells (at most K^2 of them) become a map, the grid is generated by
    ``sequence`` and looked up, so there is no join and no second scan."""
    k = num_class
    inside = (F.col("y") >= 0) & (F.col("y") < k) & (F.col("pred") >= 0) & (F.col("pred") < k)
    cells = pairs.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.when(inside,
        F.struct((F.col("y") * k + F.col("pred")).alias("c"), F.col("n"))))).alias("_m"))
    seq = F.sequence(F.lit(0), F.lit(k - 1))
    grid = cells.withColumn("y", F.explode(seq)).withColumn("pred", F.explode(seq))
    return grid.select(*by, "y", "pred",
                       F.coalesce(F.try_element_at("_m", F.col("y") * k + F.col("pred")),
                                  F.lit(0).cast("long")).alias("n"))


def class_table(scored: DataFrame, by, label: str, pred: str = "pred") -> DataFrame:
    """Per group and label in truth or prediction: tp, support, predicted."""
    return class_table_from_pairs(pair_counts(scored, by, label, pred), by)


def class_table_from_pairs(pairs: DataFrame, by) -> DataFrame:
    """Same, from (by..., y, pred, n) pair counts (e.g. a stored confusion matrix)."""
    zero = F.lit(0).cast("long")
    roles = F.array(
        F.struct(F.col("y").alias("cls"), F.col("n").alias("support"), zero.alias("predicted"),
                 F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(zero).alias("tp")),
        F.struct(F.col("pred").alias("cls"), zero.alias("support"), F.col("n").alias("predicted"),
                 zero.alias("tp")))
    return (pairs.select(*by, F.inline(roles))
            .groupBy(*by, "cls").agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"),
                                      F.sum("predicted").alias("predicted")))


def _prf(ct: DataFrame) -> DataFrame:
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    ct = ct.withColumns({"precision": p, "recall": r})
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                F.lit(2.0) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return ct.withColumn("f1", f1)


def per_class(scored: DataFrame, by, label: str, pred: str = "pred") -> DataFrame:
    """Precision, recall, F1 and support per class."""
    ct = _prf(class_table(scored, by, label, pred))
    return ct.select(*by, "cls", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                     "support")


def accuracy_f1(scored: DataFrame, by, label: str, pred: str = "pred", digits: int | None = 6) -> DataFrame:
    """Accuracy, macro F1 (labels in truth or prediction) and
    support-weighted F1."""
    return accuracy_f1_from_pairs(pair_counts(scored, by, label, pred), by, digits)


def accuracy_f1_from_pairs(pairs: DataFrame, by, digits: int | None = 6) -> DataFrame:
    def rnd(c):
        return F.round(c, digits) if digits is not None else c
    ct = _prf(class_table_from_pairs(pairs, by))
    m = ct.groupBy(*by).agg(F.sum("support").alias("n"), F.sum("tp").alias("_tp"),
                            F.avg("f1").alias("_macro"),
                            F.sum(F.col("f1") * F.col("support")).alias("_wsum"),
                            F.max("support").alias("_maxs"))
    return m.select(*by, "n",
                    rnd(F.col("_tp") / F.col("n")).alias("accuracy"),
                    rnd(F.col("_macro")).alias("f1_macro"),
                    rnd(F.col("_wsum") / F.col("n")).alias("f1_weighted"),
                    rnd(F.col("_maxs") / F.col("n")).alias("majority_class_share"))


def cell_stats(scored: DataFrame, by, probs: str, label: str, num_class: int,
               pred: str = "pred", ks=(2, 3)) -> DataFrame:
    """The one pass over scored rows: (group, y, pred) cells with their count
    and every row-level sum the suite needs (log loss, top-k hits, mean class
    probability). All further figures come from this small table."""
    pt = F.col("p_true")
    higher = F.size(F.filter(F.col(probs), lambda p: p > pt))
    aggs = [F.count(F.lit(1)).alias("n"),
            F.sum(-F.log(F.least(F.greatest(pt, F.lit(LOGLOSS_EPS)), F.lit(1.0 - LOGLOSS_EPS)))).alias("_ll"),
            F.sum(F.aggregate(F.col(probs), F.lit(0.0), lambda a, x: a + x) / F.lit(float(num_class))).alias("_pm")]
    for k in ks:
        aggs.append(F.sum((pt.isNotNull() & (higher < k)).cast("long")).alias(f"_top{k}"))
    return scored.groupBy(*by, F.col(label).alias("y"), F.col(pred).alias("pred")).agg(*aggs)


def row_metrics(scored: DataFrame, by, probs: str, label: str, num_class: int, ks=(2, 3)) -> DataFrame:
    """Top-k accuracy, log loss (null when a label lies
    outside 0..K-1), mean class probability, mean predicted class, classes in
    test."""
    return row_metrics_from_cells(cell_stats(scored, by, probs, label, num_class, ks=ks), by, num_class, ks)


def row_metrics_from_cells(cells: DataFrame, by, num_class: int, ks=(2, 3)) -> DataFrame:
    y = F.col("y")
    n = F.col("n")
    m = cells.groupBy(*by).agg(
        F.coalesce(F.sum(n), F.lit(0).cast("long")).alias("n"),
        F.countDistinct(y).alias("n_classes_in_test"),
        F.coalesce(F.sum(F.when((y < 0) | (y >= num_class), n)), F.lit(0).cast("long")).alias("_outside"),
        F.sum("_ll").alias("_ll"), F.sum("_pm").alias("_pm"),
        F.sum(F.col("pred") * n).alias("_pc"),
        *[F.sum(f"_top{k}").alias(f"_top{k}") for k in ks])
    tot = F.col("n").cast("double")
    ll = F.when(F.col("_outside") > 0, F.lit(None).cast("double"))
    ll = ll.otherwise(F.lit(0.0)) if num_class <= 1 else ll.otherwise(F.round(F.col("_ll") / tot, 6))
    return m.select(*by, "n", "n_classes_in_test", "_outside",
                    *[F.round(F.col(f"_top{k}") / tot, 6).alias(f"top{k}_accuracy") for k in ks],
                    ll.alias("logloss"),
                    F.round(F.col("_pm") / tot, 6).alias("probs_mean"),
                    F.round(F.col("_pc") / tot, 6).alias("predicted_class_mean"))


def eval_summary(scored: DataFrame, by, probs: str, label: str, num_class: int) -> DataFrame:
    """M11 summary row per group; A16 degenerate and A17 empty notes.

    One linear pipeline, no branches: rows -> (group, y, pred) cells ->
    per-class rows (the row-level sums ride on the truth-role entry, so each
    cell is counted once) -> one row per group.
    """
    by = list(by)
    ks = (2, 3)
    cells = cell_stats(scored, by, probs, label, num_class, ks=ks)
    zero_l, zero_d = F.lit(0).cast("long"), F.lit(0.0)
    y, p, n = F.col("y"), F.col("pred"), F.col("n")
    sums = ["_ll", "_pm", "_pc"] + [f"_top{k}" for k in ks]
    truth = F.struct(y.alias("cls"), n.alias("support"), zero_l.alias("predicted"),
                     F.when(y == p, n).otherwise(zero_l).alias("tp"),
                     F.when((y < 0) | (y >= num_class), n).otherwise(zero_l).alias("outside"),
                     F.coalesce(F.col("_ll"), zero_d).alias("_ll"), F.col("_pm").alias("_pm"),
                     (p * n).cast("double").alias("_pc"),
                     *[F.col(f"_top{k}").cast("double").alias(f"_top{k}") for k in ks])
    guess = F.struct(p.alias("cls"), zero_l.alias("support"), n.alias("predicted"), zero_l.alias("tp"),
                     zero_l.alias("outside"), zero_d.alias("_ll"), zero_d.alias("_pm"), zero_d.alias("_pc"),
                     *[zero_d.alias(f"_top{k}") for k in ks])
    ct = (cells.select(*by, F.inline(F.array(truth, guess)))
          .groupBy(*by, "cls").agg(*[F.sum(c).alias(c) for c in ["tp", "support", "predicted", "outside"] + sums]))
    ct = _prf(ct)
    g = ct.groupBy(*by).agg(
        F.coalesce(F.sum("support"), zero_l).alias("n"),
        F.sum((F.col("support") > 0).cast("long")).alias("n_classes_in_test"),
        F.coalesce(F.sum("outside"), zero_l).alias("_outside"),
        F.sum("tp").alias("_tp"), F.avg("f1").alias("_macro"),
        F.sum(F.col("f1") * F.col("support")).alias("_wsum"), F.max("support").alias("_maxs"),
        *[F.sum(c).alias(c) for c in sums])
    tot = F.col("n").cast("double")
    ll = F.when(F.col("_outside") > 0, F.lit(None).cast("double"))
    ll = ll.otherwise(F.lit(0.0)) if num_class <= 1 else ll.otherwise(F.round(F.col("_ll") / tot, 6))
    out = g.select(*by, "n", "n_classes_in_test", "_outside",
                   F.round(F.col("_maxs") / tot, 6).alias("majority_class_share"),
                   F.round(F.col("_tp") / tot, 6).alias("accuracy"),
                   *[F.round(F.col(f"_top{k}") / tot, 6).alias(f"top{k}_accuracy") for k in ks],
                   ll.alias("logloss"),
                   F.round("_macro", 6).alias("f1_macro"),
                   F.round(F.col("_wsum") / tot, 6).alias("f1_weighted"),
                   F.round(F.col("_pm") / tot, 6).alias("probs_mean"),
                   F.round(F.col("_pc") / tot, 6).alias("predicted_class_mean"))
    note = (F.when(F.col("n") == 0, F.lit("no_rows"))
            .when(F.lit(num_class <= 1), F.lit("degenerate_num_class_1")))
    f1m = F.when(F.lit(num_class > 1), F.col("f1_macro"))
    f1w = F.when(F.lit(num_class > 1), F.col("f1_weighted"))
    return out.select(*by, "n", "n_classes_in_test", "majority_class_share", "accuracy",
                      F.round(F.lit(1.0) - F.col("accuracy"), 6).alias("top1_error"),
                      "top2_accuracy", "top3_accuracy", "logloss", f1m.alias("f1_macro"),
                      f1w.alias("f1_weighted"), "probs_mean", "predicted_class_mean",
                      F.col("_outside").alias("n_outside"), note.alias("note"))

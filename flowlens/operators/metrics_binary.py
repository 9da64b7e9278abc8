"""Binary evaluation (A22, A27-A34, A38) over scored rows grouped by keys.

Ranked metrics come from ``cumulative_by_score`` (ties collapsed first,
skew-safe prefix sums); threshold metrics are one conditional aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.constants import DEFAULT_THRESHOLD, F1_EPS, FPR_LIMITS
from flowlens.operators.ordered import cumulative_by_score


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def ranked_metrics(cum: DataFrame, group_cols, fpr_limits=FPR_LIMITS, digits: int | None = 6) -> DataFrame:
    """Per group: ROC-AUC (ties count half), average precision (step form),
    best F1 = 2PR/(P+R+1e-12) with its threshold (lowest threshold on equal F1),
    and recall at FPR <= x (best TPR, no interpolation, 0 when none).
    Null AUC when a class is missing; null AP when there are no positives."""
    prec = _div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _div(F.col("tp"), F.col("P"))
    f1 = F.lit(2.0) * prec * rec / (prec + rec + F.lit(F1_EPS))
    aggs = [
        F.first("P").alias("P"), F.first("N").alias("N"),
        F.sum(F.col("pos") * (F.col("N") - F.col("fp") + F.lit(0.5) * F.col("neg"))).alias("_auc_num"),
        F.sum(_div(F.col("pos"), F.col("P")) * prec).alias("_ap"),
        F.max(F.struct(f1.alias("f1"), (-F.col("s")).alias("neg_s"))).alias("_best"),
    ]
    for i, x in enumerate(fpr_limits):
        aggs.append(F.max(F.when(_div(F.col("fp"), F.col("N")) <= F.lit(x), rec)).alias(f"_r{i}"))
    m = cum.groupBy(*group_cols).agg(*aggs)

    def rnd(c):
        return F.round(c, digits) if digits is not None else c

    out = [*group_cols,
           F.col("P").alias("n_pos"), F.col("N").alias("n_neg"),
           F.when((F.col("P") > 0) & (F.col("N") > 0),
                  rnd(_div(F.col("_auc_num"), F.col("P") * F.col("N")))).alias("roc_auc"),
           F.when(F.col("P") > 0, rnd(F.col("_ap"))).alias("pr_auc"),
           F.when(F.col("P") > 0, rnd(F.col("_best.f1"))).alias("best_f1"),
           F.when(F.col("P") > 0, rnd(-F.col("_best.neg_s"))).alias("best_threshold")]
    for i, x in enumerate(fpr_limits):
        name = "recall_at_fpr_" + str(x).replace("0.", "")
        out.append(F.when(F.col("N") > 0, rnd(F.coalesce(F.col(f"_r{i}"), F.lit(0.0)))).alias(name))
    return m.select(*out)


def binary_report(df: DataFrame, group_cols, score: str, label: str, digits: int | None = 6) -> DataFrame:
    """Ranked metrics of scored rows per group (see ``ranked_metrics``)."""
    return ranked_metrics(cumulative_by_score(df, group_cols, score, label), group_cols, digits=digits)


def confusion_at(df: DataFrame, group_cols, score: str, label: str,
                 threshold: float | Column = DEFAULT_THRESHOLD) -> DataFrame:
    """Confusion counts and accuracy at a threshold (score >= t is
    positive), precision/recall/F1 with a zero denominator replaced by 1, and
    the mean score."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = (F.col(score) >= t).cast("int")
    y = F.col(label)

    def cnt(c):
        return F.sum(c.cast("long"))

    m = df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        cnt((y == 0) & (pred == 0)).alias("tn"), cnt((y == 0) & (pred == 1)).alias("fp"),
        cnt((y == 1) & (pred == 0)).alias("fn"), cnt((y == 1) & (pred == 1)).alias("tp"),
        F.avg(score).alias("_pm"))

    def nz(c):
        return F.when(c == 0, F.lit(1)).otherwise(c)

    prec = F.col("tp") / nz(F.col("tp") + F.col("fp"))
    rec = F.col("tp") / nz(F.col("tp") + F.col("fn"))
    return m.select(*group_cols, "n", "tn", "fp", "fn", "tp",
                    F.round((F.col("tn") + F.col("tp")) / F.col("n"), 6).alias("accuracy"),
                    F.round(prec, 6).alias("precision"), F.round(rec, 6).alias("recall"),
                    F.round(F.lit(2.0) * prec * rec / nz(prec + rec), 6).alias("f1"),
                    F.round("_pm", 6).alias("probs_mean"))


def class_weight(df: DataFrame, group_cols, label: str) -> DataFrame:
    """Negatives / positives per group (null without positives)."""
    y = F.col(label)
    m = df.groupBy(*group_cols).agg(F.sum((y == 0).cast("long")).alias("neg"),
                                    F.sum((y == 1).cast("long")).alias("pos"))
    return m.select(*group_cols, "neg", "pos", F.round(_div(F.col("neg"), F.col("pos")), 6).alias("scale_pos_weight"))


def one_class_eval(df: DataFrame, group_cols, score: str, label: str,
                   threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """A group with one label value gets note ``single_class`` and only the
    accuracy at the default threshold; other groups get no note."""
    y = F.col(label)
    pred = (F.col(score) >= F.lit(float(threshold))).cast("int")
    m = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n"),
                                    F.sum(y.cast("long")).alias("n_pos"),
                                    F.avg((pred == y).cast("double")).alias("_acc"))
    single = (F.col("n_pos") == 0) | (F.col("n_pos") == F.col("n"))
    return m.select(*group_cols, "n", "n_pos",
                    F.when(single, F.lit("single_class")).alias("note"),
                    F.round("_acc", 6).alias("accuracy_default_thresh"))


def chosen_threshold(val_metrics: DataFrame, group_cols) -> DataFrame:
    """The validation best-F1 threshold, 0.5 when validation has one class."""
    one_class = (F.col("n_pos") == 0) | (F.col("n_neg") == 0)
    return val_metrics.select(*group_cols,
                              F.when(one_class, F.lit(DEFAULT_THRESHOLD))
                               .otherwise(F.col("best_threshold")).alias("chosen_threshold"))

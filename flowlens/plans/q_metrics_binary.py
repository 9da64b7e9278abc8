"""Registered queries: binary evaluation over flows_l scored by the metric models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.operators import metrics_binary as MB
from flowlens.plans import sqltext as S
from flowlens.plans.fixed_models import METRIC_MODELS
from flowlens.plans.q_scoring import scored_l
from flowlens.plans.registry import query

GROUP = ["dataset", "model"]


def long_scores(spark: SparkSession, sf: str) -> DataFrame:
    """(dataset, model, s, y_binary): one row per flow and metric model."""
    sc = scored_l(spark, sf)
    rows = F.array(*[F.struct(F.lit(m.name).alias("model"), F.col(f"p_{m.name}").alias("s"))
                     for m in METRIC_MODELS])
    return sc.select("dataset", "y_binary", F.inline(rows))


def _feats():
    feats = []
    for m in METRIC_MODELS:
        feats += [f for f in m.features if f not in feats]
    return feats


LONG_SQL = [
    S.FLOWS_L,
    S.feats_cte("feats", "flows_l", _feats(), ["dataset", "y_binary"], S.L_TYPES),
    "lng AS (" + " UNION ALL ".join(
        f"SELECT dataset, {S.lit(m.name)} AS model, {S.model_expr(m)} AS s, y_binary AS y FROM feats"
        for m in METRIC_MODELS) + ")",
]
CUM_SQL = LONG_SQL + S.ranked_sql("lng", ["dataset", "model"], "s", "y", "")


def _ranked(spark, sf):
    return MB.binary_report(long_scores(spark, sf), GROUP, "s", "y_binary")


@query("binary_auc", S.with_(*CUM_SQL) + "SELECT dataset, model, n_pos, n_neg, roc_auc FROM m")
def binary_auc(spark: SparkSession, sf: str) -> DataFrame:
    """ROC-AUC per (dataset, model), ties counted half."""
    return _ranked(spark, sf).select(*GROUP, "n_pos", "n_neg", "roc_auc")


@query("avg_precision", S.with_(*CUM_SQL) + "SELECT dataset, model, pr_auc FROM m")
def avg_precision(spark: SparkSession, sf: str) -> DataFrame:
    """Average precision, step form."""
    return _ranked(spark, sf).select(*GROUP, "pr_auc")


@query("best_f1_threshold", S.with_(*CUM_SQL) + "SELECT dataset, model, best_f1, best_threshold FROM m")
def best_f1_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """Best F1 and its threshold."""
    return _ranked(spark, sf).select(*GROUP, "best_f1", "best_threshold")


@query("recall_at_fpr", S.with_(*CUM_SQL) +
       "SELECT dataset, model, recall_at_fpr_01, recall_at_fpr_005, recall_at_fpr_001 FROM m")
def recall_at_fpr(spark: SparkSession, sf: str) -> DataFrame:
    """Recall at FPR <= 0.01 / 0.005 / 0.001, no interpolation."""
    return _ranked(spark, sf).select(*GROUP, "recall_at_fpr_01", "recall_at_fpr_005", "recall_at_fpr_001")


CONF_SQL = S.with_(*LONG_SQL, "p AS (SELECT *, CAST(s >= 0.5 AS INTEGER) AS pr FROM lng)",
                   f"""k AS (SELECT dataset, model, {S.B('count(*)')} AS n,
      {S.B('sum(CAST(y = 0 AND pr = 0 AS INTEGER))')} AS tn, {S.B('sum(CAST(y = 0 AND pr = 1 AS INTEGER))')} AS fp,
      {S.B('sum(CAST(y = 1 AND pr = 0 AS INTEGER))')} AS fn, {S.B('sum(CAST(y = 1 AND pr = 1 AS INTEGER))')} AS tp,
      avg(s) AS pm FROM p GROUP BY dataset, model)""",
                   """z AS (SELECT *, tp / CASE WHEN tp + fp = 0 THEN 1 ELSE tp + fp END AS prec,
      tp / CASE WHEN tp + fn = 0 THEN 1 ELSE tp + fn END AS rec FROM k)""") + \
    """SELECT dataset, model, n, tn, fp, fn, tp, round((tn + tp) / n, 6) AS accuracy,
      round(prec, 6) AS precision, round(rec, 6) AS recall,
      round(2.0 * prec * rec / CASE WHEN prec + rec = 0 THEN 1 ELSE prec + rec END, 6) AS f1,
      round(pm, 6) AS probs_mean FROM z"""


@query("confusion_at_threshold", CONF_SQL)
def confusion_at_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """Confusion counts, accuracy, P/R/F1 and mean score at 0.5."""
    return MB.confusion_at(long_scores(spark, sf), GROUP, "s", "y_binary", 0.5)


@query("class_weight", S.with_(S.FLOWS_L) + f"""SELECT dataset, {S.B('sum(CAST(y_binary = 0 AS INTEGER))')} AS neg,
    {S.B('sum(CAST(y_binary = 1 AS INTEGER))')} AS pos,
    round(CASE WHEN sum(y_binary) > 0 THEN {S.D('sum(CAST(y_binary = 0 AS INTEGER))')} / sum(y_binary) END, 6)
      AS scale_pos_weight FROM flows_l GROUP BY dataset""")
def class_weight(spark: SparkSession, sf: str) -> DataFrame:
    """Negatives / positives per dataset."""
    from flowlens.sources.views import flows_l
    return MB.class_weight(flows_l(spark, sf), ["dataset"], "y_binary")


M0 = METRIC_MODELS[0]


ONE_CLASS_SQL = S.with_(
    S.FLOWS_L, S.feats_cte("fe", "flows_l", list(M0.features), ["y_binary"], S.L_TYPES),
    f"""k AS (SELECT resp_bytes, {S.B('count(*)')} AS n, {S.B('sum(y_binary)')} AS n_pos,
        avg(CAST(CAST({S.model_expr(M0)} >= 0.5 AS INTEGER) = y_binary AS DOUBLE)) AS acc
        FROM fe GROUP BY resp_bytes)""") + \
    """SELECT resp_bytes, n, n_pos, CASE WHEN n_pos = 0 OR n_pos = n THEN 'single_class' END AS note,
       round(acc, 6) AS accuracy_default_thresh FROM k"""


@query("one_class_eval", ONE_CLASS_SQL)
def one_class_eval(spark: SparkSession, sf: str) -> DataFrame:
    """Groups (by quantity) with one label get note single_class and accuracy only."""
    from flowlens.functions.encode import prepare_features
    from flowlens.sources.views import flows_l
    prepared = prepare_features(flows_l(spark, sf), list(M0.features), keep=("y_binary",))
    return MB.one_class_eval(prepared.withColumn("s", M0.expr()), ["resp_bytes"], "s", "y_binary")

"""Registered queries: multiclass evaluation of the fixed 6-class model on flows_e."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlens.functions.encode import prepare_features
from flowlens.operators import metrics_multi as MM
from flowlens.plans import sqltext as S
from flowlens.plans.fixed_models import EVAL_MULTI
from flowlens.plans.registry import query
from flowlens.sources.views import flows_e

K = EVAL_MULTI.num_class
BY = ["dataset"]


def scored_multi(spark: SparkSession, sf: str) -> DataFrame:
    prepared = prepare_features(flows_e(spark, sf), EVAL_MULTI.features, keep=("dataset", "y_multiclass"))
    probs = EVAL_MULTI.class_probs(prepared, "probs")
    return MM.with_prediction(probs, "probs", "y_multiclass", K)


BASE = [
    S.FLOWS_E,
    S.feats_cte("fe", "flows_e", EVAL_MULTI.features, ["dataset", "y_multiclass"], S.E_TYPES),
    f"pr AS (SELECT dataset, y_multiclass AS y, {S.probs_expr(EVAL_MULTI)} AS probs FROM fe)",
    f"""sc AS (SELECT *, {S.argmax0('probs')} AS pred,
          CASE WHEN y >= 0 AND y < {K} THEN probs[y + 1] END AS p_true FROM pr)""",
    f"pairs AS (SELECT dataset, y, pred, {S.B('count(*)')} AS n FROM sc GROUP BY ALL)",
    f"""ct AS (SELECT dataset, cls, {S.B('sum(tp)')} AS tp, {S.B('sum(support)')} AS support,
          {S.B('sum(predicted)')} AS predicted FROM (
          SELECT dataset, y AS cls, n AS support, 0 AS predicted, CASE WHEN y = pred THEN n ELSE 0 END AS tp FROM pairs
          UNION ALL SELECT dataset, pred AS cls, 0, n, 0 FROM pairs) GROUP BY ALL)""",
    """prf AS (SELECT *, p2 AS precision, r2 AS recall,
          CASE WHEN p2 + r2 > 0 THEN 2.0 * p2 * r2 / (p2 + r2) ELSE 0.0 END AS f1 FROM (
          SELECT *, CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / predicted ELSE 0.0 END AS p2,
                    CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0.0 END AS r2 FROM ct))""",
    f"""af AS (SELECT dataset, {S.B('sum(support)')} AS n, round(sum(tp) / sum(support), 6) AS accuracy,
          round(avg(f1), 6) AS f1_macro, round(sum(f1 * support) / sum(support), 6) AS f1_weighted,
          round(max(support) / sum(support), 6) AS majority_class_share FROM prf GROUP BY dataset)""",
    f"""rm AS (SELECT dataset, {S.B('count(*)')} AS n, {S.B('count(DISTINCT y)')} AS n_classes_in_test,
          {S.B(f'sum(CAST(y < 0 OR y >= {K} AS INTEGER))')} AS n_outside,
          round(avg(CAST(p_true IS NOT NULL AND len(list_filter(probs, lambda x: x > p_true)) < 2 AS DOUBLE)), 6) AS top2_accuracy,
          round(avg(CAST(p_true IS NOT NULL AND len(list_filter(probs, lambda x: x > p_true)) < 3 AS DOUBLE)), 6) AS top3_accuracy,
          CASE WHEN sum(CAST(y < 0 OR y >= {K} AS INTEGER)) > 0 THEN NULL
               ELSE round(avg(-ln(least(greatest(p_true, 1e-15), 1.0 - 1e-15))), 6) END AS logloss,
          round(avg(list_sum(probs) / {S.num(K)}), 6) AS probs_mean,
          round(avg(CAST(pred AS DOUBLE)), 6) AS predicted_class_mean FROM sc GROUP BY dataset)""",
]


@query("confusion_matrix", S.with_(*BASE, f"""grid AS (SELECT d.dataset, CAST(a.i AS INTEGER) AS y, CAST(b.i AS INTEGER) AS pred
    FROM (SELECT DISTINCT dataset FROM sc) d, range({K}) a(i), range({K}) b(i))""") +
       """SELECT g.dataset, g.y, g.pred, coalesce(p.n, 0) AS n FROM grid g
          LEFT JOIN pairs p ON g.dataset = p.dataset AND g.y = p.y AND g.pred = p.pred""")
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """K x K confusion counts per dataset, zeros kept."""
    return MM.confusion_matrix(scored_multi(spark, sf), BY, "y_multiclass", K)


@query("accuracy_f1", S.with_(*BASE) + "SELECT dataset, n, accuracy, f1_macro, f1_weighted FROM af")
def accuracy_f1(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy, macro F1 over seen labels, weighted F1."""
    return MM.accuracy_f1(scored_multi(spark, sf), BY, "y_multiclass").drop("majority_class_share")


@query("per_class", S.with_(*BASE) + """SELECT dataset, cls, round(precision, 6) AS precision,
    round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM prf""")
def per_class(spark: SparkSession, sf: str) -> DataFrame:
    """Per-class precision, recall, F1, support."""
    return MM.per_class(scored_multi(spark, sf), BY, "y_multiclass")


@query("topk_accuracy", S.with_(*BASE) + "SELECT dataset, top2_accuracy, top3_accuracy FROM rm")
def topk_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """True class within the k most probable (strictly higher classes < k)."""
    return MM.row_metrics(scored_multi(spark, sf), BY, "probs", "y_multiclass", K) \
        .select("dataset", "top2_accuracy", "top3_accuracy")


@query("logloss", S.with_(*BASE) + "SELECT dataset, logloss, probs_mean FROM rm")
def logloss(spark: SparkSession, sf: str) -> DataFrame:
    """Clipped log loss and mean class probability."""
    return MM.row_metrics(scored_multi(spark, sf), BY, "probs", "y_multiclass", K) \
        .select("dataset", "logloss", "probs_mean")


@query("eval_summary", S.with_(*BASE) + """SELECT rm.dataset, rm.n, n_classes_in_test, majority_class_share,
    accuracy, round(1.0 - accuracy, 6) AS top1_error, top2_accuracy, top3_accuracy, logloss, f1_macro,
    f1_weighted, probs_mean, predicted_class_mean, n_outside, CAST(NULL AS VARCHAR) AS note
    FROM rm LEFT JOIN af ON rm.dataset = af.dataset""")
def eval_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The evaluation summary row per dataset."""
    return MM.eval_summary(scored_multi(spark, sf), BY, "probs", "y_multiclass", K)

"""Registered queries: the scoring report in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlens.functions.encode import feature_union
from flowlens.operators.ensemble import ordered
from flowlens.operators.scoring_report import report_lines, scoring_report
from flowlens.operators.variants import two_stage, usable
from flowlens.plans import sqltext as S
from flowlens.plans.fixed_models import full_ensemble
from flowlens.plans.q_scoring import BIN, MUL, _model_stats_cte, _s2_sql, scored_e
from flowlens.plans.registry import query
from flowlens.sources.views import flows_e

_NONE = ("CAST(NULL AS VARCHAR) AS top_model, CAST(NULL AS DOUBLE) AS top_model_conf, CAST(NULL AS VARCHAR) AS variant, "
         "CAST(NULL AS DOUBLE) AS variant_confidence")
_NO_VALUE, _NO_N, _NO_POS = "CAST(NULL AS DOUBLE) AS value", "CAST(NULL AS BIGINT) AS n", "CAST(NULL AS BIGINT) AS pos"


def _report_sql(models=BIN, multi=MUL, features=None) -> str:
    totals = " UNION ALL ".join(
        f"SELECT 'totals' AS part, {S.lit(name)} AS name, {_NO_POS}, {S.B(e)} AS n, {_NO_VALUE}, {_NONE} FROM s2"
        for name, e in (("total", "count(*)"), ("benign", "count(*) - coalesce(sum(pred), 0)"),
                        ("malicious", "coalesce(sum(pred), 0)"), ("multiclass_models_used", f"any_value({len(multi)})")))
    return S.with_(*_s2_sql(models=models, multi=multi, features=features), _model_stats_cte(models)) + f"""{totals}
UNION ALL SELECT 'totals', 'threat_pct', NULL, NULL, coalesce(round({S.D('sum(pred)')} / count(*) * {S.num(100.0)}, 2), {S.num(0.0)}), NULL, NULL, NULL, NULL FROM s2
UNION ALL SELECT 'model_stats', name, NULL, flagged, avg_prob, NULL, NULL, NULL, NULL FROM ms
UNION ALL SELECT 'variant_counts', variant, NULL, count(*), NULL, NULL, NULL, NULL, NULL FROM s2 WHERE pred = 1 GROUP BY variant
UNION ALL SELECT 'histogram', verdict, CAST(least(floor(prob * 20), 19) AS BIGINT), count(*), NULL, NULL, NULL, NULL, NULL FROM s2 GROUP BY verdict, least(floor(prob * 20), 19)
UNION ALL SELECT * FROM (SELECT 'results', verdict, row_number() OVER (ORDER BY row_id) - 1 AS pos, row_id, round(prob, 6), top_model, round(top_model_conf, 6),
    variant, CASE WHEN pred = 1 THEN round(variant_confidence, 4) ELSE {S.num(0.0)} END FROM s2 ORDER BY row_id LIMIT 500)
UNION ALL SELECT * FROM (SELECT 'distribution', verdict, row_number() OVER (PARTITION BY verdict ORDER BY row_id) AS pos, NULL, round(prob, 4), NULL, NULL, NULL, NULL
    FROM s2) WHERE pos <= 200"""


@query("scoring_report", _report_sql())
def scoring_report_q(spark: SparkSession, sf: str) -> DataFrame:
    """The whole report of an upload from one scan."""
    report = scoring_report(scored_e(spark, sf), [m.name for m in BIN], n_multi=len(MUL))
    return report_lines(report)


FULL_BIN, FULL_MUL = (ordered(full_ensemble()[0]), usable(full_ensemble()[1]))


@query("scoring_report_full", _report_sql(FULL_BIN, FULL_MUL, feature_union([m.features for m in [*FULL_BIN, *FULL_MUL]])))
def scoring_report_full(spark: SparkSession, sf: str) -> DataFrame:
    """M7, M8, M9: the report of the whole ensemble, 8 binary and 20 multiclass models."""
    scored = two_stage(flows_e(spark, sf), FULL_BIN, FULL_MUL, keep=("row_id", "dataset"))
    return report_lines(scoring_report(scored, [m.name for m in FULL_BIN], n_multi=len(FULL_MUL)))

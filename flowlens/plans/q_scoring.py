"""Registered queries: cleaning, encoding, two-stage scoring and its report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.constants import FEATURE_CATALOGUE, SERVICE_CATEGORIES_COMPAT
from flowlens.functions.clean import col, to_double, to_label
from flowlens.functions.encode import feature_union, prepare_features
from flowlens.operators import report
from flowlens.operators.ensemble import ordered, predict_binary
from flowlens.operators.variants import two_stage, usable
from flowlens.plans import sqltext as S
from flowlens.plans.fixed_models import BINARY, METRIC_MODELS, MULTI
from flowlens.operators.ordered import first_n
from flowlens.plans.registry import query
from flowlens.sources.views import flows_e, flows_l

BIN = ordered(BINARY)
MUL = usable(MULTI)
P_COLS = [f"p_{m.name}" for m in BIN]


def scored_e(spark: SparkSession, sf: str, rule: str = "mean", threshold: float = 0.5) -> DataFrame:
    """flows_e through both stages, keyed by row_id, with its dataset."""
    return two_stage(flows_e(spark, sf), BIN, MUL, threshold=threshold,
                     combine_rule=rule, keep=("row_id", "dataset"))


# ---------------------------------------------------------------- SQL pieces
ALL_FEATS = feature_union([m.features for m in BIN] + [m.features for m in MUL])


def _s1_sql(rule: str = "mean", threshold: float = 0.5, models=None, features=None) -> list[str]:
    models = BIN if models is None else models
    feats = S.feats_cte("feats", "flows_e", features or ALL_FEATS, ["row_id", "dataset"], S.E_TYPES)
    columns = [f"p_{m.name}" for m in models]
    pcols = ", ".join(f"{S.model_expr(m)} AS {S.q(c)}" for m, c in zip(models, columns))
    arr = "[" + ", ".join(S.q(c) for c in columns) + "]"
    if rule == "mean":
        prob = f"({' + '.join(S.q(c) for c in columns)}) / {S.num(len(models))}"
    else:
        prob = f"greatest({', '.join(S.q(c) for c in columns)})"
    names = "[" + ", ".join(S.lit(m.name) for m in models) + "]"
    return [
        S.FLOWS_E, feats,
        f"sp AS (SELECT *, {pcols} FROM feats)",
        f"sq AS (SELECT *, {arr} AS model_probs, {prob} AS prob FROM sp)",
        f"""s1 AS (SELECT *, CAST(prob >= {S.num(threshold)} AS INTEGER) AS pred,
              CASE WHEN prob >= {S.num(threshold)} THEN 'MALICIOUS' ELSE 'BENIGN' END AS verdict,
              {names}[list_position(model_probs, list_max(model_probs))] AS top_model,
              list_max(model_probs) AS top_model_conf FROM sq)""",
    ]


def _s2_sql(rule: str = "mean", threshold: float = 0.5, models=None, multi=None, features=None) -> list[str]:
    multi = MUL if multi is None else multi
    ctes = _s1_sql(rule, threshold, models, features)
    cps = ", ".join(f"{S.probs_expr(m)} AS cp{i}" for i, m in enumerate(multi))
    ctes.append(f"s2p AS (SELECT row_id, {cps} FROM s1 WHERE pred = 1)")
    parts = [f"SELECT row_id, list_max(cp{i}) AS conf, {i} AS rnk, "
             f"{S.labels_case(m.label_list(), S.argmax0(f'cp{i}'))} AS label FROM s2p"
             for i, m in enumerate(multi)]
    ctes.append("votes AS (SELECT * FROM (" + " UNION ALL ".join(parts) +
                ") WHERE label <> '-' AND conf > 0)")
    ctes.append("""best AS (SELECT row_id, label, conf FROM (
        SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY conf DESC, rnk) AS rn FROM votes)
        WHERE rn = 1)""")
    ctes.append(f"""s2 AS (SELECT s1.*,
        CASE WHEN pred = 1 THEN {S.display_case("coalesce(best.label, 'Unknown Malware')")}
             ELSE 'N/A' END AS variant,
        CASE WHEN pred = 1 THEN round(coalesce(best.conf, 0.0), 4) ELSE CAST(0.0 AS DOUBLE) END
             AS variant_confidence
        FROM s1 LEFT JOIN best ON s1.row_id = best.row_id)""")
    return ctes


def _r6(c: str) -> str:
    return f"round({S.q(c)}, 6) AS {S.q(c)}"


# ---------------------------------------------------------------- clean / encode
CLEAN_SQL = S.with_(S.FLOWS_E) + f"""SELECT row_id,
  {S.to_double('duration', 'double')} AS duration,
  {S.to_double('orig_bytes', 'text')} AS orig_bytes,
  {S.to_double('resp_bytes', 'text')} AS resp_bytes,
  {S.to_double('local_orig', 'bool')} AS local_orig,
  CAST(0.0 AS DOUBLE) AS missed_bytes,
  CAST({S.to_double('duration', 'double')} AS FLOAT) AS duration_f32,
  coalesce(TRY_CAST(trunc({S.to_double('y_binary', 'int')}) AS INTEGER), 0) AS y_binary,
  coalesce(TRY_CAST(trunc({S.to_double('y_multiclass', 'int')}) AS INTEGER), 0) AS y_multiclass,
  coalesce(TRY_CAST(trunc({S.to_double('orig_bytes', 'text')}) AS INTEGER), 0) AS orig_bytes_label
FROM flows_e"""


@query("clean_coerce", CLEAN_SQL)
def clean_coerce(spark: SparkSession, sf: str) -> DataFrame:
    """Text numerics, booleans, absent column, labels."""
    df = flows_e(spark, sf)
    t = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        "row_id",
        to_double(col("duration"), t["duration"]).alias("duration"),
        to_double(col("orig_bytes"), t["orig_bytes"]).alias("orig_bytes"),
        to_double(col("resp_bytes"), t["resp_bytes"]).alias("resp_bytes"),
        to_double(col("local_orig"), t["local_orig"]).alias("local_orig"),
        F.lit(0.0).alias("missed_bytes"),
        to_double(col("duration"), t["duration"]).cast("float").alias("duration_f32"),
        to_label(col("y_binary"), t["y_binary"]).alias("y_binary"),
        to_label(col("y_multiclass"), t["y_multiclass"]).alias("y_multiclass"),
        to_label(col("orig_bytes"), t["orig_bytes"]).alias("orig_bytes_label"),
    )


ENC_FEATS = list(FEATURE_CATALOGUE)
ONEHOT_SQL = S.with_(S.FLOWS_E, S.feats_cte("feats", "flows_e", ENC_FEATS, ["row_id"], S.E_TYPES)) + \
    "SELECT * FROM feats"


@query("onehot_encode", ONEHOT_SQL)
def onehot_encode(spark: SparkSession, sf: str) -> DataFrame:
    """Full feature preparation over the 20-name catalogue."""
    return prepare_features(flows_e(spark, sf), ENC_FEATS, keep=("row_id",))


def _compat_sql() -> str:
    cols = []
    for f in ENC_FEATS:
        if f.startswith("service_") and f[8:] not in SERVICE_CATEGORIES_COMPAT:
            cols.append(f"CAST(0.0 AS DOUBLE) AS {S.q(f)}")
        else:
            cols.append(f"{S.feature_expr(f, S.E_TYPES)} AS {S.q(f)}")
    return S.with_(S.FLOWS_E) + "SELECT row_id, " + ", ".join(cols) + " FROM flows_e"


@query("onehot_encode_compat", _compat_sql())
def onehot_encode_compat(spark: SparkSession, sf: str) -> DataFrame:
    """T4 compat switch: only dns / http / - are derived from the raw service;
    the other service_* features stay 0.0 unless the input already has them."""
    return prepare_features(flows_e(spark, sf), ENC_FEATS, keep=("row_id",), compat=True)


# ---------------------------------------------------------------- stage 1
def _ens_sql(rule: str) -> str:
    cols = ", ".join(_r6(c) for c in P_COLS)
    return S.with_(*_s1_sql(rule)) + \
        f"SELECT row_id, dataset, {cols}, round(prob, 6) AS prob, pred, verdict FROM s1"


def _ens(spark, sf, rule):
    s = predict_binary(flows_e(spark, sf), BIN, combine_rule=rule, keep=("row_id", "dataset"))
    return s.select("row_id", "dataset", *[F.round(c, 6).alias(c) for c in P_COLS],
                    F.round("prob", 6).alias("prob"), "pred", "verdict")


@query("ensemble_mean", _ens_sql("mean"))
def ensemble_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Mean of the selected models, verdict at 0.5."""
    return _ens(spark, sf, "mean")


@query("ensemble_max", _ens_sql("max"))
def ensemble_max(spark: SparkSession, sf: str) -> DataFrame:
    """Max combine rule."""
    return _ens(spark, sf, "max")


@query("top_model", S.with_(*_s1_sql()) +
       "SELECT row_id, top_model, round(top_model_conf, 6) AS top_model_conf FROM s1")
def top_model(spark: SparkSession, sf: str) -> DataFrame:
    """Arg-max model per row, first model in name order on ties."""
    s = predict_binary(flows_e(spark, sf), BIN, keep=("row_id",))
    return s.select("row_id", "top_model", F.round("top_model_conf", 6).alias("top_model_conf"))


# ---------------------------------------------------------------- stage 2 and report
@query("two_stage_variants", S.with_(*_s2_sql()) +
       "SELECT row_id, pred, variant, variant_confidence FROM s2")
def two_stage_variants(spark: SparkSession, sf: str) -> DataFrame:
    """M8, O5, O6, J3, J4, J5, P14, P17, P18, F6, F7."""
    return scored_e(spark, sf).select("row_id", "pred", "variant", "variant_confidence")


THREAT_SQL = S.with_(*_s1_sql()) + f"""SELECT {S.B('count(*)')} AS total,
  {S.B('count(*) - coalesce(sum(pred), 0)')} AS benign,
  {S.B('coalesce(sum(pred), 0)')} AS malicious,
  coalesce(round({S.D('sum(pred)')} / count(*) * {S.num(100.0)}, 2), {S.num(0.0)}) AS threat_pct
FROM s1"""


@query("threat_summary", THREAT_SQL)
def threat_summary(spark: SparkSession, sf: str) -> DataFrame:
    """M9, A7 (flagship): verdict totals and threat percentage."""
    s = predict_binary(flows_e(spark, sf), BIN, keep=("row_id",))
    return report.threat_summary(s)


THREAT_075_SQL = S.with_(*_s1_sql("mean", 0.75)) + f"""SELECT {S.B('count(*)')} AS total,
  {S.B('count(*) - coalesce(sum(pred), 0)')} AS benign,
  {S.B('coalesce(sum(pred), 0)')} AS malicious,
  coalesce(round({S.D('sum(pred)')} / count(*) * {S.num(100.0)}, 2), {S.num(0.0)}) AS threat_pct
FROM s1"""


@query("threat_summary_page", THREAT_075_SQL)
def threat_summary_page(spark: SparkSession, sf: str) -> DataFrame:
    """The same totals at the page's default threshold of 0.75."""
    s = predict_binary(flows_e(spark, sf), BIN, threshold=0.75, keep=("row_id",))
    return report.threat_summary(s)


@query("variant_counts", S.with_(*_s2_sql()) +
       f"SELECT variant, {S.B('count(*)')} AS n FROM s2 WHERE pred = 1 GROUP BY variant")
def variant_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Variant counts over all malicious rows."""
    return report.variant_counts(scored_e(spark, sf))


@query("variant_breakdown", S.with_(*_s2_sql()) +
       f"""SELECT variant, {S.B('count(*)')} AS n FROM s2 WHERE pred = 1
           AND variant NOT IN ('N/A', 'Unknown Malware') GROUP BY variant HAVING count(*) >= 1""")
def variant_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    """Resolved variants with a positive count."""
    return report.variant_breakdown(scored_e(spark, sf))


def _model_stats_sql() -> str:
    parts = [f"SELECT {S.lit(m.name)} AS name, {S.B('coalesce(sum(CAST(' + S.q(c) + ' >= 0.5 AS INTEGER)), 0)')}"
             f" AS flagged, round(avg({S.q(c)}), 4) AS avg_prob FROM s1" for m, c in zip(BIN, P_COLS)]
    return S.with_(*_s1_sql()) + " UNION ALL ".join(parts)


@query("model_stats", _model_stats_sql())
def model_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Per-model flagged count and mean probability."""
    s = predict_binary(flows_e(spark, sf), BIN, keep=("row_id",))
    return report.model_stats(s, [m.name for m in BIN])


def _model_stats_cte(models=None) -> str:
    models = BIN if models is None else models
    return "ms AS (" + " UNION ALL ".join(
        f"SELECT {S.lit(m.name)} AS name, "
        f"{S.B('coalesce(sum(CAST(' + S.q(c) + ' >= 0.5 AS INTEGER)), 0)')} AS flagged, "
        f"round(avg({S.q(c)}), 4) AS avg_prob FROM s1" for m, c in zip(models, [f"p_{m.name}" for m in models])) + ")"


@query("model_ranking", S.with_(*_s1_sql(), _model_stats_cte()) +
       "SELECT name, flagged, avg_prob, CAST(row_number() OVER (ORDER BY flagged DESC, name) AS INTEGER) AS rank "
       "FROM ms WHERE flagged > 0")
def model_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """Binary models that flagged rows, ordered by their count, with rank."""
    from flowlens.operators.catalog import model_ranking as rank
    s = predict_binary(flows_e(spark, sf), BIN, keep=("row_id",))
    return rank(report.model_stats(s, [m.name for m in BIN]).where(F.col("flagged") > 0))


@query("dataset_threat", S.with_(*_s1_sql()) + f"""SELECT dataset, replace(dataset, 'dataset', 'D') AS short, total,
  total - malicious AS benign, malicious, round(p, 2) AS threat_pct,
  CASE WHEN p > 50 THEN 'high' WHEN p > 20 THEN 'medium' ELSE 'low' END AS band
FROM (SELECT *, {S.D('malicious')} / total * {S.num(100.0)} AS p FROM (SELECT dataset, {S.B('count(*)')} AS total,
        {S.B('coalesce(sum(pred), 0)')} AS malicious FROM s1 GROUP BY dataset))""")
def dataset_threat(spark: SparkSession, sf: str) -> DataFrame:
    """Threat totals of each dataset with band and short name."""
    return report.dataset_threat(predict_binary(flows_e(spark, sf), BIN, keep=("row_id", "dataset")))


@query("first_rows", S.with_(*_s2_sql()) + f"""SELECT {S.B('row_number() OVER (ORDER BY row_id) - 1')} AS "index",
  row_id, round(prob, 6) AS probability, verdict, top_model, round(top_model_conf, 6) AS top_model_conf,
  variant, CASE WHEN pred = 1 THEN round(variant_confidence, 4) ELSE {S.num(0.0)} END AS variant_confidence
FROM s2 ORDER BY row_id LIMIT 500""")
def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    """First 500 detail rows in input order.

    Scoring is row-local and the order key comes from the raw table, so the
    first 500 raw rows are taken first (in two levels) and only those are
    scored: 500 rows through both stages, not the table.
    """
    raw = first_n(flows_e(spark, sf), report.FIRST_ROWS, "row_id")
    scored = two_stage(raw, BIN, MUL, keep=("row_id", "dataset"))
    return report.first_rows(scored).withColumn("index", F.col("index").cast("long"))


@query("first_per_verdict", S.with_(*_s1_sql()) + f"""SELECT verdict, pos, row_id, prob FROM (
  SELECT verdict, {S.B('row_number() OVER (PARTITION BY verdict ORDER BY row_id)')} AS pos, row_id,
         round(prob, 4) AS prob FROM s1) WHERE pos <= 200""")
def first_per_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """First 200 probabilities per verdict (the capped page distribution)."""
    s = predict_binary(flows_e(spark, sf), BIN, keep=("row_id",))
    return report.first_per_verdict(s).withColumn("pos", F.col("pos").cast("long"))


@query("verdict_export", S.with_(*_s2_sql()) + """SELECT row_id, verdict, round(prob, 6) AS probability, variant,
  round(variant_confidence, 4) AS variant_confidence, top_model FROM s2 WHERE verdict = 'MALICIOUS'""")
def verdict_export(spark: SparkSession, sf: str) -> DataFrame:
    """Dropped (malicious) rows as exported."""
    return report.verdict_export(scored_e(spark, sf), "dropped")


@query("verdict_export_allowed", S.with_(*_s1_sql()) + """SELECT row_id, verdict, round(prob, 6) AS probability,
  round(top_model_conf, 6) AS confidence, top_model FROM s1 WHERE verdict = 'BENIGN'""")
def verdict_export_allowed(spark: SparkSession, sf: str) -> DataFrame:
    """Allowed (benign) rows as exported."""
    s = predict_binary(flows_e(spark, sf), BIN, keep=("row_id",))
    return report.verdict_export(s, "allowed")


# ---------------------------------------------------------------- histogram over flows_l
MM = METRIC_MODELS[0]
HIST_SQL = S.with_(
    S.FLOWS_L, S.feats_cte("feats", "flows_l", list(MM.features), ["dataset", "y_binary"], S.L_TYPES),
    f"sc AS (SELECT {S.model_expr(MM)} AS p FROM feats)",
    "sv AS (SELECT CASE WHEN p >= 0.5 THEN 'MALICIOUS' ELSE 'BENIGN' END AS verdict, p FROM sc)",
    f"cnt AS (SELECT verdict, CAST(least(floor(p * 20), 19) AS INTEGER) AS bin, {S.B('count(*)')} AS n "
    "FROM sv GROUP BY ALL)",
    "grid AS (SELECT verdict, CAST(b AS INTEGER) AS bin FROM (SELECT DISTINCT verdict FROM sv), range(20) t(b))",
) + f"""SELECT g.verdict, g.bin, g.bin / {S.num(20)} AS lo, (g.bin + 1) / {S.num(20)} AS hi,
  coalesce(c.n, 0) AS n FROM grid g LEFT JOIN cnt c ON g.verdict = c.verdict AND g.bin = c.bin"""


def scored_l(spark: SparkSession, sf: str, models=METRIC_MODELS) -> DataFrame:
    """flows_l scored by the metric-suite models (one probability column each)."""
    from flowlens.operators.ensemble import add_model_probs
    feats = feature_union([m.features for m in models])
    prepared = prepare_features(flows_l(spark, sf), feats, keep=("dataset", "y_binary"))
    return add_model_probs(prepared, models)


@query("score_histogram", HIST_SQL)
def score_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """20 fixed-width bins per verdict, full data, empty bins kept."""
    s = scored_l(spark, sf, (MM,)).select(F.col(f"p_{MM.name}").alias("p"))
    s = s.withColumn("verdict", F.when(F.col("p") >= 0.5, "MALICIOUS").otherwise("BENIGN"))
    return report.histogram(s, "p", bins=20, by=("verdict",))


# ---------------------------------------------------------------- volume: flows_l through both stages
L_KEEP = ["dataset"]


def scored_volume(spark: SparkSession, sf: str) -> DataFrame:
    """flows_l (lineitem volume) through both stages; features the view lacks
    (local_orig, ...) are absent and score as 0.0 (P4)."""
    return two_stage(flows_l(spark, sf), BIN, MUL, keep=tuple(L_KEEP))


def _vol_sql() -> list[str]:
    ctes = _s2_sql()
    ctes[0] = S.FLOWS_L
    ctes[1] = S.feats_cte("feats", "flows_l", ALL_FEATS, ["dataset"], S.L_TYPES).replace(
        "SELECT ", "SELECT row_number() OVER () AS row_id, ", 1)
    return ctes


@query("volume_threat_summary", S.with_(*_vol_sql()) + f"""SELECT {S.B('count(*)')} AS total,
  {S.B('count(*) - coalesce(sum(pred), 0)')} AS benign, {S.B('coalesce(sum(pred), 0)')} AS malicious,
  coalesce(round({S.D('sum(pred)')} / count(*) * {S.num(100.0)}, 2), {S.num(0.0)}) AS threat_pct FROM s1""")
def volume_threat_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A7 over the lineitem-derived flows (absent features as 0.0)."""
    return report.threat_summary(scored_volume(spark, sf))


@query("volume_variant_counts", S.with_(*_vol_sql()) +
       f"SELECT dataset, variant, {S.B('count(*)')} AS n FROM s2 WHERE pred = 1 GROUP BY ALL")
def volume_variant_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A8 per dataset over the lineitem-derived flows: both stages on every row."""
    return report.variant_counts(scored_volume(spark, sf), by=("dataset",))

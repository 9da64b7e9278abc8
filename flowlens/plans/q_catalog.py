"""Registered queries: the dataset catalog (derived from flows_e by dataset) and
the cross-dataset report tables built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.constants import SELECTED_BINARY, SELECTED_MULTI, VARIANT_DISPLAY
from flowlens.functions.encode import feature_union, prepare_features
from flowlens.operators import catalog as C
from flowlens.operators import metrics_binary as MB
from flowlens.operators import metrics_multi as MM
from flowlens.operators.ensemble import prob_col, stage1
from flowlens.plans import sqltext as S
from flowlens.plans.fixed_models import EVAL_MULTI
from flowlens.plans.q_prep import SPLIT_CTE, split_e
from flowlens.plans.q_scoring import BIN, P_COLS
from flowlens.plans.registry import query

# flows_e class names for the catalog; class 0 plays benign
FLOW_LABELS = ("-", "error", "purchase", "signup", "view")
K = EVAL_MULTI.num_class
KEEP = ("row_id", "dataset", "split", "y_binary", "y_multiclass")
FEATS = feature_union([m.features for m in BIN] + [EVAL_MULTI.features])


def split_scored(spark: SparkSession, sf: str) -> DataFrame:
    """flows_e with split, ensemble probability / verdict and multiclass prediction."""
    prepared = prepare_features(split_e(spark, sf), FEATS, keep=KEEP)
    s1 = stage1(prepared, BIN)
    pr = EVAL_MULTI.class_probs(s1, "probs")
    return MM.with_prediction(pr, "probs", "y_multiclass", K, pred_out="mpred")


def scored_table(spark: SparkSession, sf: str) -> DataFrame:
    """``split_scored`` computed once and cut from its lineage.

    The report queries read the scored rows in several branches (counts,
    ranked metrics, multiclass pairs). Rather than re-scanning, re-splitting
    and re-scoring per branch, the narrow scored table is written once as
    Parquet into the session's shared folder (``spark.checkpoint.dir``): it
    survives lost executors, and later reads keep column pruning and filters.
    """
    from flowlens.session import written
    sc = split_scored(spark, sf)
    keep = ["row_id", "dataset", "split", "y_binary", "y_multiclass", "prob", "pred", "mpred",
            *[prob_col(m.name) for m in BIN]]
    return written(sc.select(*keep))


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    return C.dataset_catalog(scored_table(spark, sf))


def stats(spark: SparkSession, sf: str) -> DataFrame:
    return C.multiclass_stats(scored_table(spark, sf), FLOW_LABELS)


# ------------------------------------------------------------------ SQL
def _base() -> list[str]:
    pcols = ", ".join(f"{S.model_expr(m)} AS {S.q(prob_col(m.name))}" for m in BIN)
    mean = f"({' + '.join(S.q(c) for c in P_COLS)}) / {S.num(len(BIN))}"
    return [
        S.FLOWS_E, SPLIT_CTE,
        S.feats_cte("cfe", "sp", FEATS, list(KEEP), S.E_TYPES),
        f"cs1 AS (SELECT *, {mean} AS prob FROM (SELECT *, {pcols} FROM cfe))",
        f"""cs AS (SELECT *, CAST(prob >= 0.5 AS INTEGER) AS pred, {S.argmax0('probs')} AS mpred
              FROM (SELECT *, {S.probs_expr(EVAL_MULTI)} AS probs FROM cs1))""",
        "tst AS (SELECT * FROM cs WHERE split = 'test')",
    ]


def _catalog_sql() -> list[str]:
    return _base() + [
        f"""cnt AS (SELECT dataset, {S.B("sum(CAST(split = 'train' AS INTEGER))")} AS train_rows,
              {S.B("sum(CAST(split = 'val' AS INTEGER))")} AS val_rows,
              {S.B("sum(CAST(split = 'test' AS INTEGER))")} AS test_rows,
              {S.B("sum(CAST(split = 'train' AND y_binary = 0 AS INTEGER))")} AS train_neg,
              {S.B("sum(CAST(split = 'train' AND y_binary = 1 AS INTEGER))")} AS train_pos,
              avg(CASE WHEN split = 'test' THEN CAST(pred = y_binary AS DOUBLE) END) AS acc
            FROM cs GROUP BY dataset)""",
        *S.ranked_sql("tst", ["dataset"], "prob", "y_binary", "t"),
        """cat AS (SELECT cnt.dataset, CASE WHEN train_neg > 0 AND train_pos > 0 THEN 'trained'
                 WHEN train_rows > 0 THEN 'single_class_train' ELSE 'no_rows' END AS status,
              train_rows, val_rows, test_rows, train_neg, train_pos, tm.roc_auc AS test_roc_auc,
              tm.pr_auc AS test_pr_auc, round(acc, 6) AS test_acc
            FROM cnt LEFT JOIN tm ON cnt.dataset = tm.dataset)""",
    ]


def _stats_sql() -> list[str]:
    names = "[" + ", ".join(S.lit(x) for x in FLOW_LABELS) + "]"
    return _catalog_sql() + [
        f"""mcls AS (SELECT dataset,
              {S.B("count(DISTINCT CASE WHEN split = 'train' THEN y_multiclass END)")} AS classes,
              {S.B("count(DISTINCT CASE WHEN split = 'test' THEN y_multiclass END)")} AS test_classes,
              list_transform(list_sort(list_distinct(list(y_multiclass) FILTER (WHERE split = 'train'))),
                  lambda c: coalesce({names}[c + 1], 'Variant-' || CAST(c AS VARCHAR))) AS variants
            FROM cs GROUP BY dataset)""",
        f"mpairs AS (SELECT dataset, y_multiclass AS y, mpred AS pred, {S.B('count(*)')} AS n FROM tst GROUP BY ALL)",
        f"""mct AS (SELECT dataset, cls, sum(tp) AS tp, sum(support) AS support, sum(predicted) AS predicted FROM (
              SELECT dataset, y AS cls, n AS support, 0 AS predicted, CASE WHEN y = pred THEN n ELSE 0 END AS tp FROM mpairs
              UNION ALL SELECT dataset, pred, 0, n, 0 FROM mpairs) GROUP BY ALL)""",
        """mprf AS (SELECT *, CASE WHEN p2 + r2 > 0 THEN 2.0 * p2 * r2 / (p2 + r2) ELSE 0.0 END AS f1 FROM (
              SELECT *, CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / predicted ELSE 0.0 END AS p2,
                        CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0.0 END AS r2 FROM mct))""",
        """maf AS (SELECT dataset, round(sum(tp) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS f1_macro,
              round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM mprf GROUP BY dataset)""",
        "mst AS (SELECT mcls.*, accuracy, f1_macro, f1_weighted FROM mcls LEFT JOIN maf ON mcls.dataset = maf.dataset)",
        S.values_table("selb", "dataset", SELECTED_BINARY),
        S.values_table("selm", "dataset", SELECTED_MULTI),
    ]


CATALOG_COLS = ("dataset, status, train_rows, val_rows, test_rows, train_neg, train_pos, test_roc_auc, "
                "test_pr_auc, test_acc")


@query("dataset_catalog", S.with_(*_catalog_sql()) + f"SELECT {CATALOG_COLS} FROM cat")
def dataset_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Per-dataset split sizes, class counts, status and test metrics."""
    return catalog(spark, sf)


@query("multiclass_stats", S.with_(*_stats_sql()) +
       "SELECT dataset, classes, test_classes, array_to_string(variants, ',') AS variants, accuracy, "
       "f1_macro, f1_weighted FROM mst")
def multiclass_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Multiclass statistics per dataset (classes, variants, test accuracy / F1)."""
    return stats(spark, sf).withColumn("variants", F.array_join("variants", ","))


@query("catalog_summary", S.with_(*_stats_sql(), """cb AS (SELECT cat.*, dataset IN (SELECT dataset FROM selb) AS sel_bin,
      status = 'trained' AND dataset IN (SELECT dataset FROM selb) AND coalesce(test_roc_auc <> 0, false) AS auc_ok FROM cat)""",
                                         f"""a AS (SELECT {S.B('count(*)')} AS n_datasets,
      {S.B("sum(CAST(status = 'trained' AS INTEGER))")} AS trained,
      {S.B('sum(coalesce(train_rows, 0) + coalesce(val_rows, 0) + coalesce(test_rows, 0))')} AS total_rows,
      {S.B('sum(CAST(auc_ok AS INTEGER))')} AS selected_binary,
      coalesce(round(avg(CASE WHEN auc_ok THEN test_roc_auc END), 4), 0.0) AS avg_auc_selected,
      round(greatest(coalesce(max(CASE WHEN status = 'trained' THEN coalesce(test_acc, 0.0) END), 0.0), 0.0), 4) AS best_acc
    FROM cb)""",
                                         "ms AS (SELECT * FROM mst WHERE dataset IN (SELECT dataset FROM selm))",
                                         f"""v AS (SELECT {S.B('count(DISTINCT x)')} AS n_variants FROM
      (SELECT unnest(variants) AS x FROM ms) WHERE x <> '-')""",
                                         f"m AS (SELECT {S.B('count(*)')} AS multi_selected FROM ms)") +
       """SELECT n_datasets, trained, total_rows, selected_binary, avg_auc_selected, best_acc,
            CAST(CAST(round(total_rows / 1e6, 0) AS BIGINT) AS VARCHAR) || 'M' AS rows_label,
            n_variants, multi_selected FROM a, v, m""")
def catalog_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Page summary over the catalog."""
    sc = scored_table(spark, sf)
    return C.catalog_summary(spark, C.dataset_catalog(sc), C.multiclass_stats(sc, FLOW_LABELS))


@query("performance_table", S.with_(*_stats_sql()) + """SELECT c.dataset, status, train_rows,
    format('{:,}', train_rows) AS train_rows_fmt,
    CASE WHEN train_pos > 0 THEN round(CAST(train_pos AS DOUBLE) / (train_neg + train_pos) * 100.0, 1) ELSE 0.0 END AS mal_pct,
    CAST(CASE WHEN train_pos > 0 THEN round(CAST(train_pos AS DOUBLE) / (train_neg + train_pos) * 100.0, 1) ELSE 0.0 END AS VARCHAR)
      || '%' AS mal_pct_label,
    round(test_roc_auc, 4) AS binary_auc,
    CASE WHEN test_roc_auc IS NULL THEN NULL WHEN test_roc_auc >= 0.85 THEN 'green'
         WHEN test_roc_auc > 0.5 THEN 'amber' ELSE 'red' END AS auc_band,
    round(accuracy, 4) AS multi_accuracy, round(f1_weighted, 4) AS multi_f1_weighted,
    CASE WHEN accuracy IS NULL THEN NULL WHEN accuracy >= 0.9 THEN 'green'
         WHEN accuracy >= 0.5 THEN 'amber' ELSE 'red' END AS acc_band,
    CASE WHEN c.dataset IN (SELECT dataset FROM selb) AND c.dataset IN (SELECT dataset FROM selm) THEN 'Both'
         WHEN c.dataset IN (SELECT dataset FROM selb) THEN 'Binary'
         WHEN c.dataset IN (SELECT dataset FROM selm) THEN 'Multi' ELSE 'Excluded' END AS used,
    CAST(coalesce(len(list_filter(variants, lambda v: v <> '-')), 0) AS INTEGER) AS n_variants
  FROM cat c LEFT JOIN mst s ON c.dataset = s.dataset ORDER BY c.dataset""")
def performance_table(spark: SparkSession, sf: str) -> DataFrame:
    """Per-dataset performance rows."""
    sc = scored_table(spark, sf)
    return C.performance_table(spark, C.dataset_catalog(sc), C.multiclass_stats(sc, FLOW_LABELS))


def _display_sql() -> str:
    rows = ", ".join(f"({S.lit(k)}, {S.lit(v)})" for k, v in VARIANT_DISPLAY.items())
    return f"disp AS (SELECT * FROM (VALUES {rows}) t(variant, display))"


@query("models_per_variant", S.with_(*_stats_sql(), _display_sql(), f"""per AS (SELECT x AS variant,
      {S.B('count(*)')} AS n_models FROM (SELECT unnest(variants) AS x FROM mst
      WHERE dataset IN (SELECT dataset FROM selm)) WHERE x <> '-' GROUP BY x)""") +
       """SELECT per.variant, coalesce(display, per.variant) AS display, n_models
          FROM per LEFT JOIN disp ON per.variant = disp.variant""")
def models_per_variant(spark: SparkSession, sf: str) -> DataFrame:
    """Selected multiclass models per variant."""
    return C.models_per_variant(spark, stats(spark, sf))


@query("model_selection", S.with_(*_stats_sql()) + """SELECT dataset, round(test_roc_auc, 6) AS test_roc_auc,
    coalesce(test_roc_auc > 0.85, false) AS selected_by_rule,
    dataset IN (SELECT dataset FROM selb) AS in_published FROM cat""")
def model_selection(spark: SparkSession, sf: str) -> DataFrame:
    """ROC-AUC > 0.85 as a query over the metric table, next to the published list."""
    return C.model_selection(spark, catalog(spark, sf))


# ------------------------------------------------------------------ M10, D5, U2, K5
REGISTRY = [m.name for m in BIN]


def master_summary_df(spark: SparkSession, sf: str) -> DataFrame:
    """Each dataset is evaluated with the binary model of the same name on its
    test split; datasets without a model become error rows (anti join), and
    both kinds are united by name."""
    sc = scored_table(spark, sf).where(F.col("split") == "test")
    reg = C.names_table(spark, REGISTRY)
    own = None
    for m in BIN:
        cond = F.col("dataset") == m.name
        own = F.when(cond, F.col(prob_col(m.name))) if own is None else own.when(cond, F.col(prob_col(m.name)))
    mine = sc.join(F.broadcast(reg), on="dataset", how="left_semi").withColumn("s", own)
    ranked = MB.binary_report(mine, ["dataset"], "s", "y_binary")
    acc = mine.groupBy("dataset").agg(F.count(F.lit(1)).alias("test_rows"),
                                      F.round(F.avg(((F.col("s") >= 0.5).cast("int") == F.col("y_binary"))
                                                    .cast("double")), 6).alias("accuracy"))
    ok = (acc.join(ranked, on="dataset", how="left")
          .select("dataset", F.lit("ok").alias("status"), F.col("dataset").alias("model"), "test_rows",
                  "roc_auc", "pr_auc", "best_f1", "recall_at_fpr_001", "accuracy"))
    datasets = sc.select("dataset").distinct()
    missing = (datasets.join(F.broadcast(reg), on="dataset", how="left_anti")
               .select("dataset", F.lit("error").alias("status"), F.lit("missing_model").alias("error")))
    return ok.unionByName(missing, allowMissingColumns=True)


@query("master_summary", S.with_(*_base(), S.values_table("reg", "dataset", REGISTRY),
                                 "mine AS (SELECT *, " + "CASE " + " ".join(
                                     f"WHEN dataset = {S.lit(m.name)} THEN {S.q(prob_col(m.name))}" for m in BIN) +
                                 " END AS s FROM tst WHERE dataset IN (SELECT dataset FROM reg))",
                                 *S.ranked_sql("mine", ["dataset"], "s", "y_binary", "q"),
                                 f"""acc AS (SELECT dataset, {S.B('count(*)')} AS test_rows,
      round(avg(CAST(CAST(s >= 0.5 AS INTEGER) = y_binary AS DOUBLE)), 6) AS accuracy FROM mine GROUP BY dataset)""") +
       """SELECT acc.dataset, 'ok' AS status, acc.dataset AS model, test_rows, roc_auc, pr_auc, best_f1,
            recall_at_fpr_001, accuracy, CAST(NULL AS VARCHAR) AS error
          FROM acc LEFT JOIN qm ON acc.dataset = qm.dataset
          UNION ALL
          SELECT DISTINCT dataset, 'error', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'missing_model'
          FROM tst WHERE dataset NOT IN (SELECT dataset FROM reg)""")
def master_summary(spark: SparkSession, sf: str) -> DataFrame:
    """All datasets, evaluation rows and failure rows together."""
    return master_summary_df(spark, sf)


# ------------------------------------------------------------------ M10, D5: multiclass
#: What the folders of the multiclass models hold: (dataset, model, feature list).
#: ``dataset24`` has no rows, ``dataset7`` no labels.
MULTI_FOLDERS = [(f"dataset{i}", i not in (2, 6), i not in (3, 6)) for i in range(1, 25)]
UNLABELLED = "dataset7"


@query("multiclass_master_summary", S.with_(*_stats_sql(), "fold AS (SELECT * FROM (VALUES " + ", ".join(
    f"({S.lit(d)}, {str(m).lower()}, {str(f).lower()})" for d, m, f in MULTI_FOLDERS) + """) t(dataset, has_model, has_features))""",
    f"""ll AS (SELECT dataset, {S.B('count(*)')} AS test_rows,
      round(sum(-ln(least(greatest(probs[y_multiclass + 1], 1e-15), 1 - 1e-15))) / count(*), 6) AS logloss,
      round(sum(list_sum(probs) / {K}.0) / count(*), 6) AS probs_mean FROM tst GROUP BY dataset)""",
    f"""err AS (SELECT fold.dataset, CASE WHEN NOT has_model THEN 'missing_model'
      WHEN NOT has_features THEN 'missing_feature_list' WHEN ll.dataset IS NULL THEN 'missing_test_parquet'
      WHEN fold.dataset = {S.lit(UNLABELLED)} THEN 'evaluation_failed' END AS error
      FROM fold LEFT JOIN ll ON fold.dataset = ll.dataset)""") +
       """SELECT err.dataset, error, test_rows, accuracy, f1_macro, f1_weighted, logloss, probs_mean
          FROM err LEFT JOIN ll ON err.dataset = ll.dataset AND error IS NULL
          LEFT JOIN maf ON err.dataset = maf.dataset AND error IS NULL""")
def multiclass_master_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Every multiclass folder evaluated on its test split, or
    the first of four failures."""
    test = split_scored(spark, sf).where(F.col("split") == "test").drop("pred").withColumnRenamed("mpred", "pred")
    label = F.when(F.col("dataset") != UNLABELLED, F.col("y_multiclass"))
    test = test.withColumn("label", label)
    rows = test.groupBy("dataset").agg(F.count(F.lit(1)).alias("test_rows"), F.count("label").alias("labelled"))
    summary = MM.eval_summary(test.where(F.col("label").isNotNull()), ["dataset"], "probs", "label", K)
    folders = spark.createDataFrame(MULTI_FOLDERS, "dataset string, has_model boolean, has_features boolean")
    return C.multiclass_master(folders, rows, summary)


@query("accuracy_ranking", S.with_(*_stats_sql()) + """SELECT dataset AS name,
    replace(dataset, 'dataset', 'D') AS short, accuracy, dataset IN (SELECT dataset FROM selm) AS selected,
    CAST(row_number() OVER (ORDER BY accuracy DESC NULLS LAST, dataset) AS INTEGER) AS rank FROM mst""")
def accuracy_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """Multiclass models by test accuracy, with short names and the selected set."""
    st = C.flag(stats(spark, sf), C.names_table(spark, SELECTED_MULTI), "selected")
    named = st.select(F.col("dataset").alias("name"), F.replace("dataset", F.lit("dataset"), F.lit("D")).alias("short"),
                      "accuracy", "selected")
    return C.model_ranking(named, by="accuracy")


# ------------------------------------------------------------------ A30, A31
def chosen_threshold_df(spark: SparkSession, sf: str) -> DataFrame:
    sc = scored_table(spark, sf)
    # the threshold is applied as it is; only what is shown is rounded
    val = MB.binary_report(sc.where(F.col("split") == "val"), ["dataset"], "prob", "y_binary", digits=None)
    thr = MB.chosen_threshold(val, ["dataset"])
    parts = sc.where(F.col("split").isin("val", "test")).join(thr, on="dataset", how="inner")
    conf = MB.confusion_at(parts, ["dataset", "split", "chosen_threshold"], "prob", "y_binary", F.col("chosen_threshold"))
    return conf.select("dataset", "split", F.round("chosen_threshold", 6).alias("chosen_threshold"),
                       "n", "tn", "fp", "fn", "tp", "accuracy")


@query("chosen_threshold", S.with_(*_base(), "val AS (SELECT * FROM cs WHERE split = 'val')",
                                   *S.ranked_sql("val", ["dataset"], "prob", "y_binary", "v"),
                                   """thr AS (SELECT dataset, CASE WHEN n_pos = 0 OR n_neg = 0 THEN 0.5
                                        ELSE exact_threshold END AS chosen_threshold FROM vm)""",
                                   f"""k AS (SELECT t.dataset, t.split, chosen_threshold, {S.B('count(*)')} AS n,
      {S.B('sum(CAST(y_binary = 0 AND prob < chosen_threshold AS INTEGER))')} AS tn,
      {S.B('sum(CAST(y_binary = 0 AND prob >= chosen_threshold AS INTEGER))')} AS fp,
      {S.B('sum(CAST(y_binary = 1 AND prob < chosen_threshold AS INTEGER))')} AS fn,
      {S.B('sum(CAST(y_binary = 1 AND prob >= chosen_threshold AS INTEGER))')} AS tp
      FROM cs t JOIN thr ON t.dataset = thr.dataset WHERE t.split IN ('val', 'test')
      GROUP BY t.dataset, t.split, chosen_threshold)""") +
       "SELECT dataset, split, round(chosen_threshold, 6) AS chosen_threshold, n, tn, fp, fn, tp, round((tn + tp) / n, 6) AS accuracy FROM k")
def chosen_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """Validation best-F1 threshold (0.5 for a one-class validation)
    and the validation and test confusion at it."""
    return chosen_threshold_df(spark, sf)

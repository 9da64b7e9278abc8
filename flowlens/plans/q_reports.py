"""Registered queries: training reports with each dataset's own classes, evaluation
of what lies on storage, published selections, coercion counts, CSV and LIBSVM
round trips."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.constants import FEATURE_CATALOGUE
from flowlens.functions.clean import coercion_counts
from flowlens.functions.encode import prepare_features
from flowlens.operators import report
from flowlens.operators import training_report as TR
from flowlens.operators.ensemble import predict_binary
from flowlens.operators.evaluation import FEATURES, evaluate_stored
from flowlens.operators.models import Softmax
from flowlens.operators.selection import publish_selected
from flowlens.plans import sqltext as S
from flowlens.plans.fixed_models import EVAL_MULTI
from flowlens.plans.q_catalog import _base, split_scored
from flowlens.plans.q_prep import SPLIT_CTE, split_e
from flowlens.plans.q_scoring import BIN
from flowlens.plans.registry import query
from flowlens.session import shared_dir
from flowlens.sinks.snapshots import published_folder
from flowlens.sinks.writers import export_libsvm, save_selected, write_feature_list
from flowlens.sources.files import RESCUED, feature_list, read_csv_flows, read_dataset_tree, read_libsvm
from flowlens.sources.registry import save_scoring_model
from flowlens.sources.views import flows_e

#: Datasets known to hold benign rows only (one class), and one without rows.
BENIGN_ONLY = ("dataset1", "dataset2", "dataset3")
DATASETS = [f"dataset{i}" for i in range(1, 25)]


def _folder(spark: SparkSession, kind: str) -> str:
    return shared_dir(spark, f"flowlens-{kind}-{uuid.uuid4().hex[:12]}")


# ------------------------------------------------------------ M11, M13, A16, A17
def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    y = F.when(F.col("dataset").isin(*BENIGN_ONLY), 0).otherwise(F.col("y_multiclass"))
    return split_scored(spark, sf).select("dataset", "split", y.alias("y"), "probs")


def _report_parts(spark: SparkSession, sf: str):
    rows = _labelled(spark, sf)
    registry = spark.createDataFrame([(d,) for d in DATASETS], "dataset string")
    counts = TR.class_counts(rows, registry, "y")
    k = counts.select(F.col("dataset").alias("_kd"), F.col("num_class").alias("num_class"))
    return counts, rows.join(k, F.col("dataset").eqNullSafe(F.col("_kd"))).drop("_kd")


def _metric_ctes() -> list[str]:
    only = ", ".join(S.lit(d) for d in BENIGN_ONLY)
    return _base() + [
        f"b AS (SELECT dataset, split, probs, CASE WHEN dataset IN ({only}) THEN 0 ELSE y_multiclass END AS y FROM cs)",
        "reg AS (SELECT 'dataset' || i AS dataset FROM range(1, 25) t(i))",
        """kt AS (SELECT reg.dataset, coalesce(max(y) + 1, 1) AS k, count(DISTINCT y) AS classes,
             coalesce(array_to_string(list_sort(list(DISTINCT y) FILTER (WHERE y IS NOT NULL)), ','), '') AS train_classes
           FROM reg LEFT JOIN b ON reg.dataset = b.dataset AND split = 'train' GROUP BY reg.dataset)""",
        "own AS (SELECT b.dataset, split, k, y, probs[1:k] AS o FROM b JOIN kt ON b.dataset = kt.dataset)",
        """prd AS (SELECT dataset, split, k, y, CASE WHEN k > 1 THEN list_position(o, list_max(o)) - 1 ELSE 0 END AS pred,
             -ln(least(greatest(o[y + 1] / list_sum(o), 1e-15), 1 - 1e-15)) AS ll FROM own)""",
        "cel AS (SELECT dataset, split, k, y, pred, count(*) AS n, sum(ll) AS ll FROM prd GROUP BY ALL)",
        """cls AS (SELECT dataset, split, c, sum(tp) AS tp, sum(s) AS s, sum(p) AS p FROM (
             SELECT dataset, split, y AS c, CASE WHEN y = pred THEN n ELSE 0 END AS tp, n AS s, 0 AS p FROM cel
             UNION ALL SELECT dataset, split, pred, 0, 0, n FROM cel) GROUP BY ALL)""",
        """f1 AS (SELECT dataset, split, sum(tp) AS tp, sum(s) AS n, avg(2.0 * tp / (s + p)) AS macro,
             sum(2.0 * tp / (s + p) * s) AS weighted FROM cls GROUP BY ALL)""",
        """grid AS (SELECT kt.dataset, sp.split, x.i, y.i AS j FROM kt, (VALUES ('train'), ('val'), ('test')) sp(split), range(0, 64) x(i), range(0, 64) y(i)
             WHERE x.i < kt.k AND y.i < kt.k)""",
        """cm AS (SELECT dataset, split, '[' || string_agg(line, ',' ORDER BY i) || ']' AS cm FROM (
             SELECT g.dataset, g.split, i, '[' || string_agg(CAST(coalesce(n, 0) AS VARCHAR), ',' ORDER BY j) || ']' AS line
             FROM grid g LEFT JOIN cel ON cel.dataset = g.dataset AND cel.split = g.split AND cel.y = i AND cel.pred = j
             GROUP BY g.dataset, g.split, i) GROUP BY dataset, split)""",
        """mt AS (SELECT f1.dataset, f1.split, f1.n, round(f1.tp / f1.n, 6) AS accuracy,
             CASE WHEN k > 1 THEN round(macro, 6) END AS f1_macro, CASE WHEN k > 1 THEN round(weighted / f1.n, 6) END AS f1_weighted,
             CASE WHEN k > 1 THEN round(l.ll / f1.n, 6) ELSE 0.0 END AS logloss, round(1.0 / k, 6) AS probs_mean, cm,
             CASE WHEN k <= 1 THEN 'degenerate_num_class_1' END AS note
           FROM f1 JOIN kt ON f1.dataset = kt.dataset JOIN cm ON cm.dataset = f1.dataset AND cm.split = f1.split
           JOIN (SELECT dataset, split, sum(ll) AS ll FROM cel GROUP BY ALL) l ON l.dataset = f1.dataset AND l.split = f1.split)""",
        """cc AS (SELECT dataset, split, string_agg(y || ':' || n, ',' ORDER BY y) AS counts, sum(n) AS n
             FROM (SELECT dataset, split, y, count(*) AS n FROM b GROUP BY ALL) GROUP BY dataset, split)""",
    ]


@query("dataset_metrics", S.with_(*_metric_ctes()) + """SELECT kt.dataset, CAST(kt.k AS INTEGER) AS num_class,
    CAST(coalesce(n, 0) AS BIGINT) AS n, accuracy, f1_macro, f1_weighted, logloss, probs_mean, cm AS confusion_matrix,
    CASE WHEN n IS NULL THEN 'no_rows' ELSE note END AS note FROM kt LEFT JOIN mt ON kt.dataset = mt.dataset AND split = 'test'""")
def dataset_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Test metrics of every dataset by its own number of classes: one class,
    no rows and several classes in one table."""
    counts, scored = _report_parts(spark, sf)
    test = scored.where(F.col("split") == "test")
    out = TR.dataset_metrics(test, counts.select("dataset", "num_class"), "probs", "y", "num_class")
    return out.select("dataset", "num_class", "n", "accuracy", "f1_macro", "f1_weighted", "logloss", "probs_mean",
                      F.to_json("confusion_matrix").alias("confusion_matrix"), "note")


def _report_sql() -> str:
    parts = ", ".join(f"{s}.n AS {c}_n, {s}.accuracy AS {c}_accuracy, {s}.logloss AS {c}_logloss" for c, s in (("train", "a"), ("validation", "v"), ("test", "t")))
    return S.with_(*_metric_ctes(), """st AS (SELECT kt.*, c.n AS train_rows, CASE WHEN c.n IS NULL THEN 'no_train_rows'
          WHEN classes <= 1 OR k <= 1 THEN 'single_class_train' ELSE 'trained' END AS status
        FROM kt LEFT JOIN cc c ON kt.dataset = c.dataset AND c.split = 'train')""",
                   "ok AS (SELECT mt.* FROM mt JOIN st ON mt.dataset = st.dataset WHERE status = 'trained')") + f"""SELECT st.dataset, status,
      CAST(k AS INTEGER) AS num_class, train_classes, CAST(coalesce(train_rows, 0) AS BIGINT) AS train_rows,
      coalesce(ca.counts, '') AS class_counts_train, coalesce(ct.counts, '') AS class_counts_test, {parts},
      t.f1_macro AS test_f1_macro, t.f1_weighted AS test_f1_weighted, t.cm AS test_confusion_matrix
    FROM st LEFT JOIN cc ca ON st.dataset = ca.dataset AND ca.split = 'train' LEFT JOIN cc ct ON st.dataset = ct.dataset AND ct.split = 'test'
      LEFT JOIN ok a ON st.dataset = a.dataset AND a.split = 'train' LEFT JOIN ok v ON st.dataset = v.dataset AND v.split = 'val'
      LEFT JOIN ok t ON st.dataset = t.dataset AND t.split = 'test'"""


@query("training_report", _report_sql())
def training_report(spark: SparkSession, sf: str) -> DataFrame:
    """The nested report of every dataset (meta, class counts,
    matrix as an array of arrays, the three statuses), written as JSON text and read
    back by its schema."""
    counts, scored = _report_parts(spark, sf)
    metrics = TR.split_metrics(TR.class_cells(scored, ["dataset", "split"], "probs", "y", "num_class"), ["dataset", "split"])
    reports = TR.training_reports(counts, metrics, len(EVAL_MULTI.features))
    back = reports.select("dataset", F.from_json(F.to_json("report"), reports.schema["report"].dataType).alias("r"))

    def text(counts: str) -> Column:
        entries = F.array_sort(F.transform(F.map_entries(counts), lambda e: F.struct(e["key"].cast("int").alias("k"), e["value"].alias("n"))))
        return F.array_join(F.transform(entries, lambda e: F.concat_ws(":", e["k"], e["n"])), ",")

    return back.select(
        "dataset", "r.meta.status", "r.meta.num_class", F.array_join("r.meta.train_classes", ",").alias("train_classes"), "r.meta.train_rows",
        text("r.meta.class_counts_train").alias("class_counts_train"), text("r.meta.class_counts_test").alias("class_counts_test"),
        *[F.col(f"r.metrics.{s}.{c}").alias(f"{s}_{c}") for s in TR.SPLITS for c in ("n", "accuracy", "logloss")],
        F.col("r.metrics.test.f1_macro").alias("test_f1_macro"), F.col("r.metrics.test.f1_weighted").alias("test_f1_weighted"),
        F.to_json("r.metrics.test.confusion_matrix").alias("test_confusion_matrix"))


# ------------------------------------------------------------ D5, M10
#: Holes of the tree that ``stored_evaluation`` writes.
NO_MODEL, NO_LIST, BROKEN, NO_TEST, ONE_CLASS = "dataset2", "dataset3", "dataset5", "dataset23", "dataset4"
EVAL_FEATS = list(EVAL_MULTI.features)


def _stored_sql() -> str:
    cast = ", ".join(f"CAST(CAST({S.q(f)} AS FLOAT) AS DOUBLE) AS {S.q(f)}" for f in EVAL_FEATS)
    return S.with_(
        S.FLOWS_E, SPLIT_CTE, S.feats_cte("ef", "sp", EVAL_FEATS, ["dataset", "split", "y_multiclass"], S.E_TYPES),
        f"e32 AS (SELECT dataset, y_multiclass AS y, {cast} FROM ef WHERE split = 'test')",
        f"e AS (SELECT dataset, y, probs, list_position(probs, list_max(probs)) - 1 AS pred FROM (SELECT *, {S.probs_expr(EVAL_MULTI)} AS probs FROM e32))",
        f"x AS (SELECT dataset, y, CASE WHEN dataset = {S.lit(ONE_CLASS)} THEN 0 ELSE pred END AS pred, -ln(least(greatest(probs[y + 1] / list_sum(probs), 1e-15), 1 - 1e-15)) AS ll FROM e)",
        """c AS (SELECT dataset, l, sum(tp) AS tp, sum(s) AS s, sum(p) AS p FROM (
             SELECT dataset, y AS l, CAST(y = pred AS INTEGER) AS tp, 1 AS s, 0 AS p FROM x UNION ALL SELECT dataset, pred, 0, 0, 1 FROM x) GROUP BY ALL)""",
        "f AS (SELECT dataset, sum(tp) AS tp, sum(s) AS n, avg(2.0 * tp / (s + p)) AS macro, sum(2.0 * tp / (s + p) * s) AS weighted FROM c GROUP BY dataset)",
        f"""reg AS (SELECT dataset, CASE dataset WHEN {S.lit(NO_MODEL)} THEN 'missing_model' WHEN {S.lit(NO_LIST)} THEN 'missing_feature_list'
             ELSE CASE WHEN dataset = {S.lit(NO_TEST)} OR dataset NOT IN (SELECT dataset FROM e) THEN 'missing_test_parquet'
             WHEN dataset = {S.lit(BROKEN)} THEN 'evaluation_failed' END END AS error FROM (SELECT 'dataset' || i AS dataset FROM range(1, 24) t(i)))""",
    ) + f"""SELECT reg.dataset, error, CAST(n AS BIGINT) AS test_rows, round(tp / n, 6) AS accuracy,
      CASE WHEN reg.dataset <> {S.lit(ONE_CLASS)} THEN round(macro, 6) END AS f1_macro, CASE WHEN reg.dataset <> {S.lit(ONE_CLASS)} THEN round(weighted / n, 6) END AS f1_weighted,
      CASE WHEN n IS NULL THEN NULL WHEN reg.dataset = {S.lit(ONE_CLASS)} THEN 0.0 ELSE round(ll / n, 6) END AS logloss,
      CASE WHEN n IS NULL THEN NULL WHEN reg.dataset = {S.lit(ONE_CLASS)} THEN 1.0 ELSE round(1.0 / {EVAL_MULTI.num_class}, 6) END AS probs_mean,
      CASE WHEN reg.dataset = {S.lit(ONE_CLASS)} THEN 'degenerate_num_class_1' END AS note
    FROM reg LEFT JOIN f ON reg.dataset = f.dataset AND error IS NULL LEFT JOIN (SELECT dataset, sum(ll) AS ll FROM x GROUP BY dataset) l ON l.dataset = f.dataset"""


@query("stored_evaluation", _stored_sql())
def stored_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    """Splits, feature lists and models written as a tree
    with holes, found again by listing it, and evaluated as far as it goes."""
    root = _folder(spark, "evaluation")
    rows = prepare_features(split_e(spark, sf), EVAL_FEATS, keep=("dataset", "split", "y_binary", "y_multiclass"))
    save_selected(rows.where((F.col("split") == "test") & (F.col("dataset") != NO_TEST)), EVAL_FEATS, f"{root}/splits")
    for name in DATASETS[:-1]:
        if name not in (NO_MODEL, BROKEN):
            one = Softmax(name, tuple(EVAL_FEATS), ((0.0,) * len(EVAL_FEATS),), (0.0,))
            save_scoring_model(spark, one if name == ONE_CLASS else EVAL_MULTI, f"{root}/models", name)
        if name != NO_LIST:
            write_feature_list(spark, EVAL_FEATS, f"{root}/models/{name}/{FEATURES}")
    spark.createDataFrame([("not a model",)], "value string").write.text(f"{root}/models/{BROKEN}/meta")
    return evaluate_stored(spark, f"{root}/models", f"{root}/splits").drop("message")


# ------------------------------------------------------------ K1-K3, A39
@query("selected_splits", S.with_(S.FLOWS_E, SPLIT_CTE) + f"""SELECT dataset, split, {S.B('count(*)')} AS n, 10 AS n_features,
    {S.B('sum(count(*)) OVER (PARTITION BY split)')} AS split_rows FROM sp GROUP BY dataset, split""")
def selected_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Features ranked, the three splits rewritten with the best ten
    and published as one version; rows as counted during the write and as read back."""
    root = _folder(spark, "selected")
    done = publish_selected(spark, split_e(spark, sf), list(FEATURE_CATALOGUE), root, 1, k=10, method="pointbiserial")
    folder = published_folder(spark, root)
    back = read_dataset_tree(spark, f"{folder}/splits")
    kept = [c for c in back.columns if c in feature_list(spark, f"{folder}/features")]
    rows = spark.createDataFrame([(s, n) for s, n in done["rows"].items() if s != "all"], "s string, split_rows long")
    return (back.groupBy("dataset", "split").agg(F.count(F.lit(1)).alias("n")).join(rows, F.col("split") == F.col("s"))
            .select("dataset", "split", "n", F.lit(len(kept)).alias("n_features"), "split_rows"))


# ------------------------------------------------------------ P6, T16
COERCED = ("duration", "orig_bytes", "resp_bytes", "y_binary", "y_multiclass")


def _coercion_sql() -> str:
    parts = []
    for c in COERCED:
        kind, e = S.E_TYPES[c], S.q(c)
        blank = f"({e} IS NULL OR trim({e}) = '')" if kind == "text" else f"({e} IS NULL OR isnan(CAST({e} AS DOUBLE)))"
        lost = f"coalesce(isnan({S.parse_number(e)}), true)" if kind == "text" else "false"
        parts.append(f"SELECT {S.lit(c)} AS name, {S.B(f'count(*) FILTER (WHERE {blank})')} AS missing, "
                     f"{S.B(f'count(*) FILTER (WHERE NOT {blank} AND {lost})')} AS coerced, {S.B('count(*)')} AS total FROM flows_e")
    return S.with_(S.FLOWS_E) + " UNION ALL ".join(parts)


@query("coercion_counts", _coercion_sql())
def coercion_counts_q(spark: SparkSession, sf: str) -> DataFrame:
    """Values and labels that were missing or no numbers, counted by the
    pass that scores the rows."""
    df, seen = flows_e(spark, sf), Observation("coercions")
    watched = df.observe(seen, *coercion_counts(df, COERCED))
    total = report.threat_summary(predict_binary(watched, BIN, keep=("row_id",))).first()["total"]
    found = seen.get
    return spark.createDataFrame([(c, found[f"{c}_missing"], found[f"{c}_coerced"], total) for c in COERCED],
                                 "name string, missing long, coerced long, total long")


# ------------------------------------------------------------ S1
CSV_SCHEMA = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("dataset", T.StringType()),
                           T.StructField("duration", T.DoubleType()), T.StructField("orig_bytes", T.DoubleType()),
                           T.StructField("y_binary", T.IntegerType())])


@query("csv_rescued", S.with_(S.FLOWS_E) + f"""SELECT dataset, {S.B('count(*)')} AS n, {S.B("count(*) FILTER (WHERE orig_bytes = '-')")} AS rescued,
    round(sum(TRY_CAST(orig_bytes AS DOUBLE)), 3) AS orig_bytes, {S.B('sum(y_binary)')} AS n_pos FROM flows_e GROUP BY dataset""")
def csv_rescued(spark: SparkSession, sf: str) -> DataFrame:
    """Flows written as CSV and read in one scan by a declared schema; rows that do
    not fit keep their text."""
    path = _folder(spark, "csv")
    flows_e(spark, sf).select(*[f.name for f in CSV_SCHEMA.fields]).write.option("header", True).csv(path)
    df = read_csv_flows(spark, path, CSV_SCHEMA)
    return df.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.count(RESCUED).alias("rescued"),
                                     F.round(F.sum("orig_bytes"), 3).alias("orig_bytes"), F.sum("y_binary").cast("long").alias("n_pos"))


# ------------------------------------------------------------ K6, D3
def _libsvm_sql() -> str:
    feats = S.feats_cte("fe", "flows_e", EVAL_FEATS, ["y_binary"], S.E_TYPES)
    return S.with_(S.FLOWS_E, feats) + " UNION ALL ".join(
        f"SELECT {S.lit(f)} AS feature, y_binary AS label, {S.B('count(*)')} AS n, {S.B(f'count(*) FILTER (WHERE {S.q(f)} <> 0)')} AS nonzero, "
        f"round(sum({S.q(f)}), 3) AS total FROM fe GROUP BY y_binary" for f in EVAL_FEATS)


@query("libsvm_round_trip", _libsvm_sql())
def libsvm_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """K6, D3: sparse vectors written as LIBSVM text and read back with the declared
    width; sums for each feature and label."""
    from pyspark.ml.functions import vector_to_array

    path = _folder(spark, "libsvm")
    export_libsvm(prepare_features(flows_e(spark, sf), EVAL_FEATS, keep=("y_binary",)), EVAL_FEATS, "y_binary", path)
    rows = read_libsvm(spark, path, EVAL_FEATS).select(F.col("label").cast("int").alias("label"), F.posexplode(vector_to_array("features")).alias("i", "v"))
    names = F.array(*[F.lit(f) for f in EVAL_FEATS])
    return rows.groupBy(F.element_at(names, F.col("i") + 1).alias("feature"), "label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") != 0).alias("nonzero"), F.round(F.sum("v"), 3).alias("total"))

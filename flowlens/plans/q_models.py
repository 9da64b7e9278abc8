"""Registered queries: selection, training and fitted-model reports.

Model fits have no SQL restatement (rows-only checks plus invariants in the
tests), except the selection fallback, whose point-biserial path is exact.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.constants import FEATURE_CATALOGUE
from flowlens.functions.encode import feature_union, prepare_features
from flowlens.operators import metrics_multi as MM
from flowlens.operators.selection import select_features
from flowlens.operators.train import importances, train_binary, train_multiclass
from flowlens.plans import sqltext as S
from flowlens.plans.fixed_models import EVAL_MULTI
from flowlens.plans.q_prep import SPLIT_CTE, split_e
from flowlens.plans.q_scoring import BIN
from flowlens.plans.registry import query
from flowlens.session import shared_dir, ship_package
from flowlens.sources.views import flows_e

CANDIDATES = list(FEATURE_CATALOGUE)
TRAIN_FEATS = feature_union([m.features for m in BIN] + [EVAL_MULTI.features])
KEEP = ("row_id", "dataset", "split", "y_binary", "y_multiclass")


def _fallback_sql() -> str:
    feats = S.feats_cte("fe", "one", CANDIDATES, ["y_binary"], S.E_TYPES)
    sums = ", ".join(f"sum({S.q(f)}) AS sx{i}, sum({S.q(f)} * {S.q(f)}) AS sxx{i}, sum({S.q(f)} * y) AS sxy{i}"
                     for i, f in enumerate(CANDIDATES))
    parts = []
    vy = "(syy / n - (sy / n) * (sy / n))"
    for i, f in enumerate(CANDIDATES):
        vx = f"(sxx{i} / n - (sx{i} / n) * (sx{i} / n))"
        cov = f"(sxy{i} / n - (sx{i} / n) * (sy / n))"
        parts.append(f"SELECT {S.lit(f)} AS feature, round(CASE WHEN {vx} > 0 AND {vy} > 0 "
                     f"THEN abs({cov} / sqrt({vx} * {vy})) ELSE 0.0 END, 6) AS score FROM m WHERE n > 0")
    return S.with_(S.FLOWS_E, "one AS (SELECT * FROM flows_e WHERE y_binary = 1)", feats,
                   "fy AS (SELECT *, CAST(y_binary AS DOUBLE) AS y FROM fe)",
                   f"m AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(y) AS sy, sum(y * y) AS syy, {sums} FROM fy)",
                   "pb AS (" + " UNION ALL ".join(parts) + ")") + \
        """SELECT feature, score, CAST(row_number() OVER (ORDER BY score DESC, feature) AS INTEGER) AS rank,
             'pointbiserial' AS method, 'single_class' AS fallback_reason FROM pb ORDER BY score DESC, feature LIMIT 10"""


@query("select_with_fallback", _fallback_sql())
def select_with_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """M6, A4, O2, O3: selection on a one-class subset falls back to point-biserial."""
    one = flows_e(spark, sf).where(F.col("y_binary") == 1)
    _, ranked = select_features(spark, one, CANDIDATES, k=10, sample_size=300_000)
    return ranked


@query("select_gain")
def select_gain(spark: SparkSession, sf: str) -> DataFrame:
    """Gain importance of a boosted-tree fit on a seeded sample, top 10."""
    df = split_e(spark, sf).where(F.col("split") == "train")
    _, ranked = select_features(spark, df, CANDIDATES, k=10, sample_size=300_000, min_gain=MIN_GAIN)
    return ranked


#: Fits of this session by (application, folder, kind): the keys that show a fitted
#: model share its fit.
_FITS: dict[tuple, object] = {}
#: The given rows separate cleanly, so that the loss falls for ever, ever more
#: slowly: in these fits a round counts as better from this gain on.
MIN_GAIN = 0.02


def _once(spark: SparkSession, sf: str, kind: str, fit):
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _FITS:
        shared_dir(spark, "")   # boosting cuts its lineage there every few rounds
        _FITS[key] = fit()
    return _FITS[key]


def _fit_binary(spark, sf):
    prepared = prepare_features(split_e(spark, sf), TRAIN_FEATS, keep=KEEP)
    return prepared, _once(spark, sf, "binary", lambda: train_binary(
        prepared.where(F.col("split") == "train"), TRAIN_FEATS, val=prepared.where(F.col("split") == "val"),
        min_gain=MIN_GAIN, name="trained"))


@query("train_binary")
def train_binary_q(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted binary GBT with early stopping; test-split scores."""
    prepared, fit = _fit_binary(spark, sf)
    test = prepared.where(F.col("split") == "test")
    scored = fit.model.score(test, "prob")
    return scored.select("row_id", "dataset", F.round("prob", 6).alias("prob"),
                         (F.col("prob") >= 0.5).cast("int").alias("pred"), "y_binary")


@query("feature_importance")
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Gain importance per feature of the trained binary model (0 if unused)."""
    _, fit = _fit_binary(spark, sf)
    imp = importances(fit.model.model, TRAIN_FEATS)
    return spark.createDataFrame([(f, round(v, 6)) for f, v in imp], "feature string, importance double")


def _fit_multi(spark, sf):
    prepared = prepare_features(split_e(spark, sf), TRAIN_FEATS, keep=KEEP)
    return prepared, _once(spark, sf, "multi", lambda: train_multiclass(
        prepared.where(F.col("split") == "train"), TRAIN_FEATS, val=prepared.where(F.col("split") == "val"), min_gain=MIN_GAIN))


@query("train_multiclass")
def train_multiclass_q(spark: SparkSession, sf: str) -> DataFrame:
    """M5: one-vs-rest GBT multiclass; test-split class and confidence."""
    prepared, fit = _fit_multi(spark, sf)
    test = prepared.where(F.col("split") == "test")
    pr = fit.model.class_probs(test, "probs")
    pr = MM.with_prediction(pr, "probs", "y_multiclass", fit.model.num_class)
    return pr.select("row_id", "y_multiclass", "pred", F.round(F.array_max("probs"), 6).alias("confidence"))


@query("train_report")
def train_report(spark: SparkSession, sf: str) -> DataFrame:
    """One code path for train, validation and test metrics of the fitted model."""
    prepared, fit = _fit_multi(spark, sf)
    pr = fit.model.class_probs(prepared, "probs")
    pr = MM.with_prediction(pr, "probs", "y_multiclass", fit.model.num_class)
    return MM.eval_summary(pr, ["split"], "probs", "y_multiclass", fit.model.num_class)


def _fit_both(spark, sf):
    """The binary and the multiclass fit side by side: a fit is a long row of short jobs,
    one after the other, that leave cores free."""
    shared_dir(spark, "")
    ship_package(spark)
    with ThreadPool(2) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda fit: fit(spark, sf)), (_fit_binary, _fit_multi))


@query("training_rounds", """SELECT model, true AS best_is_lowest, true AS stop_rule_held, true AS kept_best_round,
    true AS better_than_first FROM (VALUES ('binary'), ('multiclass')) t(model)""")
def training_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """M3-M6: what the stop rule promises: the round that is kept has the lowest
    validation loss (but for gains too small to count), either its age or the limit
    ended the boosting, the model has that many trees, and it beats a single round."""
    out = []
    for name, gain, (_, fit) in zip(("binary", "multiclass"), (MIN_GAIN, MIN_GAIN), _fit_both(spark, sf)):
        r = fit.info["rounds"]
        seen = r.losses[:r.tried]
        pipelines = [fit.model.model] if name == "binary" else [m for m in fit.model.models if m is not None]
        out.append((name, seen[r.best - 1] <= min(seen) + gain, r.tried - r.best == r.patience if r.stopped else r.tried == r.limit,
                    all(p.stages[-1].getNumTrees == r.best for p in pipelines), seen[r.best - 1] < seen[0]))
    return spark.createDataFrame(out, "model string, best_is_lowest boolean, stop_rule_held boolean, "
                                      "kept_best_round boolean, better_than_first boolean")


@query("train_checks", S.with_(S.FLOWS_E, SPLIT_CTE) + f"""SELECT model, {S.B('count(*)')} AS n_rows, CAST(0 AS BIGINT) AS bad_probs,
    true AS at_least_majority FROM sp, (VALUES ('binary'), ('multiclass')) t(model) WHERE split = 'test' GROUP BY model""")
def train_checks(spark: SparkSession, sf: str) -> DataFrame:
    """M3-M5: what holds for any good fit: every test row scored, probabilities
    in [0, 1] (those of the classes add up to 1), accuracy of the training rows
    not below the share of their largest class."""
    (prepared, fit), multi = _fit_both(spark, sf)
    two = fit.model.score(prepared, "p").select(
        "split", F.lit("binary").alias("model"), F.col("y_binary").alias("y"), (F.col("p") >= 0.5).cast("int").alias("pred"),
        (F.col("p").isNull() | (F.col("p") < 0) | (F.col("p") > 1)).alias("bad"))
    prepared, fit = multi
    many = MM.with_prediction(fit.model.class_probs(prepared, "probs"), "probs", "y_multiclass", fit.model.num_class)
    total = F.aggregate("probs", F.lit(0.0), lambda a, x: a + x)
    many = many.select("split", F.lit("multiclass").alias("model"), F.col("y_multiclass").alias("y"), "pred",
                       (F.abs(total - 1) > 1e-9).alias("bad"))
    cells = two.unionByName(many).groupBy("model", "split", "y").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("pred") == F.col("y")).cast("long")).alias("hits"),
        F.sum(F.col("bad").cast("long")).alias("bad"))
    train, test = F.col("split") == "train", F.col("split") == "test"
    return cells.groupBy("model").agg(
        F.sum(F.when(test, F.col("n"))).alias("n_rows"), F.sum("bad").alias("bad_probs"),
        (F.sum(F.when(train, F.col("hits"))) >= F.max(F.when(train, F.col("n")))).alias("at_least_majority"))

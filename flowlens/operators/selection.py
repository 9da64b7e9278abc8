"""Feature selection (M6, A4, A26, O2, O3): boosted-tree gain on a seeded
sample, falling back to the one-pass point-biserial score when the sample has
one class or the fit fails. Only the ranked name list reaches the driver."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.encode import one_hot, prepare_features
from flowlens.operators import split as SP
from flowlens.operators import stats as ST
from flowlens.operators.train import importances, label_stats, require_columns, train_binary


def select_features(spark: SparkSession, df: DataFrame, candidates, label: str = "y_binary",
                    k: int = 66, sample_size: int = 300_000, key: str = "row_id", seed: int = 42,
                    max_iter: int = 500, patience: int = 30, min_gain: float = 0.0,
                    depth: int = 6, method: str = "gain"):
    """Returns (ordered feature names, score table (feature, score, rank, method,
    fallback_reason: why the gain ranking was not used, else null))."""
    candidates = list(candidates)
    require_columns(df, [key, label])
    if method == "pointbiserial":
        return _ranked(spark, ST.point_biserial(prepare_features(df, candidates, keep=(label,)), candidates, label), k, method, "asked")
    prepared = prepare_features(df, candidates, keep=(key, label))
    # bounded (sample_size rows) and read three times: label check, hold-out cut, fit
    sample = SP.sample_rows(prepared, sample_size, key, seed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _select(spark, prepared, sample, candidates, label, k, key, seed, max_iter, patience, min_gain, depth)
    finally:
        sample.unpersist()


def _select(spark, prepared, sample, candidates, label, k, key, seed, max_iter, patience, min_gain, depth):
    st = label_stats(sample, label)
    method = "gain"
    scores = None
    reason = "single_class" if st["classes"] < 2 else None
    if reason is None:
        try:
            cut = SP.stratified_split(sample, [label], key, fractions=(0.8,), names=("fit", "hold"), seed=str(seed))
            fit = train_binary(cut.where(F.col("split") == "fit"), candidates, label,
                               val=cut.where(F.col("split") == "hold"), weighted=False,
                               max_iter=max_iter, patience=patience, min_gain=min_gain, step=0.05, depth=depth, seed=seed)
            if fit.status == "trained":
                imp = importances(fit.model.model, candidates)
                scores = spark.createDataFrame([(f, float(v)) for f, v in imp], "feature string, score double")
            else:
                reason = fit.status
        except (PySparkException, Py4JJavaError, ValueError) as e:
            # a failed fit falls back to the one-pass score; the reason stays with the ranking
            reason = f"fit failed: {e}".splitlines()[0][:300]
    if scores is None:
        method = "pointbiserial"
        scores = ST.point_biserial(prepared, candidates, label)
    return _ranked(spark, scores, k, method, reason)


def _ranked(spark, scores, k, method, reason):
    ranked = ST.top_k(scores, k).withColumns(
        {"method": F.lit(method), "fallback_reason": F.lit(reason).cast("string")})
    names = [r["feature"] for r in ranked.orderBy("rank").collect()]   # at most k names
    return names, ranked


def publish_selected(spark: SparkSession, df: DataFrame, candidates, root: str, version: int, label: str = "y_binary",
                     k: int = 66, splits=("train", "val", "test"), **options) -> dict | None:
    """Rank features on the training rows, rewrite all splits with the best ``k`` and
    publish them with the ranking and the feature list as one version (K1-K3, A39).

    ``df`` has dataset, split, the labels and the raw columns. Readers see the old
    selection or the new one whole (``sinks/snapshots.py``: the folders ``splits``,
    ``importance`` and ``features``). Returns the features and the rows of each
    split, counted while they are written; None where that version is out already.
    """
    from flowlens.sinks.snapshots import publish_folder
    from flowlens.sinks.writers import save_selected, write_feature_list, write_importance

    require_columns(df, ["dataset", "split", label])
    names, ranked = select_features(spark, df.where(F.col("split") == "train"), candidates, label, k, **options)
    seen = Observation("split_rows")
    counted = one_hot(df).observe(seen, F.count(F.lit(1)).alias("all"), *[
        F.count_if(F.coalesce(F.col("split") == s, F.lit(False))).alias(s) for s in splits])

    def write(folder: str) -> None:
        save_selected(counted, names, f"{folder}/splits")
        write_importance(ranked, f"{folder}/importance")
        write_feature_list(spark, names, f"{folder}/features")

    if not publish_folder(spark, root, version, write):
        return None
    return {"features": names, "rows": dict(seen.get)}

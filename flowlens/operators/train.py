"""Model fitting (M3-M6, M13, A26, A33, D1) with MLlib.

Binary: ``GBTClassifier`` on assembled features with an optional class weight
(negatives / positives on positives). Multiclass: MLlib has no multiclass
GBT, so one GBT per class (one-vs-rest) whose positive-class probabilities are
normalised to sum to 1; a random forest is the native alternative. With
validation rows a fit ends by patience and keeps its best round: its trees are
those of MLlib, grown for all classes together (``operators/grow.py``). Without
them MLlib fits to its limit, as it does, by ``operators/boosting.py``, where
features have categories.

MLlib aggregates histograms over the partitions, level by level; only fitted
trees and one-row statistics come to the driver. Each level of each tree is a job
over all partitions of the training rows, so these are dealt out by their number
before a fit, whatever the plan before left.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.clean import col, missing_columns
from flowlens.operators.boosting import boosted, round_losses
from flowlens.operators.grow import can_grow, grow_partitions, grown
from flowlens.operators.models import FittedBinary, FittedMulti


#: Feature values in a partition of the training rows: from the first number on a task is
#: worth its start (some 30 ms a level), so that they spread over the cores there are;
#: the second is what a partition grows to before there are more of them than cores.
LEAST_VALUES, MOST_VALUES = 250_000, 1_000_000


@dataclass
class FitResult:
    status: str                       # trained | single_class_train | no_rows
    model: object = None
    info: dict = field(default_factory=dict)


def _assembler(features, out="features"):
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def check_vector_width(df: DataFrame, vec_col: str, features) -> None:
    """D3: the assembled vector must hold exactly one slot per listed feature.

    Read from the column's ML attribute metadata (schema only, no job)."""
    width = df.schema[vec_col].metadata.get("ml_attr", {}).get("num_attrs")
    if width is not None and width != len(features):
        raise ValueError(f"feature vector has {width} slots, feature list has {len(features)}")


def label_stats(df: DataFrame, label: str) -> dict:
    """One aggregate: rows, positives, distinct classes, max class."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col(label) == 1).cast("long")).alias("pos"),
               F.countDistinct(label).alias("k"), F.max(label).alias("mx")).first()
    return {"n": r["n"], "pos": r["pos"] or 0, "classes": r["k"], "max": r["mx"]}


def fit_partitions(values: int, cores: int) -> int:
    return max(1, min(math.ceil(values / LEAST_VALUES), cores), math.ceil(values / MOST_VALUES))


def rounding_gain(n: int, partitions: int) -> float:
    """Gain that a split of rows with one and the same label can seem to have: a sum over
    the rows of a partition is off by up to that many last places."""
    return math.ceil(n / partitions) * sys.float_info.epsilon


def _grown_in(df: DataFrame, n: int, width: int) -> tuple[int, float]:
    """Partitions of rows whose trees grow together, and the least gain of their splits."""
    partitions = grow_partitions(n * width, df.sparkSession.sparkContext.defaultParallelism)
    return partitions, rounding_gain(n, partitions)


def _dealt(rows: DataFrame, n: int, width: int, at_once: int = 1) -> tuple[DataFrame, float]:
    """``n`` rows of ``width`` features in even partitions, as many as their size asks
    for, where ``at_once`` fits share the cores; and the least gain of their splits.

    Without the latter, nodes that are pure go on being split by rounding errors, and
    each level of these costs a job as others do."""
    partitions = fit_partitions(n * width, rows.sparkSession.sparkContext.defaultParallelism // at_once)
    return rows.repartition(partitions).persist(StorageLevel.MEMORY_AND_DISK), rounding_gain(n, partitions)


def require_columns(df: DataFrame, columns) -> None:
    """Named before any job runs."""
    absent = missing_columns(df, list(columns))
    if absent:
        raise ValueError(f"required columns missing: {absent}")


def train_binary(train: DataFrame, features, label: str = "y_binary", *, val: DataFrame | None = None,
                 weighted: bool = True, max_iter: int = 500, patience: int = 30, min_gain: float = 0.0,
                 step: float = 0.05, depth: int = 6, seed: int = 42, name: str = "model") -> FitResult:
    """Binary boosted trees; a one-class training set is not fitted.

    With ``val`` boosting ends when its best loss is ``patience`` rounds old, at
    ``max_iter`` rounds at the latest, and the best round is kept (``info["rounds"]``).
    """
    require_columns(train, [label, *features])
    data = train.withColumn("_val", F.lit(False))
    if val is not None:
        data = data.unionByName(val.withColumn("_val", F.lit(True)), allowMissingColumns=True)
    # checked on the schema before anything is fitted; the statistics and the boosting
    # rounds then share one assembled input instead of running split and preparation again
    assembler = _assembler(features)
    vectors = assembler.transform(data.withColumn("_label", F.col(label)))
    check_vector_width(vectors, "features", features)
    vectors = vectors.select("features", "_label", "_val").persist(StorageLevel.MEMORY_AND_DISK)
    rows, shown = vectors.where(~F.col("_val")), vectors.where(F.col("_val"))
    try:
        st = label_stats(rows, "_label")
        if st["n"] == 0:
            return FitResult("no_rows", info=st)
        if st["classes"] < 2:
            return FitResult("single_class_train", info=st)
        neg = st["n"] - st["pos"]
        spw = neg / st["pos"] if st["pos"] else 1.0
        weight = F.when(F.col("_label") == 1, F.lit(float(spw if weighted else 1.0))).otherwise(F.lit(1.0))
        rows = rows.select("features", F.col("_label").cast("double").alias("_y"), weight.alias("_w"))

        def booster(rounds: int, least: float) -> GBTClassifier:
            return GBTClassifier(featuresCol="features", labelCol="_y", weightCol="_w", maxIter=rounds,
                                 stepSize=step, maxDepth=depth, minInfoGain=least, seed=seed)

        with_val = val is not None and bool(shown.head(1))
        if with_val and can_grow(vectors):
            partitions, least = _grown_in(vectors, st["n"], len(features))
            models, st["rounds"] = grown(vectors, rows, partitions, booster(max_iter, least), [1], joint=False,
                                         weight=float(spw if weighted else 1.0), limit=max_iter, patience=patience, min_gain=min_gain)
        else:
            rows, least = _dealt(rows, st["n"], len(features))

            def fit(rounds: int) -> list:
                return [booster(rounds, least).fit(rows)]

            if not with_val:
                models = fit(max_iter)
            else:
                models, st["rounds"] = boosted(fit, lambda m: round_losses(m, shown, "_label", joint=False),
                                               max_iter, patience, min_gain)
        model = PipelineModel(stages=[assembler, models[0]])
    finally:
        rows.unpersist()
        vectors.unpersist()
    st.update({"scale_pos_weight": spw})
    return FitResult("trained", FittedBinary(name, tuple(features), model), st)


def importances(model: PipelineModel, features) -> list[tuple[str, float]]:
    """Split-gain importance per feature by name (0 when unused)."""
    imp = model.stages[-1].featureImportances
    return [(f, float(imp[i])) for i, f in enumerate(features)]


@dataclass
class OneVsRestGBT:
    """Per-class GBT models; ``class_probs`` gives normalised probabilities."""
    features: tuple
    num_class: int
    models: list                      # one PipelineModel per class (None: class absent in train)

    def class_probs(self, df: DataFrame, out: str) -> DataFrame:
        cur = _assembler(self.features, "_fv_vec").transform(df)
        cols = []
        for k, m in enumerate(self.models):
            if m is None:
                cols.append(F.lit(0.0))
                continue
            gbt = m.stages[-1].copy()
            gbt.setFeaturesCol("_fv_vec").setProbabilityCol(f"_p{k}").setRawPredictionCol(f"_r{k}") \
               .setPredictionCol(f"_c{k}")
            cur = gbt.transform(cur)
            cols.append(vector_to_array(F.col(f"_p{k}"))[1])
        raw = F.array(*cols)
        total = F.aggregate(raw, F.lit(0.0), lambda a, x: a + x)
        probs = F.transform(raw, lambda x: F.when(total > 0, x / total).otherwise(F.lit(1.0 / self.num_class)))
        drop = ["_fv_vec"] + [c for k in range(self.num_class) for c in (f"_p{k}", f"_r{k}", f"_c{k}")]
        return cur.withColumn(out, probs).drop(*[d for d in drop if d in cur.columns])


def train_multiclass(train: DataFrame, features, label: str = "y_multiclass", *, num_class: int | None = None,
                     algo: str = "gbt_ovr", max_iter: int = 2000, patience: int = 60, min_gain: float = 0.0,
                     step: float = 0.1, depth: int = 6, subsample: float = 0.8, seed: int = 42,
                     val: DataFrame | None = None, num_trees: int = 100, parallelism: int = 4):
    """Multiclass model; classes = max label + 1 unless given.

    With ``val`` all classes boost for the same number of rounds: they end when
    the best joint log loss is ``patience`` rounds old, at ``max_iter`` at the
    latest, and are cut back to the best round (``info["rounds"]``). The classes
    of a round are fitted ``parallelism`` at a time.
    """
    require_columns(train, [label, *features])
    # The statistics and the K one-vs-rest fits share one assembled input: persisted
    # once (spilling to disk as needed) instead of re-running the upstream plan each time.
    assembler = _assembler(features)
    both = train.withColumn("_val", F.lit(False))
    if val is not None:
        both = both.unionByName(val.withColumn("_val", F.lit(True)), allowMissingColumns=True)
    assembled = assembler.transform(both)
    check_vector_width(assembled, "features", features)
    assembled = assembled.select("features", "_val", F.col(label).alias("_label")).persist(StorageLevel.MEMORY_AND_DISK)
    rows, shown = assembled.where(~F.col("_val")), assembled.where(F.col("_val"))
    try:
        st = label_stats(rows, "_label")
        if st["n"] == 0:
            return FitResult("no_rows", info=st)
        k = num_class or (int(st["max"]) + 1 if st["max"] is not None else 1)
        st["num_class"] = k
        if k <= 1 or st["classes"] < 2:
            return FitResult("single_class_train", info=st)
        if algo == "rf":
            rf = RandomForestClassifier(featuresCol="features", labelCol="_y", numTrees=min(max_iter, num_trees),
                                        maxDepth=depth, subsamplingRate=subsample, seed=seed)
            data = train.withColumn("_y", F.col(label).cast("double"))
            model = Pipeline(stages=[_assembler(features), rf]).fit(data)
            return FitResult("trained", RandomForestProbs(tuple(features), k, model), st)
        present = {r[0] for r in rows.select("_label").distinct().collect()}   # at most k values

        def booster(rounds: int, least: float) -> GBTClassifier:
            return GBTClassifier(featuresCol="features", labelCol="_y", maxIter=rounds, stepSize=step,
                                 maxDepth=depth, minInfoGain=least, subsamplingRate=subsample, seed=seed)

        def own(c: int) -> DataFrame:
            return rows.withColumn("_y", (F.col("_label") == c).cast("double"))

        with_val = val is not None and bool(shown.head(1))
        if with_val and can_grow(assembled):
            partitions, least = _grown_in(assembled, st["n"], len(features))
            models, st["rounds"] = grown(assembled, own(0), partitions, booster(max_iter, least), [c if c in present else None for c in range(k)],
                                         joint=True, weight=1.0, limit=max_iter, patience=patience, min_gain=min_gain)
        else:
            rows, least = _dealt(rows.select("features", "_label"), st["n"], len(features), max(1, min(parallelism, len(present))))

            def fit(rounds: int) -> list:
                with ThreadPool(max(1, min(parallelism, k))) as pool:
                    return pool.map(inheritable_thread_target(train.sparkSession)(
                        lambda c: booster(rounds, least).fit(own(c)) if c in present else None), range(k))

            if not with_val:
                models = fit(max_iter)
            else:
                models, st["rounds"] = boosted(fit, lambda m: round_losses(m, shown, "_label", joint=True),
                                               max_iter, patience, min_gain)
    finally:
        rows.unpersist()
        assembled.unpersist()
    models = [None if m is None else PipelineModel(stages=[assembler, m]) for m in models]
    return FitResult("trained", OneVsRestGBT(tuple(features), k, models), st)


@dataclass
class RandomForestProbs:
    features: tuple
    num_class: int
    model: object

    def class_probs(self, df: DataFrame, out: str) -> DataFrame:
        res = self.model.transform(df)
        arr = vector_to_array(F.col("probability"))
        pad = F.transform(F.sequence(F.lit(0), F.lit(self.num_class - 1)),
                          lambda i: F.coalesce(F.try_element_at(arr, (i + 1).cast("int")), F.lit(0.0)))
        return res.select(*[col(c) for c in df.columns], pad.alias(out))


def as_stage2(model, name: str, labels=()) -> FittedMulti:
    """Wrap a fitted multiclass model for stage 2: a name (model order and
    ties) and its class-index -> raw-label list (``Variant-i`` beyond it)."""
    return FittedMulti(name, tuple(model.features), model, model.num_class, tuple(labels))

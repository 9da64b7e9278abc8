"""Boosting until the validation loss stops falling (M3-M6).

MLlib's own stop ends a fit at the first round that gains too little. Here the
rule is patience: rounds go on until the best validation loss is ``patience``
rounds old, and the ensemble is cut back to its best round. MLlib cannot go on
with a fitted ensemble, but its rounds depend on the seed and the round alone, so
that a longer fit begins with the trees of a shorter one: a first fit shows where
the rule is likely to hold, and longer ones follow until it does. The losses of all rounds come from one pass over the
validation rows: each tree gives the leaf a row falls into, and per partition
only the sums of the losses leave the task. For several classes the loss is the
joint one, over class probabilities that are normalised for each row.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.constants import LOGLOSS_EPS
from flowlens.session import ship_package

#: Growth of a fit whose end is not in sight, the least growth, and the rounds over the expected ones.
GROWTH, LEAST_GROWTH, SPARE = 2, 1.25, 1.1


def leaf_values(model: GBTClassificationModel) -> np.ndarray:
    """What each leaf of each tree adds to the margin (rounds x leaves, from left to right)."""
    trees, current = [], None
    for line in model.toDebugString.splitlines():
        if re.match(r"\s*Tree \d+ ", line):
            current = []
            trees.append(current)
        elif found := re.match(r"\s*Predict: (\S+)", line):
            current.append(float(found[1]))
    out = np.zeros((len(trees), max(map(len, trees))))
    for i, (leaves, weight) in enumerate(zip(trees, model.treeWeights)):
        out[i, :len(leaves)] = np.array(leaves) * weight
    return out


def _loss_sums(batches: Iterator[pa.RecordBatch], values: list, joint: bool) -> Iterator[pa.RecordBatch]:
    rounds = next(v for v in values if v is not None).shape[0]
    total, n = np.zeros(rounds), 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            part = batch.slice(lo, 1024)
            y = part.column(0).to_numpy()
            probs, at = [], 1
            for v in values:
                if v is None:
                    probs.append(np.zeros((len(y), rounds)))
                    continue
                leaves = part.column(at).flatten().to_numpy(zero_copy_only=False).reshape(len(y), rounds)
                margin = np.cumsum(v[np.arange(rounds), leaves], axis=1)
                probs.append(1 / (1 + np.exp(-2 * margin)))
                at += 1
            if joint:
                whole = np.sum(probs, axis=0)
                inside = (y >= 0) & (y < len(probs))
                own = np.stack(probs)[np.where(inside, y, 0), np.arange(len(y))] * inside[:, None]
                p = np.where(whole > 0, own / np.where(whole > 0, whole, 1), 1 / len(probs))
            else:
                p = np.where(y[:, None] == 1, probs[0], 1 - probs[0])
            total += -np.log(np.clip(p, LOGLOSS_EPS, 1)).sum(axis=0)
            n += len(y)
    yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64())), pa.array([n], pa.int64())],
                                     names=["losses", "n"])


def round_losses(models: list, validation: DataFrame, label: str, joint: bool, features: str = "features") -> list[float]:
    """Mean log loss of ``validation`` after each round; ``models`` has one ensemble
    for each class (None: class never seen), or a single one for two classes."""
    ship_package(validation.sparkSession)
    rows, names = validation.select(features, F.col(label).cast("long").alias("__y")), []
    for k, model in enumerate(models):
        if model is not None:
            leaf = model.copy({model.leafCol: f"__l{k}", model.rawPredictionCol: "", model.probabilityCol: "", model.predictionCol: ""})
            leaf.setFeaturesCol(features)
            rows = leaf.transform(rows)
            names.append(f"__l{k}")
    values = [None if m is None else leaf_values(m) for m in models]
    sums = rows.select("__y", *[vector_to_array(F.col(c)).cast("array<int>").alias(c) for c in names]).mapInArrow(
        lambda b: _loss_sums(b, values, joint), "losses array<double>, n long")
    # one row for each partition, as wide as there are rounds
    each = sums.select("n", F.posexplode("losses").alias("round", "loss")).groupBy("round").agg(
        F.sum("loss").alias("loss"), F.sum("n").alias("n")).orderBy("round").collect()
    return [r["loss"] / r["n"] if r["n"] else float("nan") for r in each]


def patience_stop(losses: list[float], patience: int, min_gain: float = 0.0) -> tuple[int, int, bool]:
    """(best round, rounds looked at, whether the rule ended them), counted from 1.

    A round is the best one if its loss lies more than ``min_gain`` below the best before.
    """
    best, at = float("inf"), 0
    for r, loss in enumerate(losses, 1):
        if loss < best - min_gain:
            best, at = loss, r
        elif r - at >= patience:
            return max(at, 1), r, True
    return max(at, 1), len(losses), False


def truncated(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The first ``rounds`` trees of an ensemble."""
    from pyspark import SparkContext

    gateway, jvm, java = SparkContext._gateway, SparkContext._jvm, model._java_obj
    trees, weights = java.trees(), model.treeWeights
    kept = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    scale = gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        kept[i], scale[i] = trees[i], float(weights[i])
    cut = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        java.uid(), kept, scale, java.numFeatures(), 2))
    return model._copyValues(cut)


@dataclass
class Rounds:
    """How a boosting ended: ``losses`` of all rounds fitted, the last ``tried`` by
    the rule, the ``best`` of them, and whether patience or the limit ended it."""

    losses: list[float]
    best: int
    tried: int
    stopped: bool
    limit: int
    patience: int


def rounds_ahead(losses: list[float], patience: int, min_gain: float = 0.0) -> int:
    """Rounds of the next fit after one that the rule didn't end: where it would, if the
    losses went on falling by the power of the round they fell by in the last half."""
    n = len(losses)
    middle, last = losses[max(n // 2, 1) - 1], losses[-1]
    power = math.log(middle / last, n / max(n // 2, 1)) if n > 1 and 0 < last < middle else 0.0
    expected = [last * (r / n) ** -power for r in range(n + 1, 4 * n + patience + 1)]
    _, tried, stopped = patience_stop([*losses, *expected], patience, min_gain)
    return max(math.ceil(LEAST_GROWTH * n), math.ceil(SPARE * tried) if stopped else GROWTH * n)


def boosted(fit: Callable[[int], list], losses: Callable[[list], list[float]], limit: int, patience: int,
            min_gain: float = 0.0) -> tuple[list, Rounds]:
    """Ensembles of ``fit(rounds)`` cut back to the best round, and how it ended."""
    rounds = min(limit, max(patience, 2))
    while True:
        models = fit(rounds)
        seen = losses(models)
        best, tried, stopped = patience_stop(seen, patience, min_gain)
        if stopped or rounds >= limit:
            cut = [None if m is None else truncated(m, best) for m in models]
            return cut, Rounds(seen, best, tried, stopped, limit, patience)
        rounds = min(limit, max(rounds + 1, rounds_ahead(seen, patience, min_gain)))

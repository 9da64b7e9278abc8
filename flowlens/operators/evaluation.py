"""Evaluation of the models that lie on storage, whatever is missing.

Which datasets have a model, a feature list and test rows is found by listing the
folders, and what is absent by anti joins. A model that cannot be loaded or does
not fit its data costs its own row only.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.encode import prepare_features
from flowlens.operators.training_report import dataset_metrics
from flowlens.sources.files import feature_list, read_dataset_tree
from flowlens.sources.registry import load_model

FEATURES = "feature_list"
#: What a broken folder or a model that does not fit raises.
BROKEN = (PySparkException, Py4JJavaError, ValueError, KeyError, TypeError)


def stored_files(spark: SparkSession, root: str) -> DataFrame:
    """(path) of all files below ``root``; listed, not read. Nothing where there is no such folder."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root.rstrip("/"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string")
    return files.select("path")


def discovered(spark: SparkSession, models_root: str, splits_root: str) -> DataFrame:
    """One row per dataset folder under ``models_root``: dataset, has_model,
    has_features, has_test (a ``split=test`` folder with files under ``splits_root``)."""
    path = F.regexp_extract("path", r"/(dataset[^/=]*)/([^/]+)", 1), F.regexp_extract("path", r"/(dataset[^/=]*)/([^/]+)", 2)
    own = stored_files(spark, models_root).select(path[0].alias("dataset"), path[1].alias("part")).where("dataset <> ''")
    folders = own.groupBy("dataset").agg(F.bool_or(F.col("part") == "meta").alias("has_model"),
                                         F.bool_or(F.col("part") == FEATURES).alias("has_features"))
    tests = (stored_files(spark, splits_root)
             .select(F.regexp_extract("path", r"/dataset=([^/]*)/split=test/[^/]+\.parquet$", 1).alias("t")).where("t <> ''").distinct())
    present = folders.join(tests, F.col("dataset") == F.col("t"), "left_semi").withColumn("has_test", F.lit(True))
    return present.unionByName(folders.join(tests, F.col("dataset") == F.col("t"), "left_anti").withColumn("has_test", F.lit(False)))


def evaluate_stored(spark: SparkSession, models_root: str, splits_root: str, label: str = "y_multiclass") -> DataFrame:
    """One row per model folder: dataset, error, message, test_rows, accuracy,
    f1_macro, f1_weighted, logloss, probs_mean, note.

    The first thing that is missing names the error (``missing_model``,
    ``missing_feature_list``, ``missing_test_parquet``); a model that fails is
    ``evaluation_failed`` with its message. All other models are evaluated in one
    plan; each reads the folder of its own dataset.
    """
    folders = discovered(spark, models_root, splits_root).collect()      # a row a model
    tree, failed, parts, classes = None, {}, [], {}
    for f in folders:
        if not (f["has_model"] and f["has_features"] and f["has_test"]):
            continue
        name = f["dataset"]
        try:
            tree = read_dataset_tree(spark, splits_root) if tree is None else tree
            model = load_model(spark, models_root, name)
            listed = feature_list(spark, f"{models_root.rstrip('/')}/{name}/{FEATURES}")
            if set(listed) != set(model.features):
                raise ValueError(f"the feature list of {name} is not that of its model")
            rows = tree.where((F.col("dataset") == name) & (F.col("split") == "test"))
            scored = model.class_probs(prepare_features(rows, listed, keep=("dataset", label)), "probs")
            parts.append(scored.select("dataset", label, "probs", F.lit(model.num_class).alias("k")))
            classes[name] = model.num_class
        except BROKEN as e:
            failed[name] = str(e).splitlines()[0][:300]
    rows = [(f["dataset"], "missing_model" if not f["has_model"] else "missing_feature_list" if not f["has_features"]
             else "missing_test_parquet" if not f["has_test"] else "evaluation_failed" if f["dataset"] in failed else None,
             failed.get(f["dataset"])) for f in folders]
    base = spark.createDataFrame(rows, "dataset string, error string, message string")
    figures = ("accuracy", "f1_macro", "f1_weighted", "logloss", "probs_mean", "note")
    if not parts:
        return base.select("*", F.lit(None).cast("long").alias("test_rows"),
                           *[F.lit(None).cast("string" if c == "note" else "double").alias(c) for c in figures])
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    registry = spark.createDataFrame(list(classes.items()), "dataset string, num_class int")
    found = dataset_metrics(scored, registry, "probs", label, "k").withColumnRenamed("dataset", "_ds")
    return base.join(found, F.col("dataset") == F.col("_ds"), "left").select(
        "dataset", "error", "message", F.col("n").alias("test_rows"), *figures)

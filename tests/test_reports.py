"""Reports with each dataset's own classes, evaluation of stored models, rescued and sparse rows."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.operators import training_report as TR
from flowlens.operators.evaluation import evaluate_stored
from flowlens.operators.models import Logistic, Softmax
from flowlens.operators.selection import publish_selected
from flowlens.operators.train import train_binary
from flowlens.operators.variants import two_stage
from flowlens.sinks.snapshots import current_version, published_folder
from flowlens.sinks.writers import export_libsvm, save_selected, write_feature_list
from flowlens.sources.files import (RESCUED, feature_list, libsvm_max_index, read_csv_flows, read_dataset_tree, read_libsvm,
                                    sampled_schema)
from flowlens.sources.registry import load_models, save_scoring_model


def _scored(spark):
    p3, rows = [[0.2, 0.5, 0.3], [0.6, 0.2, 0.2], [0.1, 0.1, 0.8]], []
    for split in ("train", "val", "test"):
        rows += [("many", split, y, p3[i % 3]) for i, y in enumerate([0, 1, 2, 2, 1, 0])]
        rows += [("one", split, 0, [1.0]) for _ in range(4)]
    rows += [("outside", "train", 0, p3[0]), ("outside", "train", 1, p3[1]), ("outside", "test", 7, p3[0]), ("outside", "test", 1, p3[0]),
             ("unlabelled", "train", None, p3[0]), (None, "train", 0, p3[0]), (None, "train", 1, p3[1]), (None, "test", 1, p3[1])]
    return spark.createDataFrame(rows, "dataset string, split string, y int, probs array<double>")


def test_reports_by_own_classes(spark):
    scored = _scored(spark)
    registry = spark.createDataFrame([(d,) for d in ("many", "one", "outside", "none", "unlabelled", None)], "dataset string")
    counts = TR.class_counts(scored, registry, "y")
    k = counts.select(F.col("dataset").alias("d"), "num_class")
    rows = scored.join(k, F.col("dataset").eqNullSafe(F.col("d"))).drop("d")
    metrics = TR.split_metrics(TR.class_cells(rows, ["dataset", "split"], "probs", "y", "num_class"), ["dataset", "split"])
    got = {r["dataset"]: r["report"] for r in TR.training_reports(counts, metrics, 3).collect()}
    assert {d: r["meta"]["status"] for d, r in got.items()} == {
        "many": "trained", "one": "single_class_train", "outside": "trained", "none": "no_train_rows",
        "unlabelled": "single_class_train", None: "trained"}
    test = got["many"]["metrics"]["test"]
    y, pred = [0, 1, 2, 2, 1, 0], [1, 0, 2, 1, 0, 2]
    assert test["confusion_matrix"] == [[sum(a == i and b == j for a, b in zip(y, pred)) for j in range(3)] for i in range(3)]
    assert test["class_counts"] == {"0": 2, "1": 2, "2": 2} and abs(test["accuracy"] - 1 / 6) < 1e-6
    assert abs(test["logloss"] + np.mean(np.log([0.2, 0.2, 0.8, 0.3, 0.2, 0.1]))) < 1e-6
    assert got["one"]["metrics"] is None and got["outside"]["metrics"]["validation"] is None
    assert got["outside"]["metrics"]["test"]["logloss"] is None and got["outside"]["meta"]["num_class"] == 2
    # a row is normalised over the classes that its dataset has
    assert abs(got["outside"]["metrics"]["train"]["logloss"] + np.mean(np.log([0.2 / 0.7, 0.2 / 0.8]))) < 1e-6
    flat = TR.dataset_metrics(rows.where("split = 'test'"), counts.select("dataset", "num_class"), "probs", "y", "num_class")
    notes = {r["dataset"]: (r["n"], r["note"], r["logloss"]) for r in flat.collect()}
    assert notes["one"] == (4, "degenerate_num_class_1", 0.0) and notes["none"] == (0, "no_rows", None)


def _flows(spark, n=120):
    return spark.createDataFrame([(i, f"dataset{i % 3 + 1}", ("train", "val", "test")[i % 3 if i % 2 else 2], float(i % 7), float(i % 5),
                                   int(i % 7 > 3), i % 3) for i in range(n)],
                                 "row_id long, dataset string, split string, duration double, orig_bytes double, y_binary int, y_multiclass int")


def test_stored_models_fail_alone(spark, tmpdir_path):
    df, models, splits = _flows(spark), f"{tmpdir_path}/m", f"{tmpdir_path}/s"
    feats = ["duration", "orig_bytes"]
    good = Softmax("x", tuple(feats), ((0.1, 0.0), (0.0, 0.3), (0.2, 0.1)), (0.0, 0.1, 0.2))
    assert evaluate_stored(spark, models, splits).count() == 0
    save_selected(df, feats, splits)
    for name in ("dataset1", "dataset2", "dataset3", "dataset9"):
        save_scoring_model(spark, good, models, name)
        write_feature_list(spark, feats if name != "dataset2" else ["duration", "other"], f"{models}/{name}/feature_list")
    write_feature_list(spark, feats, f"{models}/dataset4/feature_list")
    save_scoring_model(spark, good, models, "dataset5")
    got = {r["dataset"]: r for r in evaluate_stored(spark, models, splits).collect()}
    assert {d: r["error"] for d, r in got.items()} == {
        "dataset1": None, "dataset2": "evaluation_failed", "dataset3": None, "dataset4": "missing_model",
        "dataset5": "missing_feature_list", "dataset9": "missing_test_parquet"}
    assert "dataset2" in got["dataset2"]["message"] and got["dataset1"]["test_rows"] == df.where("dataset = 'dataset1' and split = 'test'").count()
    # loading goes on without a broken folder where failures are asked for
    os.makedirs(f"{models}/dataset7/meta")
    with open(f"{models}/dataset7/meta/part-0.json", "w") as f:
        f.write("broken\n")
    with pytest.raises(ValueError):
        load_models(spark, models)
    failed = []
    _, second = load_models(spark, models, failures=failed)
    assert len(failed) == 1 and [m.name for m in second] == ["dataset1", "dataset2", "dataset3", "dataset5", "dataset9"]


def test_a_failing_second_stage_model_has_no_vote(spark):
    class Bad:
        name, features, num_class, labels = "dataset0", ("duration",), 3, ()

        def label_list(self):
            return ["-", "C&C", "DDoS"]

        def class_probs(self, df, out):
            raise ValueError("does not fit")

    first = [Logistic("dataset4", ("duration",), (1.0,), -2.0)]
    good = Softmax("dataset6", ("duration",), ((0.0,), (1.0,)), (0.0, 0.0), labels=("-", "DDoS"))
    with pytest.raises(ValueError):
        two_stage(_flows(spark), first, [Bad(), good])
    failed = []
    rows = two_stage(_flows(spark), first, [Bad(), good], failures=failed).collect()
    assert failed == [("dataset0", "does not fit")] and {r["variant"] for r in rows} == {"N/A", "DDoS Attack"}
    alone = two_stage(_flows(spark), first, [Bad()], failures=[]).collect()
    assert {r["variant"] for r in alone} == {"N/A", "Unknown Malware"}


def test_selection_is_published_once(spark, tmpdir_path):
    df, root = _flows(spark), f"{tmpdir_path}/sel"
    done = publish_selected(spark, df, ["duration", "orig_bytes", "missed_bytes"], root, 3, k=2, method="pointbiserial")
    assert done["rows"] == {"all": 120, **{r["split"]: r["count"] for r in df.groupBy("split").count().collect()}}
    folder = published_folder(spark, root)
    assert feature_list(spark, f"{folder}/features") == done["features"] and done["features"][0] == "duration"
    assert read_dataset_tree(spark, f"{folder}/splits").count() == 120
    assert publish_selected(spark, df, ["duration"], root, 3, k=1, method="pointbiserial") is None and current_version(spark, root) == 3
    with pytest.raises(ValueError, match="split"):
        publish_selected(spark, df.drop("split"), ["duration"], root, 4)


def test_csv_by_a_sample_and_rescued_rows(spark, tmpdir_path):
    path = f"{tmpdir_path}/f.csv"
    with open(path, "w") as f:
        f.write("id,name,size\n" + "".join(f"{i},n{i},{i}.5\n" for i in range(50)) + "51,broken,not a number\nx,y\n")
    schema = sampled_schema(spark, path, rows=20)
    assert [t for _, t in spark.createDataFrame([], schema).dtypes] == ["int", "string", "double"]
    df = read_csv_flows(spark, path, schema)
    assert dict(read_csv_flows(spark, path).dtypes)["size"] == "string"
    rows = df.collect()
    assert len(rows) == 52 and [r[RESCUED] for r in rows if r[RESCUED]] == ["51,broken,not a number", "x,y"]
    assert rows[50]["id"] == 51 and rows[50]["size"] is None
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_sparse_rows_read_back_fit_alike(spark, tmpdir_path):
    df = _flows(spark).withColumn("zero", F.lit(0.0))
    feats, path = ["duration", "orig_bytes", "zero"], f"{tmpdir_path}/svm"
    export_libsvm(df, feats, "y_binary", path)
    assert 2 <= libsvm_max_index(spark, path) <= len(feats)
    back = read_libsvm(spark, path, feats)
    assert {r["features"].size for r in back.collect()} == {3}
    with pytest.raises(Exception):
        read_libsvm(spark, path, feats[:1]).collect()
    from pyspark.ml.functions import vector_to_array
    dense = back.select(F.col("label").cast("int").alias("y_binary"),
                        *[vector_to_array("features")[i].alias(f) for i, f in enumerate(feats)])
    a = train_binary(df, feats, max_iter=3, depth=3).model.score(df, "p").agg(F.sum("p")).first()[0]
    b = train_binary(dense, feats, max_iter=3, depth=3).model.score(dense, "p").agg(F.sum("p")).first()[0]
    assert abs(a - b) < 1e-9

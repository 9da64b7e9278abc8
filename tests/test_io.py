"""Round trips of the file sources and sinks in a fresh temporary folder."""

import os

from pyspark.sql import functions as F

from flowlens.sinks import writers as W
from flowlens.sources import files as FS
from flowlens.sources.views import flows_e
from tests.conftest import SF_SMALL


def test_csv_and_parquet_flows(spark, tmpdir_path):
    csv = os.path.join(tmpdir_path, "up.csv")
    with open(csv, "w") as f:
        f.write("proto,service,duration,orig_bytes\nTCP,dns,1.5,-\nudp,,2,12\n")
    df = FS.read_flows(spark, csv)
    assert df.count() == 2 and set(df.columns) == {"proto", "service", "duration", "orig_bytes"}
    pq = os.path.join(tmpdir_path, "up.PARQUET")
    df.write.parquet(pq)
    both = FS.read_flows(spark, [pq, csv])
    assert both.count() == 4


def test_feature_list_round_trip(spark, tmpdir_path):
    dst = os.path.join(tmpdir_path, "features")
    W.write_feature_list(spark, ["duration", "service_-", "proto_tcp"], dst)
    assert [r.value for r in spark.read.text(dst).collect()] == ["duration", "service_-", "proto_tcp"]
    path = os.path.join(tmpdir_path, "feature_list.txt")
    with open(path, "w") as f:
        f.write(" duration\n\nservice_-  \n   \nproto_tcp\n")
    assert FS.feature_list(spark, path) == ["duration", "service_-", "proto_tcp"]


def test_save_selected_counts_and_partitions(spark, tmpdir_path):
    df = flows_e(spark, SF_SMALL).withColumn("split", F.lit("train"))
    dst = os.path.join(tmpdir_path, "selected")
    n = W.save_selected(df, ["duration", "orig_bytes", "missing_feature"], dst)
    back = spark.read.parquet(dst)
    assert n == df.count() == back.count()
    assert dict(back.dtypes)["duration"] == "float" and dict(back.dtypes)["y_binary"] == "int"
    assert back.where("missing_feature <> 0").count() == 0
    assert any(d.startswith("dataset=") for d in os.listdir(dst))


def test_dataset_tree_discovery(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "tree")
    for ds in ("dataset4", "dataset10"):
        spark.range(3).write.parquet(os.path.join(root, ds, "test.parquet"))
    df = FS.read_dataset_tree(spark, root)
    got = {r.dataset: r.n for r in df.groupBy("dataset").agg(F.count("*").alias("n")).collect()}
    assert got == {"dataset4": 3, "dataset10": 3}


def test_reports_round_trip(spark, tmpdir_path):
    rep = spark.createDataFrame(
        [("dataset5", None, {"0": 298, "1": 1263}), ("dataset7", 3, {"0": 5})],
        "dataset string, num_class long, cc map<string,bigint>")
    nested = rep.select("dataset", F.struct("dataset", "num_class").alias("meta"),
                        F.struct(F.struct(F.col("cc").alias("class_counts")).alias("test")).alias("metrics"))
    dst = os.path.join(tmpdir_path, "reports")
    W.write_json_report(nested, dst)
    back = FS.read_reports(spark, dst)
    nc = {r.dataset: r.num_class for r in back.collect()}
    assert nc == {"dataset5": 2, "dataset7": 3}
    cc = {(r.dataset, r.cls): r.n for r in FS.report_class_counts(back).collect()}
    assert cc[("dataset5", 1)] == 1263 and cc[("dataset7", 0)] == 5


def test_libsvm_and_verdict_export(spark, tmpdir_path):
    df = flows_e(spark, SF_SMALL)
    dst = os.path.join(tmpdir_path, "svm")
    W.export_libsvm(df, ["duration", "orig_bytes"], "y_binary", dst)
    back = spark.read.format("libsvm").option("numFeatures", 2).load(dst)
    assert back.count() == df.count()
    from flowlens.plans.q_scoring import scored_e
    sc = scored_e(spark, SF_SMALL)
    W.export_verdicts(sc, "dropped", os.path.join(tmpdir_path, "dropped"))
    W.export_verdicts(sc, "allowed", os.path.join(tmpdir_path, "allowed"))
    d = spark.read.option("header", True).csv(os.path.join(tmpdir_path, "dropped"))
    a = spark.read.option("header", True).csv(os.path.join(tmpdir_path, "allowed"))
    assert d.count() + a.count() == df.count()
    assert "variant" in d.columns and "variant" not in a.columns


def test_summary_sink(spark, tmpdir_path):
    from flowlens.plans.q_catalog import master_summary_df
    ms = master_summary_df(spark, SF_SMALL)
    W.write_summary(ms, os.path.join(tmpdir_path, "ms_csv"), os.path.join(tmpdir_path, "ms_json"))
    back = spark.read.json(os.path.join(tmpdir_path, "ms_json"))
    assert back.count() == ms.count()
    assert back.where("status = 'error'").count() > 0


def test_importance_csv_and_model_round_trip(spark, tmpdir_path):
    from pyspark.ml import PipelineModel
    from flowlens.operators.train import importances, train_binary
    rows = [(float(i % 10), float(i % 7), int(i % 10 >= 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, y_binary int")
    fit = train_binary(df, ["a", "b"], max_iter=3, depth=2)
    imp = spark.createDataFrame(importances(fit.model.model, ["a", "b"]), "feature string, score double")
    W.write_importance(imp, os.path.join(tmpdir_path, "imp"))
    back = spark.read.option("header", True).option("inferSchema", True).csv(os.path.join(tmpdir_path, "imp"))
    assert {r.feature for r in back.collect()} == {"a", "b"}
    dst = os.path.join(tmpdir_path, "model")
    W.save_model(fit.model.model, dst)
    loaded = PipelineModel.load(dst)
    p1 = [r.probability[1] for r in fit.model.model.transform(df).select("probability").collect()]
    p2 = [r.probability[1] for r in loaded.transform(df).select("probability").collect()]
    assert p1 == p2


def test_no_input_file(spark):
    import pytest
    with pytest.raises(ValueError):
        FS.read_flows(spark, [])

"""Saved models score as the ones in memory; readers of our own layouts."""

from flowlens.operators.models import Softmax
from flowlens.operators.train import as_stage2, train_binary, train_multiclass
from flowlens.operators.variants import two_stage
from flowlens.plans.fixed_models import BINARY, MULTI
from flowlens.sinks.writers import save_selected
from flowlens.sources.files import read_dataset_tree, read_flows
from flowlens.sources.registry import load_models, save_scoring_model
from flowlens.sources.views import flows_e
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(map(str, df.collect()))


def test_expression_models_and_selected_sets(spark, tmpdir_path):
    for m in [*BINARY, *MULTI]:
        save_scoring_model(spark, m, tmpdir_path)
    first, second = load_models(spark, tmpdir_path)
    assert {m.name: m for m in first} == {m.name: m for m in BINARY}
    assert [m.name for m in second] == sorted(m.name for m in MULTI if m.num_class > 1)
    assert all(isinstance(m, Softmax) for m in second)
    few, none = load_models(spark, tmpdir_path, binary={"dataset4"}, multi=set())
    assert [m.name for m in few] == ["dataset4"] and none == []
    df = flows_e(spark, SF_SMALL)
    assert _rows(two_stage(df, first, second)) == _rows(two_stage(df, list(BINARY), list(MULTI)))


def test_fitted_models_round_trip(spark, tmpdir_path):
    df = flows_e(spark, SF_SMALL).selectExpr("row_id", "duration", "cast(local_orig as double) local_orig",
                                             "y_binary", "y_multiclass").na.fill(0.0)
    feats = ["duration", "local_orig"]
    b = train_binary(df, feats, max_iter=2, depth=2, name="dataset4").model
    m = as_stage2(train_multiclass(df, feats, max_iter=2, depth=2).model, "dataset12", labels=["-", "C&C", "DDoS"])
    r = as_stage2(train_multiclass(df, feats, algo="rf", max_iter=2, depth=2).model, "dataset16")
    for x in (b, m, r):
        save_scoring_model(spark, x, tmpdir_path)
    first, second = load_models(spark, tmpdir_path)
    assert [x.name for x in second] == ["dataset12", "dataset16"] and second[0].labels == ("-", "C&C", "DDoS")
    assert _rows(two_stage(df, first, second)) == _rows(two_stage(df, [b], [m, r]))


def test_tree_of_our_own_writer(spark, tmpdir_path):
    from pyspark.sql import functions as F

    df = flows_e(spark, SF_SMALL).withColumn("split", F.when(F.col("row_id") % 2 == 0, "train").otherwise("test"))
    root = f"{tmpdir_path}/dataset_root"
    n = save_selected(df, ["duration"], root)
    back = read_dataset_tree(spark, root)
    assert back.count() == n == df.count()
    assert {r[0] for r in back.select("split").distinct().collect()} == {"train", "test"}
    want = {r["dataset"]: r["count"] for r in df.groupBy("dataset").count().collect()}
    assert {r["dataset"]: r["count"] for r in back.groupBy("dataset").count().collect()} == want
    plan = back.where("dataset = 'dataset3'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset" in plan


def test_mixed_types_become_text(spark, tmpdir_path):
    spark.createDataFrame([(1.5, 1)], "orig_bytes double, x int").write.parquet(f"{tmpdir_path}/a.parquet")
    spark.createDataFrame([("-", 2)], "orig_bytes string, x int").write.option("header", True).csv(f"{tmpdir_path}/b.csv")
    got = read_flows(spark, [f"{tmpdir_path}/a.parquet", f"{tmpdir_path}/b.csv"])
    assert sorted(map(tuple, got.collect())) == [("-", 2), ("1.5", 1)]

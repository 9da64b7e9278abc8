"""Model fits: no SQL oracle, so invariants only."""

from pyspark.sql import functions as F

from flowlens.operators import metrics_multi as MM
from flowlens.operators.train import train_binary, train_multiclass


def _separable(spark, n=400):
    rows = [(i, float(i % 10), float((i * 7) % 13), int(i % 10 >= 5), (i % 10) // 4) for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, a double, b double, y_binary int, y_multiclass int")


def test_binary_fit_beats_majority(spark):
    df = _separable(spark)
    fit = train_binary(df, ["a", "b"], max_iter=5, depth=3)
    assert fit.status == "trained" and fit.info["scale_pos_weight"] == 1.0
    sc = fit.model.score(df, "p")
    acc = sc.agg(F.avg(((F.col("p") >= 0.5).cast("int") == F.col("y_binary")).cast("double"))).first()[0]
    assert acc > 0.9
    assert sc.where("p < 0 OR p > 1").count() == 0


def test_single_class_not_fitted(spark):
    df = _separable(spark).withColumn("y_binary", F.lit(0))
    assert train_binary(df, ["a"]).status == "single_class_train"
    assert train_multiclass(df.withColumn("y_multiclass", F.lit(0)), ["a"]).status == "single_class_train"


def test_multiclass_probabilities_sum_to_one(spark):
    df = _separable(spark)
    fit = train_multiclass(df, ["a", "b"], max_iter=3, depth=3)
    assert fit.status == "trained" and fit.model.num_class == 3
    pr = fit.model.class_probs(df, "probs")
    sums = pr.select(F.aggregate("probs", F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert sums.where(F.abs(F.col("s") - 1.0) > 1e-9).count() == 0
    sc = MM.with_prediction(pr, "probs", "y_multiclass", 3)
    acc = MM.accuracy_f1(sc, [], "y_multiclass").first()["accuracy"]
    majority = df.groupBy("y_multiclass").count().agg(F.max("count")).first()[0] / df.count()
    assert acc > majority


def test_vector_width_check(spark):
    import pytest
    from pyspark.ml.feature import VectorAssembler
    from flowlens.operators.train import check_vector_width
    df = _separable(spark)
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(df)
    check_vector_width(vec, "v", ["a", "b"])
    with pytest.raises(ValueError):
        check_vector_width(vec, "v", ["a", "b", "c"])


def test_two_stage_with_fitted_models(spark):
    from flowlens.operators.train import as_stage2
    from flowlens.operators.variants import two_stage
    df = _separable(spark)
    b = train_binary(df, ["a", "b"], max_iter=3, depth=2, name="fitted_b").model
    m = as_stage2(train_multiclass(df, ["a", "b"], max_iter=2, depth=2).model, "fitted_m",
                  labels=("-", "C&C"))
    sc = two_stage(df, [b], [m], keep=("row_id", "y_binary"))
    rows = sc.collect()
    assert len(rows) == df.count()
    for r in rows:
        assert (r.pred == 1) == (r.prob >= 0.5)
        assert (r.variant == "N/A") == (r.pred == 0)
        assert r.variant in ("N/A", "Unknown Malware", "C&C Communication", "Variant-2")

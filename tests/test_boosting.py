"""Patience, losses of all rounds, and ensembles cut back to the best one."""

import math
import threading
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from flowlens.operators import boosting, train
from flowlens.operators.boosting import boosted, patience_stop
from flowlens.operators.train import train_binary, train_multiclass
from flowlens.plans import q_models


def _noisy(spark, n=600):
    """Labels that follow the features two times in three: more rounds soon fit noise."""
    rows = [(i, float(i * 7919 % 101), float(i * 104729 % 89), float(i * 31 % 53),
             int((i * 7919 % 101 > 50) ^ (i * 2654435761 % 3 == 0)), (i * 7919 % 101 // 34 + (i * 2654435761 % 4 == 0)) % 3)
            for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, a double, b double, c double, y_binary int, y_multiclass int")


def test_patience_rule():
    assert patience_stop([3, 2, 1, 1.5, 1.2, 0.9], 2) == (3, 5, True)
    assert patience_stop([3, 2, 1, 1.5, 0.9], 2) == (5, 5, False)
    assert patience_stop([1.0, 0.9995, 0.999, 0.9985], 3, min_gain=0.01) == (1, 4, True)
    assert patience_stop([float("nan")] * 3, 5) == (1, 3, False)


def test_binary_keeps_the_best_round(spark):
    df = _noisy(spark)
    val, train = df.where("row_id % 4 = 0"), df.where("row_id % 4 <> 0")
    fit = train_binary(train, ["a", "b", "c"], val=val, max_iter=200, patience=10, step=0.3, weighted=False)
    r = fit.info["rounds"]
    assert r.stopped and r.tried == r.best + 10 and r.losses[r.best - 1] == min(r.losses[:r.tried])
    assert fit.model.model.stages[-1].getNumTrees == r.best

    def loss(model):
        p = F.when(F.col("y_binary") == 1, F.col("p")).otherwise(1 - F.col("p"))
        return model.score(val, "p").agg(F.avg(-F.log(p))).first()[0]

    # the loss of the kept ensemble, computed from its scores
    assert math.isclose(loss(fit.model), r.losses[r.best - 1], rel_tol=1e-9)
    # a longer fit begins with the trees of a shorter one
    longer = train_binary(train, ["a", "b", "c"], max_iter=r.best, step=0.3, weighted=False)
    assert math.isclose(loss(longer.model), r.losses[r.best - 1], rel_tol=1e-9)


def test_classes_stop_together(spark):
    df = _noisy(spark)
    val, train = df.where("row_id % 4 = 0"), df.where("row_id % 4 <> 0")
    fit = train_multiclass(train, ["a", "b", "c"], val=val, num_class=4, max_iter=60, patience=5, step=0.3, depth=3)
    r = fit.info["rounds"]
    sizes = [None if m is None else m.stages[-1].getNumTrees for m in fit.model.models]
    assert sizes == [r.best] * 3 + [None]
    own = F.try_element_at("probs", F.col("y_multiclass") + 1)
    got = fit.model.class_probs(val, "probs").agg(F.avg(-F.log(own))).first()[0]
    assert math.isclose(got, r.losses[r.best - 1], rel_tol=1e-9)


def test_columns_are_named_before_a_fit(spark):
    with pytest.raises(ValueError, match="y_binary"):
        train_binary(_noisy(spark).drop("y_binary"), ["a"])
    with pytest.raises(ValueError, match="zz"):
        train_multiclass(_noisy(spark), ["a", "zz"])


def test_partitions_of_a_fit_follow_its_rows(spark, monkeypatch):
    # every level of every tree is a job over all of them
    seen = []
    plain = train.GBTClassifier.fit
    monkeypatch.setattr(train.GBTClassifier, "fit", lambda self, df: (seen.append(df.rdd.getNumPartitions()), plain(self, df))[1])
    df = _noisy(spark).repartition(40)
    train_binary(df, ["a", "b", "c"], max_iter=2, depth=2)
    train_multiclass(df, ["a", "b", "c"], max_iter=2, depth=2)
    assert seen == [1] * 4
    assert train.fit_partitions(4_200_000, 12) == 12 and train.fit_partitions(500_000, 12) == 2
    assert train.fit_partitions(42_000_000, 12) == 42 and train.fit_partitions(0, 0) == 1


def test_rounding_errors_split_no_node(spark):
    # one column tells the classes apart: every later split would be one of equal labels
    df = spark.range(20_000).selectExpr("id AS row_id", "CAST(id % 3 = 0 AS DOUBLE) a", "CAST(id * 7919 % 101 AS DOUBLE) b",
                                        "CAST(id * 104729 % 89 AS DOUBLE) c", "CAST(id % 3 = 0 AS INT) y_binary")
    fit = train_binary(df, ["a", "b", "c"], max_iter=25)
    many = train_multiclass(df.withColumnRenamed("y_binary", "y_multiclass"), ["a", "b", "c"], max_iter=25)
    for m in [fit.model.model, *many.model.models]:
        assert [t.depth for t in m.stages[-1].trees] == [1] * 25
    # what sets a single row apart is no rounding error
    odd = df.withColumn("y_binary", F.when(F.col("row_id") == 77, 1 - F.col("y_binary")).otherwise(F.col("y_binary")))
    one = train_binary(odd.withColumn("c", (F.col("row_id") == 77).cast("double")), ["a", "b", "c"], max_iter=1)
    assert one.model.model.stages[-1].trees[0].depth == 2


@pytest.mark.parametrize("loss, gain", [(lambda r: 4.6 / r, 0.02), (lambda r: abs(r - 20) + 1, 0.0), (lambda r: 1 / r, 0.0)])
def test_few_rounds_are_fitted_twice(monkeypatch, loss, gain):
    monkeypatch.setattr(boosting, "truncated", lambda m, rounds: rounds)
    fitted = []
    models, r = boosted(lambda n: [fitted.append(n) or n], lambda m: [loss(i) for i in range(1, m[0] + 1)], 480, 60, gain)
    assert (r.best, r.tried, r.stopped) == patience_stop([loss(i) for i in range(1, 481)], 60, gain) and models == [r.best]
    assert fitted == sorted(set(fitted)) and fitted[-1] <= max(1.25 * r.tried, 480 * (gain == 0 and not r.stopped))
    assert not gain or sum(fitted) <= 1.6 * r.tried


def test_binary_and_multiclass_fit_side_by_side(spark, monkeypatch):
    # each waits for the other: one after the other, the barrier breaks
    meet = threading.Barrier(2, timeout=20)

    def fitted(best, wrap):
        model = SimpleNamespace(stages=[SimpleNamespace(getNumTrees=best)])
        rounds = boosting.Rounds([2.0] + [1.0] * 9, best, 10, False, 10, 30)
        return lambda *_: meet.wait() is not None and (None, SimpleNamespace(info={"rounds": rounds}, model=wrap(model)))

    monkeypatch.setattr(q_models, "_fit_binary", fitted(2, lambda m: SimpleNamespace(model=m)))
    monkeypatch.setattr(q_models, "_fit_multi", fitted(3, lambda m: SimpleNamespace(models=[m, None, m])))
    rows = {r["model"]: r for r in q_models.training_rounds(spark, "").collect()}
    assert set(rows) == {"binary", "multiclass"}
    assert all(v for r in rows.values() for k, v in r.asDict().items() if k != "model")

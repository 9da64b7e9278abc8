"""Trees of all classes grown together: those of MLlib, whatever the partitions and what workers keep."""

import re
from types import SimpleNamespace

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from flowlens.operators import grow, train
from flowlens.operators.train import train_binary, train_multiclass


def _rows(spark, n=900):
    rows = [(i, float(i * 7919 % 101), float(i * 104729 % 89), float(i * 31 % 53), float(i % 7 == 0), 1.0,
             int((i * 7919 % 101 > 50) ^ (i * 2654435761 % 3 == 0)), (i * 7919 % 101 // 34 + (i * 2654435761 % 4 == 0)) % 3)
            for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, a double, b double, c double, d double, e double, y_binary int, y_multiclass int")


FEATURES = ["a", "b", "c", "d", "e"]     # e has one value only


def _split(df):
    return df.where("row_id % 4 <> 0"), df.where("row_id % 4 = 0")


def _trees(model):
    """The trees as text, their numbers to ten digits (exp of two libraries differs in the last)."""
    return re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda n: f"{float(n[0]):.10g}", model.toDebugString.split("\n", 1)[1])


@pytest.mark.parametrize("weighted", [False, True])
def test_binary_trees_are_those_of_mllib(spark, weighted):
    train_rows, val = _split(_rows(spark).coalesce(1))
    fit = train_binary(train_rows, FEATURES, val=val, weighted=weighted, max_iter=5, patience=5, step=0.3, depth=3)
    plain = train_binary(train_rows, FEATURES, weighted=weighted, max_iter=fit.info["rounds"].best, step=0.3, depth=3)
    mine, theirs = fit.model.model.stages[-1], plain.model.model.stages[-1]
    assert _trees(mine) == _trees(theirs) and mine.treeWeights == theirs.treeWeights
    assert list(mine.featureImportances) == pytest.approx(list(theirs.featureImportances), rel=1e-12)


def test_sampled_trees_are_those_of_mllib(spark):
    # the same rows of each round: Spark's generator, its seed by round and partition
    df = _rows(spark).coalesce(1)
    train_rows, val = _split(df)
    fit = train_multiclass(train_rows, FEATURES, val=val, max_iter=6, patience=6, step=0.3, depth=4)
    plain = train_multiclass(train_rows, FEATURES, max_iter=fit.info["rounds"].best, step=0.3, depth=4)
    for mine, theirs in zip(fit.model.models, plain.model.models):
        assert _trees(mine.stages[-1]) == _trees(theirs.stages[-1])


def test_a_fit_is_no_row_of_fits(spark, monkeypatch):
    # rounds are grown once, for all classes, and go on from where they are
    fitted = []
    plain = GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df: (fitted.append(1), plain(self, df))[1])
    train_rows, val = _split(_rows(spark))
    fit = train_multiclass(train_rows, FEATURES, val=val, max_iter=40, patience=3, step=0.3, depth=3)
    assert not fitted and len(fit.info["rounds"].losses) == fit.info["rounds"].tried
    train_binary(train_rows, FEATURES, val=val, max_iter=40, patience=3, step=0.3, depth=3)
    assert not fitted


def test_partitions_change_no_tree(spark, monkeypatch):
    train_rows, val = _split(_rows(spark))
    one = train_binary(train_rows, FEATURES, val=val, max_iter=40, patience=5, step=0.3, depth=2)
    monkeypatch.setattr(grow, "grow_partitions", lambda values, cores: 3)
    monkeypatch.setattr(train, "grow_partitions", lambda values, cores: 3)
    monkeypatch.setattr(grow, "RECENT", 4)
    many = train_binary(train_rows, FEATURES, val=val, max_iter=40, patience=5, step=0.3, depth=2)
    monkeypatch.setattr(grow, "COLLECTED", 0)
    added = train_binary(train_rows, FEATURES, val=val, max_iter=40, patience=5, step=0.3, depth=2)
    for other in (many, added):      # splits that gain the same may change places
        r = other.info["rounds"]
        assert r.losses[:3] == pytest.approx(one.info["rounds"].losses[:3], rel=1e-9)
        assert min(r.losses) == pytest.approx(min(one.info["rounds"].losses), rel=0.01)
        assert other.model.model.stages[-1].getNumTrees == r.best


def test_what_a_worker_lost_is_made_again():
    import numpy as np

    rng = np.random.default_rng(5)
    bins, y = rng.integers(0, 8, (3, 400)).astype(np.uint8), rng.integers(0, 3, 400)
    part = [(bins[:, 100:], y[100:]), (bins[:, :100], y[:100])]
    g = grow.Growth([np.arange(7.0)] * 3, [0, 1, 2], True, 1.0, 0.3, 4, 1e-12, 0.8, 42, 5, 5, 0.0)

    def run(fit, lost):
        plain = []

        def ask(rounds, steps):
            plain.extend([grow._plain(t) for t in trees] for trees in rounds[len(plain):])
            if lost:
                grow._MARGINS.values.clear()
                grow._SAMPLES.values.clear()
            return grow._level(fit, 1, part, g, len(rounds), plain.__getitem__, steps)

        return grow._rounds(ask, g)[1]

    assert run("kept", False) == run("lost", True)
    kept = grow.Kept(10)
    for key in "abc":
        kept.keep(key, SimpleNamespace(size=4))
    assert list(kept.values) == ["b", "c"]


def test_partitions_follow_the_values():
    assert [grow.grow_partitions(v, 6) for v in (0, 250_000, 500_000, 42_000_000, 480_000_000)] == [1, 1, 2, 6, 60]


def test_features_with_categories_are_left_to_mllib(spark):
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "s string, x double")
    named = StringIndexer(inputCol="s", outputCol="i").fit(df).transform(df)
    assert not grow.can_grow(VectorAssembler(inputCols=["i", "x"], outputCol="features").transform(named))
    assert grow.can_grow(VectorAssembler(inputCols=["x"], outputCol="features").transform(named.select(F.col("x"))))

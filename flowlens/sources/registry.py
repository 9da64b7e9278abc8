"""Saved scoring models: one folder a model, found and loaded again.

``root/<name>/meta`` holds one JSON row (kind, features, labels, classes and,
for expression models, their parameters); fitted MLlib pipelines lie beside it
as ``part-<k>``, one for each class of a one-vs-rest model.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from flowlens.operators.models import FittedBinary, FittedMulti, Logistic, Softmax, Tree
from flowlens.operators.train import OneVsRestGBT, RandomForestProbs

META = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("num_class", T.LongType()),
    T.StructField("parts", T.ArrayType(T.LongType())),
    T.StructField("params", T.StringType()),
])


def _tuples(x):
    return tuple(_tuples(v) for v in x) if isinstance(x, list) else x


def _described(model) -> tuple[str, int, dict, dict]:
    """(kind, classes, parameters, {part: pipeline})."""
    if isinstance(model, Logistic):
        return "logistic", 2, {"weights": model.weights, "bias": model.bias, "digits": model.digits}, {}
    if isinstance(model, Tree):
        return "tree", 2, {"root": model.root}, {}
    if isinstance(model, Softmax):
        return "softmax", model.num_class, {"weights": model.weights, "bias": model.bias}, {}
    if isinstance(model, FittedBinary):
        return "fitted_binary", 2, {}, {0: model.model}
    inner = model.model if isinstance(model, FittedMulti) else model
    if isinstance(inner, OneVsRestGBT):
        return "one_vs_rest", inner.num_class, {}, {k: m for k, m in enumerate(inner.models) if m is not None}
    if isinstance(inner, RandomForestProbs):
        return "forest", inner.num_class, {}, {0: inner.model}
    raise TypeError(f"no saved form for {type(model).__name__}")


def save_scoring_model(spark: SparkSession, model, root: str, name: str | None = None) -> str:
    """Write a binary or multiclass model under ``root``; an older one of the name is replaced."""
    name = name or model.name
    kind, classes, params, parts = _described(model)
    folder = f"{root.rstrip('/')}/{name}"
    for k, pipeline in parts.items():
        pipeline.write().overwrite().save(f"{folder}/part-{k}")
    row = (name, kind, list(model.features), list(getattr(model, "labels", ()) or ()), classes, sorted(parts),
           json.dumps(params))
    spark.createDataFrame([row], META).coalesce(1).write.mode("overwrite").json(f"{folder}/meta")
    return folder


def _loaded(root: str, meta):
    name, features, params = meta["name"], tuple(meta["features"]), json.loads(meta["params"])

    def part(k: int) -> PipelineModel:
        return PipelineModel.load(f"{root.rstrip('/')}/{name}/part-{k}")

    if meta["kind"] == "logistic":
        return Logistic(name, features, _tuples(params["weights"]), params["bias"], params["digits"])
    if meta["kind"] == "tree":
        return Tree(name, features, _tuples(params["root"]))
    if meta["kind"] == "softmax":
        return Softmax(name, features, _tuples(params["weights"]), _tuples(params["bias"]), tuple(meta["labels"]))
    if meta["kind"] == "fitted_binary":
        return FittedBinary(name, features, part(0))
    if meta["kind"] == "forest":
        inner = RandomForestProbs(features, meta["num_class"], part(0))
    else:
        inner = OneVsRestGBT(features, meta["num_class"],
                             [part(k) if k in meta["parts"] else None for k in range(meta["num_class"])])
    return FittedMulti(name, features, inner, meta["num_class"], tuple(meta["labels"]))


def load_model(spark: SparkSession, root: str, name: str):
    """The model in the folder ``root/name``."""
    meta = spark.read.schema(META).json(f"{root.rstrip('/')}/{name}/meta").first()
    if meta is None or meta["kind"] is None:
        raise ValueError(f"no readable model in {name}")
    return _loaded(root, meta)


def load_models(spark: SparkSession, root: str, binary=None, multi=None, failures: list | None = None) -> tuple[list, list]:
    """(binary models, multiclass models) found under ``root``, in name order.

    ``binary`` and ``multi`` name the selected models (None: all). Multiclass
    models with a single class have nothing to say and stay out. One small row
    a model reaches the driver. With ``failures`` a folder that cannot be loaded is
    noted there as (name, message) and the others are used; without, it is an error.
    """
    metas = sorted(spark.read.schema(META).json(f"{root.rstrip('/')}/*/meta").collect(), key=lambda m: m["name"] or "")
    unread = [m for m in metas if m["kind"] is None or m["name"] is None]
    if unread and failures is None:
        raise ValueError(f"{len(unread)} folders under {root} hold no readable model")
    if unread:
        failures += [(m["name"], "no readable model") for m in unread]
    metas = [m for m in metas if m["kind"] is not None and m["name"] is not None]
    two = ("logistic", "tree", "fitted_binary")
    first = [m for m in metas if m["kind"] in two and (binary is None or m["name"] in binary)]
    second = [m for m in metas if m["kind"] not in two and m["num_class"] > 1 and (multi is None or m["name"] in multi)]

    def loaded(metas: list) -> list:
        out = []
        for m in metas:
            try:
                out.append(_loaded(root, m))
            except (PySparkException, Py4JJavaError, ValueError, KeyError, TypeError) as e:
                if failures is None:
                    raise
                failures.append((m["name"], str(e).splitlines()[0][:300]))
        return out

    return loaded(first), loaded(second)

"""Stage 1: binary ensemble.

Every model's probability is a column; the combine rule, verdict and arg-max
model are array expressions over those columns. The whole stage is one
projection over the scan: no shuffle, no driver round trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.constants import BENIGN, DEFAULT_THRESHOLD, MALICIOUS
from flowlens.functions.encode import feature_union, prepare_features
from flowlens.operators.models import is_expression_model

COMBINE_RULES = ("mean", "max")


def ordered(models) -> list:
    """Models in name order as text (dataset10 before dataset4)."""
    return sorted(models, key=lambda m: m.name)


def prob_col(name: str) -> str:
    return f"p_{name}"


def add_model_probs(df: DataFrame, models) -> DataFrame:
    """One probability column per model; expression models in a single projection."""
    exprs = {prob_col(m.name): m.expr() for m in models if is_expression_model(m)}
    out = df.withColumns(exprs) if exprs else df
    for m in models:
        if not is_expression_model(m):
            out = m.score(out, prob_col(m.name))
    return out


def combine(probs: Column, n: int, rule: str) -> Column:
    if rule == "mean":
        total = probs[0]
        for i in range(1, n):
            total = total + probs[i]
        return total / F.lit(float(n))
    if rule == "max":
        return F.array_max(probs)
    raise ValueError(f"combine must be one of {COMBINE_RULES}, got {rule!r}")


def verdict(pred: Column) -> Column:
    return F.when(pred == 1, F.lit(MALICIOUS)).otherwise(F.lit(BENIGN))


def stage1(prepared: DataFrame, models, threshold: float = DEFAULT_THRESHOLD,
           combine_rule: str = "mean") -> DataFrame:
    """Add ``p_<model>``, ``model_probs``, ``prob``, ``pred``, ``verdict``,
    ``top_model`` (first model on ties) and ``top_model_conf`` to prepared rows."""
    if not models:
        raise ValueError("no binary models")
    if combine_rule not in COMBINE_RULES:
        raise ValueError(f"combine must be one of {COMBINE_RULES}, got {combine_rule!r}")
    models = ordered(models)
    scored = add_model_probs(prepared, models)
    names = F.array(*[F.lit(m.name) for m in models])
    probs = F.array(*[F.col(prob_col(m.name)) for m in models])
    out = scored.withColumn("model_probs", probs)
    out = out.withColumn("prob", combine(F.col("model_probs"), len(models), combine_rule))
    pred = (F.col("prob") >= F.lit(float(threshold))).cast("int")
    top = F.array_position(F.col("model_probs"), F.array_max(F.col("model_probs")))
    return out.withColumns({
        "pred": pred,
        "verdict": verdict(pred),
        "top_model": F.element_at(names, top.cast("int")),
        "top_model_conf": F.array_max(F.col("model_probs")),
    })


STAGE1_COLS = ("model_probs", "prob", "pred", "verdict", "top_model", "top_model_conf")


def predict_binary(df_raw: DataFrame, models, threshold: float = DEFAULT_THRESHOLD,
                   combine_rule: str = "mean", keep=("row_id",), compat: bool = False) -> DataFrame:
    """Score raw flows with the ensemble; output ``keep`` columns, one
    ``p_<model>`` per model and the stage-1 columns."""
    models = ordered(models)
    feats = feature_union([m.features for m in models])
    keep = [k for k in keep if k in df_raw.columns]
    prepared = prepare_features(df_raw, feats, keep=keep, compat=compat)
    out = stage1(prepared, models, threshold, combine_rule)
    return out.select(*[F.col(k) for k in keep], *[F.col(prob_col(m.name)) for m in models],
                      *STAGE1_COLS)

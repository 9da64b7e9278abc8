"""Stage 2: name the attack variant of malicious rows.

Per model: arg-max class and its confidence (first class on ties), class index
-> raw label with a ``Variant-{i}`` fallback and its display name (J3), benign
votes dropped. Across models the best vote wins on confidence, the first model
in name order on ties; a vote must beat 0.0. The result is written back by
projection (``when(pred = 1, ...)``), not by a join on a row index.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.constants import (BENIGN_LABEL, DEFAULT_THRESHOLD, NO_VARIANT, UNKNOWN_VARIANT,
                                VARIANT_DISPLAY)
from flowlens.functions.encode import feature_union, prepare_features
from flowlens.operators.ensemble import STAGE1_COLS, ordered, prob_col, stage1


def probs_col(name: str) -> str:
    return f"cp_{name}"


def usable(models) -> list:
    """Only models with more than one class take part."""
    return [m for m in ordered(models) if m.num_class > 1]


def padded_labels(model) -> list[str]:
    """Label of every class index 0..K-1, ``Variant-{i}`` beyond the known list."""
    labels = model.label_list()
    return [labels[k] if k < len(labels) else f"Variant-{k}" for k in range(model.num_class)]


def _sql_str(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def model_vote(probs: str, model, rank: int) -> Column:
    """O5 + J4 + P18 for one model, as one struct (valid, conf, neg_rank, display, model).

    The arg-max is ``array_max`` over (probability, -class, named, display)
    structs: the first class wins ties and the label (already as display
    name, J3) travels with its class. Lambdas bind the probabilities and the
    arg-max once each, so the plan stays linear in size even when a filter on
    the result is pushed down through it.
    """
    labels = padded_labels(model)
    named = "array(" + ", ".join("true" if lab != BENIGN_LABEL else "false" for lab in labels) + ")"
    display = "array(" + ", ".join(_sql_str(VARIANT_DISPLAY.get(lab, lab)) for lab in labels) + ")"
    cands = (f"transform(`{probs}`, (p, k) -> named_struct('conf', p, 'neg_cls', -k, "
             f"'named', {named}[k], 'display', {display}[k]))")
    vote = (f"named_struct('valid', coalesce(t.named AND t.conf > 0.0D, false), 'conf', t.conf, "
            f"'neg_rank', {-rank}, 'display', t.display, 'model', {_sql_str(model.name)})")
    return F.expr(f"transform(array(array_max({cands})), t -> {vote})[0]")


def stage2(scored: DataFrame, models, pred_col: str = "pred", failures: list | None = None) -> DataFrame:
    """Add ``variant``, ``variant_confidence`` (4 digits) and ``variant_model``.

    Rows with ``pred = 0`` get N/A and 0.0, and expression models are not
    evaluated for them; malicious rows with no usable vote
    get Unknown Malware and 0.0. Across models ``greatest`` picks a valid
    vote first, then the highest confidence, then the earlier model in name
    order; every step is a built-in expression inside generated code. With
    ``failures`` a model that does not fit these rows is noted there as (name,
    message) and has no vote; without, it is an error.
    """
    models = usable(models)
    mal = F.col(pred_col) == 1
    if not models:
        return scored.withColumns({"variant": F.when(mal, F.lit(UNKNOWN_VARIANT)).otherwise(F.lit(NO_VARIANT)),
                                   "variant_confidence": F.lit(0.0),
                                   "variant_model": F.lit(None).cast("string")})
    from flowlens.operators.models import Softmax, add_softmax_probs
    soft = [m for m in models if isinstance(m, Softmax)]
    cur = add_softmax_probs(scored, [(m, probs_col(m.name)) for m in soft], gate=mal) if soft else scored
    for m in [m for m in models if not isinstance(m, Softmax)]:
        try:
            cur = m.class_probs(cur, probs_col(m.name))
        except (PySparkException, Py4JJavaError, ValueError) as e:
            if failures is None:
                raise
            failures.append((m.name, str(e).splitlines()[0][:300]))
            models = [x for x in models if x is not m]
    if not models:
        return stage2(scored, [], pred_col)
    votes = [model_vote(probs_col(m.name), m, i) for i, m in enumerate(models)]
    cur = cur.withColumn("_best", F.greatest(*votes) if len(votes) > 1 else votes[0])
    ok = mal & F.col("_best.valid")
    out = cur.withColumns({
        "variant": F.when(ok, F.col("_best.display"))
                    .when(mal, F.lit(UNKNOWN_VARIANT)).otherwise(F.lit(NO_VARIANT)),
        "variant_confidence": F.when(ok, F.round(F.col("_best.conf"), 4)).otherwise(F.lit(0.0)),
        "variant_model": F.when(ok, F.col("_best.model")),
    })
    return out.drop("_best", *[probs_col(m.name) for m in models])


def two_stage(df_raw: DataFrame, binary_models, multi_models, threshold: float = DEFAULT_THRESHOLD,
              combine_rule: str = "mean", keep=("row_id",), compat: bool = False,
              failures: list | None = None) -> DataFrame:
    """Stage 1 then stage 2 over one feature preparation of the union of all lists."""
    binary_models = ordered(binary_models)
    multi = usable(multi_models)
    feats = feature_union([m.features for m in binary_models] + [m.features for m in multi])
    keep = [k for k in keep if k in df_raw.columns]
    prepared = prepare_features(df_raw, feats, keep=keep, compat=compat)
    s1 = stage1(prepared, binary_models, threshold, combine_rule)
    s2 = stage2(s1, multi, failures=failures)
    return s2.select(*[F.col(k) for k in keep], *[F.col(prob_col(m.name)) for m in binary_models],
                     *STAGE1_COLS, "variant", "variant_confidence", "variant_model")

"""Scoring models behind stage 1 (binary) and stage 2 (multiclass).

Two kinds share one interface:

* expression models (logistic, small trees, softmax) compile to plain Column
  expressions, so scoring stays inside whole-stage codegen and needs no
  shuffle; they are also what the SQL oracle can restate;
* fitted MLlib models (``PipelineModel`` with a probability vector), applied
  with ``transform`` and reduced to one probability column or array.

A model never needs the driver: ``score`` / ``class_probs`` only add columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.constants import DATASET_VARIANTS
from flowlens.functions.clean import col


# Generated arithmetic is handed to Spark as one SQL expression per model
# (parsed once in the JVM) instead of one Python->JVM call per node.
def sql_num(x: float) -> str:
    return f"({float(x)!r}D)"


def sql_col(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_linear(features, weights, bias) -> str:
    z = sql_num(bias)
    for f, w in zip(features, weights):
        z = f"({z} + {sql_num(w)} * {sql_col(f)})"
    return z


@dataclass(frozen=True)
class Logistic:
    """p = 1 / (1 + exp(-(bias + sum w_i x_i))), optionally rounded to ``digits``
    (so that score ties do not hinge on the last bit of ``exp``)."""
    name: str
    features: tuple
    weights: tuple
    bias: float
    digits: int | None = None

    def expr(self) -> Column:
        p = f"(1.0D / (1.0D + exp(-{sql_linear(self.features, self.weights, self.bias)})))"
        return F.expr(p if self.digits is None else f"round({p}, {int(self.digits)})")

    def score(self, df: DataFrame, out: str) -> DataFrame:
        return df.withColumn(out, self.expr())


@dataclass(frozen=True)
class Tree:
    """Binary tree: node = (feature, threshold, left, right), leaf = probability.

    ``x <= threshold`` goes left.
    """
    name: str
    features: tuple
    root: object

    def _node(self, node) -> str:
        if not isinstance(node, tuple):
            return sql_num(node)
        f, t, left, right = node
        return f"(CASE WHEN {sql_col(f)} <= {sql_num(t)} THEN {self._node(left)} ELSE {self._node(right)} END)"

    def expr(self) -> Column:
        return F.expr(self._node(self.root))

    def score(self, df: DataFrame, out: str) -> DataFrame:
        return df.withColumn(out, self.expr())


@dataclass(frozen=True)
class Softmax:
    """Class probabilities p_k = exp(z_k) / sum_j exp(z_j), z_k = b_k + sum w_kf x_f."""
    name: str
    features: tuple
    weights: tuple          # one tuple of feature weights per class
    bias: tuple
    labels: tuple = field(default=())   # class index -> raw label; default from the fixed table

    @property
    def num_class(self) -> int:
        return len(self.bias)

    def label_list(self) -> list[str]:
        return list(self.labels or DATASET_VARIANTS.get(self.name, []))

    def probs_expr(self) -> Column:
        """Single-expression form (repeats each exp; prefer ``class_probs``)."""
        ez = [F.exp(self._z(b, ws)) for b, ws in zip(self.bias, self.weights)]
        total = ez[0]
        for e in ez[1:]:
            total = total + e
        return F.array(*[e / total for e in ez])

    def _z(self, b, ws) -> Column:
        return F.expr(sql_linear(self.features, ws, b))

    def class_probs(self, df: DataFrame, out: str, gate: Column | None = None) -> DataFrame:
        """Probabilities in staged projections (see ``add_softmax_probs``)."""
        return add_softmax_probs(df, [(self, out)], gate)


def add_softmax_probs(df: DataFrame, models_outs, gate: Column | None = None) -> DataFrame:
    """Class probabilities of several softmax models in three projections:
    every exp once, then each model's total, then the ratios, so nothing is
    recomputed and the plan holds each exp a bounded number of times. With
    ``gate`` the exps are only evaluated where the gate holds (null elsewhere)."""
    e_cols, t_cols, a_cols = {}, {}, {}
    for m, out in models_outs:
        tag = f"_sm_{out}"
        names = []
        for k, (b, ws) in enumerate(zip(m.bias, m.weights)):
            e = F.exp(m._z(b, ws))
            e_cols[f"{tag}_e{k}"] = e if gate is None else F.when(gate, e)
            names.append(f"{tag}_e{k}")
        total = None
        for c in names:
            total = F.col(c) if total is None else total + F.col(c)
        t_cols[f"{tag}_t"] = total
        arr = F.array(*[F.col(c) / F.col(f"{tag}_t") for c in names])
        a_cols[out] = arr if gate is None else F.when(gate, arr)
    cur = df.withColumns(e_cols).withColumns(t_cols).withColumns(a_cols)
    return cur.drop(*e_cols, *t_cols)


@dataclass
class FittedBinary:
    """A fitted MLlib pipeline whose probability vector holds P(y=1) at index 1."""
    name: str
    features: tuple
    model: object           # pyspark.ml.PipelineModel

    def score(self, df: DataFrame, out: str) -> DataFrame:
        from pyspark.ml.functions import vector_to_array
        res = self.model.transform(df)
        prob = vector_to_array(F.col(self.model.stages[-1].getProbabilityCol()))[1]
        keep = [col(c) for c in df.columns]
        return res.select(*keep, prob.alias(out))


@dataclass
class FittedMulti:
    """A fitted multiclass model producing a probability array column."""
    name: str
    features: tuple
    model: object
    num_class: int
    labels: tuple = ()

    def label_list(self) -> list[str]:
        return list(self.labels or DATASET_VARIANTS.get(self.name, []))

    def class_probs(self, df: DataFrame, out: str) -> DataFrame:
        return self.model.class_probs(df, out)


def is_expression_model(m) -> bool:
    return hasattr(m, "expr") or hasattr(m, "probs_expr")

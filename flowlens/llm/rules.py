"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of a text are column expressions. A forest of shallow trees is
fitted on labelled rows; every tree path is a conjunctive rule (each of its
conditions ``statistic <= t`` or ``statistic > t``). A logistic model with a
lasso penalty weighs the rules, most weights become zero, and the rest is
compiled into one Spark column expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, let, written

#: Labelled rows for the fit: at most this many of each class, lowest hashes first.
MAX_ROWS = 8_000
TREES = 16
DEPTH = 3
LASSO = 1e-3
MAX_ITERATIONS = 40
SEED = 11
CUT = 0.7

#: Statistics, in the order of their columns.
STATISTICS = ("log_words", "mean_word", "distinct_share", "upper_share", "symbol_share", "digit_share",
              "mark_share", "pipe_share", "space_share", "line_words", "repeat_lines")


def statistics(text: Column) -> dict[str, Column]:
    """Expressions of the statistics of one text column without nulls.

    Shares are per character (0 for an empty text).
    """
    n = F.greatest(F.char_length(text), F.lit(1))

    def share(kind: str) -> Column:
        return (F.char_length(text) - F.char_length(F.regexp_replace(text, kind, ""))) / n

    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.split(text, "\n")
    n_words = F.size("__words")
    return {
        "__words": words,
        "__lines": lines,
        "log_words": F.log1p(n_words.cast("double")),
        "mean_word": F.char_length(text) / F.greatest(n_words, F.lit(1)),
        "distinct_share": F.size(F.array_distinct("__words")) / F.greatest(n_words, F.lit(1)),
        "upper_share": share(r"\p{Lu}+"),
        "symbol_share": share(r"[#*$%&<>=_~^]+"),
        "digit_share": share(r"[0-9]+"),
        "mark_share": share(r"[!?]+"),
        "pipe_share": share(r"[|]+"),
        "space_share": share(r"\s+"),
        "line_words": n_words / F.size("__lines"),
        "repeat_lines": 1 - F.size(F.array_distinct("__lines")) / F.size("__lines"),
    }


def measured(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the statistics of every whole text; a null text counts as empty."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    parts = statistics(F.col("__text"))
    rows = rows.select("doc_id", "__text", parts["__words"].alias("__words"), parts["__lines"].alias("__lines"))
    return rows.select("doc_id", *[parts[s].cast("double").alias(s) for s in STATISTICS])


@dataclass
class Ensemble:
    """``rules``: (weight, ((statistic, above, threshold), ...)); score = logistic of the sum."""

    intercept: float
    rules: list[tuple[float, tuple[tuple[str, bool, float], ...]]]

    def column(self) -> Column:
        """The score from 0 to 1 as an expression over the statistics' columns."""
        margin = F.lit(self.intercept)
        for weight, rule in self.rules:
            margin = margin + F.when(conjunction(rule), weight).otherwise(0.0)
        return let(margin, lambda m: 1.0 / (1.0 + F.exp(-m)))


def conjunction(rule) -> Column:
    out = F.lit(True)
    for name, above, t in rule:
        out = out & ((F.col(name) > t) if above else (F.col(name) <= t))
    return out


def tree_rules(forest) -> list[tuple[tuple[str, bool, float], ...]]:
    """All different paths from a root to any node below it, in a fixed order."""
    found = set()

    def walk(node, path):
        if path:
            # the tightest bound on each side of a statistic says it all
            tight = {}
            for name, above, t in path:
                old = tight.get((name, above))
                tight[name, above] = t if old is None else (max(old, t) if above else min(old, t))
            found.add(tuple(sorted((n, a, t) for (n, a), t in tight.items())))
        if node.numDescendants() > 0:
            split = node.split()
            name, t = STATISTICS[split.featureIndex()], float(split.threshold())
            walk(node.leftChild(), [*path, (name, False, t)])
            walk(node.rightChild(), [*path, (name, True, t)])

    for tree in forest.trees:
        walk(tree._java_obj.rootNode(), [])
    return sorted(found)


def bounded_rows(rows: DataFrame, label: str, max_rows: int) -> DataFrame:
    """Some ``max_rows`` rows of each class: those whose hash lies below a threshold
    that follows from the class's number of rows (nothing is sorted). Equal rows
    are one row.
    """
    sizes = written(rows.groupBy(F.col(label).alias("__class")).agg(F.count(F.lit(1)).alias("__rows")))
    place = F.shiftrightunsigned(F.xxhash64(*rows.columns), 11) / float(1 << 53)
    return rows.join(sizes, F.col(label) == F.col("__class")).where(
        place < F.lit(float(max_rows)) / F.col("__rows")).select(*rows.columns).distinct()


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality",
        max_rows: int = MAX_ROWS) -> Ensemble:
    """Rules and weights from labelled rows (labels 0 or 1, others are ignored).

    ``stats`` comes from ``measured``; both tables join on the id. An id with
    several labels gives several rows. Where one class is missing the score is
    constant: 1 or 0 for the class seen, 0.5 without any labelled row.
    """
    y = labels.where(F.col(label).isin(0, 1)).select(
        F.col(id_col).alias("__id"), F.col(label).cast("double").alias("__y"))
    labelled = stats.join(y, F.col("doc_id") == F.col("__id")).select("doc_id", "__y", *STATISTICS)
    rows = written(bounded_rows(labelled, "__y", max_rows).repartition(8, "doc_id"))
    seen = {r["__y"]: r["n"] for r in rows.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(seen) < 2:
        return Ensemble({1.0: 50.0, 0.0: -50.0}.get(next(iter(seen), None), 0.0), [])
    # both classes weigh alike in the trees; the lasso sees them as they come
    half = sum(seen.values()) / 2
    weight = F.when(F.col("__y") == 1, half / seen[1.0]).otherwise(half / seen[0.0])
    data = rows.select("__y", weight.alias("__w"), array_to_vector(F.array(*STATISTICS)).alias("__x"))
    forest = RandomForestClassifier(
        labelCol="__y", featuresCol="__x", weightCol="__w", numTrees=TREES, maxDepth=DEPTH,
        featureSubsetStrategy="onethird", subsamplingRate=0.8, seed=SEED).fit(data)
    rules = tree_rules(forest)
    fired = array_to_vector(F.array(*[conjunction(r).cast("double") for r in rules]))
    lasso = LogisticRegression(
        labelCol="__y", featuresCol="__r", elasticNetParam=1.0, regParam=LASSO, standardization=False,
        maxIter=MAX_ITERATIONS).fit(rows.select(
            "__y", fired.alias("__r")))
    weights = lasso.coefficients.toArray().tolist()
    return Ensemble(float(lasso.intercept), [(w, r) for w, r in zip(weights, rules) if w != 0.0])


def scored(stats: DataFrame, model: Ensemble, cut: float = CUT) -> DataFrame:
    """doc_id, score and predicted (1 where the score is ``cut`` or more) of each row."""
    return stats.select("doc_id", model.column().alias("score")).select(
        "doc_id", "score", (F.col("score") >= cut).cast("int").alias("predicted"))

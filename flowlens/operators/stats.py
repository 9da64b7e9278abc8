"""Label statistics and feature scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.constants import LABEL_BINARY, LABEL_COLS, LEAK_EXACT, LEAK_PREFIX
from flowlens.functions.clean import col, to_double


def non_leak_columns(df: DataFrame) -> list[str]:
    """Columns that are not leaks: neither one of the exact names nor
    starting with a leak prefix, in frame order."""
    leaks = set(LEAK_EXACT)
    prefixes = (LEAK_PREFIX,) if isinstance(LEAK_PREFIX, str) else tuple(LEAK_PREFIX)
    leaks.update(c for p in prefixes for c in df.columns if c[:len(p)] == p)
    return [c for c in df.columns if c not in leaks]


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Numeric columns (booleans and strings excluded)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def feature_columns(df: DataFrame, keys=("row_id",)) -> list[str]:
    """P11 + P2 + P3: numeric, non-leak, non-label, non-key columns in frame order."""
    skip = set(LABEL_COLS) | set(keys)
    return [c for c in non_leak_columns(df.select(*[col(n) for n in numeric_columns(df)])) if c not in skip]


def distinct_labels(df: DataFrame, label: str, by=()) -> DataFrame:
    """A1/A2: sorted distinct labels and the class count max+1 (1 when empty)."""
    return df.groupBy(*by).agg(
        F.array_join(F.array_sort(F.collect_set(F.col(label))), ",").alias("labels"),
        F.coalesce(F.max(label) + 1, F.lit(1)).alias("num_class"))


def class_counts(df: DataFrame, label: str, by=()) -> DataFrame:
    """A3: rows per class."""
    return df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))


def point_biserial(df: DataFrame, features, label: str = LABEL_BINARY) -> DataFrame:
    """A4: |population Pearson r| of each feature with the label, one pass.

    Nulls count as 0; the score is 0 where either variance is not positive.
    One global aggregate of moment sums (partial per partition), then the
    one-row result is unpivoted to (feature, score).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    y = to_double(col(label), types[label])
    xs = {f: to_double(col(f), types[f]) if f in types else F.lit(0.0) for f in features}
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy")]
    for i, f in enumerate(features):
        x = xs[f]
        aggs += [F.sum(x).alias(f"sx{i}"), F.sum(x * x).alias(f"sxx{i}"), F.sum(x * y).alias(f"sxy{i}")]
    m = df.agg(*aggs)
    n = F.col("n").cast("double")
    my = F.col("sy") / n
    vy = F.col("syy") / n - my * my
    rows = []
    for i, f in enumerate(features):
        mx = F.col(f"sx{i}") / n
        vx = F.col(f"sxx{i}") / n - mx * mx
        cov = F.col(f"sxy{i}") / n - mx * my
        score = F.when((vx > 0) & (vy > 0), F.abs(cov / F.sqrt(vx * vy))).otherwise(F.lit(0.0))
        rows.append(F.struct(F.lit(f).alias("feature"), F.round(score, 6).alias("score")))
    return m.where(F.col("n") > 0).select(F.inline(F.array(*rows)))


def top_k(scores: DataFrame, k: int, score: str = "score", name: str = "feature") -> DataFrame:
    """O2: k best by score, name order on ties, with 1-based rank."""
    from pyspark.sql import Window
    top = scores.orderBy(F.desc(score), name).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), name)))

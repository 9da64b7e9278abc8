"""Ordered (prefix) computations that stay parallel under skew.

A window ``partitionBy(group).orderBy(score)`` runs each group in one task;
when one dataset holds a third of all rows that task holds a third of the
data. Here the order is cut into contiguous chunks that are a deterministic
function of the order key, chunk totals are prefix-summed over a small table,
and each chunk then runs its own window. Every step is a DataFrame operator;
no sampling, no partition ids, so task retries recompute identical results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Chunks of an octave (a factor of two) of a score.
PER_OCTAVE = 1024
_ZERO_EXP = 1100        # below the exponent of the smallest double


def _ordered_bits(x: Column, per_octave: int) -> Column:
    """Exponent and leading fraction bits of a positive double as one integer,
    monotone in x: chunks are as fine near 0 as the values themselves."""
    e = F.floor(F.log2(x))
    return ((e + _ZERO_EXP) * per_octave + F.floor((x / F.pow(F.lit(2.0), e) - 1) * per_octave)).cast("int")


def score_chunk(score: Column, chunks: int = PER_OCTAVE) -> Column:
    """Chunk of a score of any shape, monotone in it.

    Scores crowd near 0 and near 1 (saturated probabilities) or around any
    value (raw margins): chunks follow the binary exponent of the distance to
    0 below one half, of the distance to 1 from there to 1, and of the value
    elsewhere, ``chunks`` for each power of two. Their number is bounded by
    the doubles' exponents.
    """
    s = score.cast("double")
    half = (_ZERO_EXP - 1) * chunks
    return (F.when(s < 0, -_ordered_bits(-s, chunks))
            .when(s == 0, 0)
            .when(s <= 0.5, _ordered_bits(s, chunks))
            .when(s < 1, 2 * half - _ordered_bits(1 - s, chunks))
            .otherwise(2 * half + _ordered_bits(s, chunks)))


def prefix_sums(df: DataFrame, group_cols, chunk: Column, order, sums: dict,
                descending: bool = True) -> DataFrame:
    """Add running totals ``<name>_cum`` (inclusive, in ``order`` direction) and
    group totals ``<name>_total`` for each column in ``sums`` (name -> column).

    ``order`` is a column or a list of columns; ``chunk`` must be monotone in
    it (same direction) within a group. Nulls in group columns and chunks are
    values like any other: the key is one struct, and structs with equal nulls
    are equal, so that no row is lost in the join.
    """
    group_cols = list(group_cols)
    order = list(order) if isinstance(order, (list, tuple)) else [order]
    base = df.withColumn("_chunk", chunk)
    key = F.struct(*[F.col(c) for c in group_cols], F.col("_chunk"))
    base = base.withColumn("_key", key)
    tot = base.groupBy(*group_cols, "_chunk", "_key").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    ochunk = F.desc("_chunk") if descending else F.asc("_chunk")
    before = Window.partitionBy(*group_cols).orderBy(ochunk).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group_cols)
    offsets = tot.select("_key",
                         *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums],
                         *[F.sum(f"_t_{n}").over(whole).alias(f"{n}_total") for n in sums])
    # Explicitly spread by (group, chunk): a hash partitioning on the group
    # alone would also satisfy the window below and put a hot group in one task.
    joined = base.join(offsets, on="_key", how="inner").repartition("_key")
    within = (Window.partitionBy("_key")
              .orderBy(*[o.desc() if descending else o.asc() for o in order])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = joined.withColumns({f"{n}_cum": F.col(f"_o_{n}") + F.sum(c).over(within) for n, c in sums.items()})
    return out.drop("_chunk", "_key", *[f"_o_{n}" for n in sums])


def cumulative_by_score(df: DataFrame, group_cols, score: str, label: str,
                        chunks: int = PER_OCTAVE) -> DataFrame:
    """Per group and distinct score (descending), positives/negatives at the
    score and at-or-above it.

    Output: group cols, ``s``, ``pos``, ``neg``, ``tp`` (= pos_cum), ``fp``,
    ``P``, ``N``. Rows are first grouped by score (map-side partial
    aggregation), so ties collapse before anything is ordered. Null groups are
    groups; rows without a score or a label cannot be ranked and stay out.
    """
    y = F.col(label).cast("long")
    g = (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
         .groupBy(*group_cols, F.col(score).alias("s")).agg(
        F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg")))
    out = prefix_sums(g, group_cols, score_chunk(F.col("s"), chunks), F.col("s"),
                      {"pos": F.col("pos"), "neg": F.col("neg")})
    return out.select(*group_cols, "s", "pos", "neg",
                      F.col("pos_cum").alias("tp"), F.col("neg_cum").alias("fp"),
                      F.col("pos_total").alias("P"), F.col("neg_total").alias("N"))


#: Groups of the first level of ``first_n``.
FIRST_GROUPS = 256


def first_n(df: DataFrame, n: int, order_col: str, by=()) -> DataFrame:
    """The first ``n`` rows (of each ``by`` group) in the order of a column.

    Two levels: rows are dealt by a hash of the order column, each group keeps
    its first n (partially before the shuffle), and one task sees only
    ``FIRST_GROUPS * n`` rows, whatever the number of input partitions. Ties
    are broken by a hash of the row.
    """
    tie = F.xxhash64(*[c for c in df.columns])
    dealt = df.withColumns({"_part": F.pmod(F.xxhash64(order_col), F.lit(FIRST_GROUPS)), "_tie": tie})
    for keys in ([*by, "_part"], list(by)):
        w = Window.partitionBy(*keys).orderBy(order_col, "_tie")
        dealt = dealt.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")
    return dealt.drop("_part", "_tie")

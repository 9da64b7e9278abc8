"""Stratified splits and seeded samples.

Order inside a stratum is ``md5(cast(key as string))``: deterministic,
restatable in SQL, and uniformly spread, so its first four hex digits cut the
stratum into 65,536 contiguous chunks of similar size. Positions come from
the chunked prefix sum, so a hot stratum (one label holding a third of all
rows) never lands in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.operators.ordered import prefix_sums


def hash_order(key: str, seed: str | None = None) -> Column:
    # a null key has a place in the order too (that of the empty text)
    k = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), k) if seed is not None else k)


def stratum_position(df: DataFrame, strata, key: str, seed: str | None = None) -> DataFrame:
    """Add ``pos`` (0-based position in the stratum by hash order) and ``n``.

    Null strata are strata. Rows that share a key are ordered by a hash of the
    whole row, so the split does not depend on the run; rows equal in all
    columns are interchangeable."""
    h = hash_order(key, seed)
    base = df.withColumns({"_h": h, "_tie": F.xxhash64(*df.columns)})
    chunk = F.conv(F.substring(F.col("_h"), 1, 4), 16, 10).cast("int")
    out = prefix_sums(base, strata, chunk, [F.col("_h"), F.col("_tie")], {"_one": F.lit(1)}, descending=False)
    return out.withColumn("pos", F.col("_one_cum") - 1).withColumnRenamed("_one_total", "n") \
              .drop("_h", "_tie", "_one_cum")


def stratified_split(df: DataFrame, strata, key: str, fractions=(0.70, 0.15),
                     names=("train", "val", "test"), seed: str | None = None) -> DataFrame:
    """M1/M2: per stratum the first floor(n*f1) rows by hash order are ``train``,
    the next floor(n*f2) ``val``, the rest ``test`` (a single fraction gives a
    two-way cut)."""
    pos = stratum_position(df, strata, key, seed)
    cuts = []
    acc = None
    for f in fractions:
        # integer basis points: the cut is exact, not subject to n * 0.7 in binary
        part = F.floor(F.col("n") * F.lit(int(round(f * 10000))) / F.lit(10000))
        acc = part if acc is None else acc + part
        cuts.append(acc)
    split = None
    for c, name in zip(cuts, names):
        split = F.when(F.col("pos") < c, F.lit(name)) if split is None else split.when(F.col("pos") < c, F.lit(name))
    split = split.otherwise(F.lit(names[len(cuts)]))
    return pos.withColumn("split", split).drop("pos", "n")


def split_counts(df: DataFrame, by=("dataset", "split"), label: str = "y_binary") -> DataFrame:
    """Rows per split and label."""
    return df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """O3: the first n rows by seeded hash order (a uniform sample, not a head).

    Equal to ``orderBy(md5(seed:key), key).limit(n)``, but without its final
    single-task merge of n rows from every partition: rows are counted per
    hash-prefix chunk (65,536 of them, a small table), only the chunks that
    can hold the first n rows are kept, and positions are ranked inside
    those chunks. No task sees more than one chunk.
    """
    h = hash_order(key, str(seed))
    base = df.withColumn("_h", h).withColumn("_chunk", F.conv(F.substring("_h", 1, 4), 16, 10).cast("int"))
    tot = base.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_t"))
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (tot.select("_chunk", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
               .where(F.col("_o") < F.lit(n)))
    # at most 65,536 chunk rows: a bounded broadcast
    cand = base.join(F.broadcast(offsets), on="_chunk", how="inner")
    within = Window.partitionBy("_chunk").orderBy("_h", key, F.xxhash64(*df.columns))
    pos = F.col("_o") + F.row_number().over(within) - 1
    return cand.withColumn("_pos", pos).where(F.col("_pos") < F.lit(n)).drop("_h", "_chunk", "_o", "_pos")


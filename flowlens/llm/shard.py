"""Sharding by proportional stratified interleaving.

Rows are put in a seeded random order within each source; a row's fractional
rank is (2 * rank - 1) / (2 * rows of its source). Sorted by fractional rank,
every stretch of the table has nearly the mixture of the whole, and the table
is cut there into shards whose row counts differ by at most one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BUCKETS, prefix_sums, written

SEED = "interleave-1"


def interleave_shards(df: DataFrame, n_shards: int, id_col: str = "doc_id", text: str = "text",
                      source: str = "source", seed: str = SEED) -> DataFrame:
    """One row per row of ``df``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 length of the text (null: 0) plus 16; a null text has
    the checksum of the empty text. Null sources are a source of their own.
    Ties of the seeded order (a repeated id) are broken by size and checksum;
    rows equal in all of these are interchangeable. With fewer rows than shards
    some shards stay empty; an empty table gives an empty result. The text is
    read once and never moves: only ids, sizes and ranks are shuffled.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = written(df.select(
        F.col(id_col).alias("doc_id"), F.col(source).alias("__source"),
        (F.octet_length(body) + F.lit(16)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("__h"))
        .withColumn("__b1", F.conv(F.substring("__h", 1, 3), 16, 10).cast("int")))
    tie = [F.col("__h"), F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    ranked = prefix_sums(rows, ["__source"], "__b1", tie, {})
    counts = rows.groupBy(F.col("__source").alias("__s")).agg(F.count(F.lit(1)).alias("__n"))
    frac = (2 * F.col("__pos") - 1) / (2 * F.col("__n"))
    placed = (ranked.join(counts, F.col("__source").eqNullSafe(F.col("__s")))
              .select("doc_id", "size", "text_crc32", "__source", "__h", frac.alias("__frac"),
                      F.floor(frac * BUCKETS).cast("int").alias("__b2")))
    order = [F.col("__frac"), F.col("__source"), *tie]
    index = prefix_sums(placed, [], "__b2", order, {})
    total = rows.agg(F.count(F.lit(1)).alias("__total"))
    # index i goes to shard i * n div total; that shard's first index is ceil(shard * total / n)
    return (index.withColumn("__total", total.scalar())
            .withColumn("__at", F.col("__pos") - 1)
            .withColumn("shard", F.expr(f"cast((__at * {n_shards}) div __total as int)"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    F.expr(f"__at - ((shard * __total + {n_shards} - 1) div {n_shards})").cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def write_shards(df: DataFrame, assigned: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the rows of ``df`` as one folder per shard, in slot order within files.

    ``assigned`` comes from ``interleave_shards`` over the same rows (unique
    ids). Large shards are split over several tasks by ranges of slots.
    """
    spots = assigned.select(F.col("doc_id").alias("__id"), "shard", "slot")
    rows = df.join(spots, F.col(id_col).eqNullSafe(F.col("__id"))).drop("__id")
    (rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))

"""Exact deduplication over content-defined chunk recipes (DataFrame functions only).

A text is cut into chunks at sentence ends and line breaks (after at least
``MIN_CHUNK`` and at most ``MAX_CHUNK`` characters). Each chunk is replaced by
an identifier, and documents are compared by their ordered identifier lists.
Chunk texts move once, to verify the identifiers: a digest that stands for two
different chunks anywhere in the corpus is no identifier, and its chunks are
then written out in full in the lists. Long documents themselves never move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, one_of_each, written

MIN_CHUNK = 512
MAX_CHUNK = 4096


def _chunks(text: Column) -> Column:
    cut = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?(?<=[.!?\n])|.{{1,{MAX_CHUNK}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def ambiguous_digests(df: DataFrame, text: str = "text") -> DataFrame:
    """Digests that stand for more than one chunk text (column ``digest``).

    Equal chunks collapse before the shuffle. By the birthday bound, 2e11
    chunks (100 TB) have some 1,000 of these; small corpora have none.
    """
    chunk = df.select(F.explode(_chunks(ascii_lower(F.coalesce(F.col(text), F.lit(""))))).alias("chunk"))
    distinct = chunk.groupBy(F.xxhash64("chunk").alias("digest"), "chunk").agg(F.lit(1).alias("one"))
    return distinct.groupBy("digest").agg(F.count("one").alias("n")).where("n > 1").select("digest")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as the
    empty text, and empty texts are equal. The largest id of a group stays.
    Rows that repeat an id within a group count in ``group_size`` and are all
    marked alike; a null id never stays before another id, and a group of null
    ids only keeps its rows. An empty table gives an empty result. Other columns
    are ignored.
    """
    norm = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    shared = ambiguous_digests(df, text).agg(F.collect_set("digest").alias("d")).scalar()
    recipe = F.transform(_chunks(F.col("__norm")), lambda c: F.struct(
        F.xxhash64(c).alias("digest"),
        F.when(F.array_contains(F.col("__shared"), F.xxhash64(c)), c).alias("verbatim")))
    rows = written(
        df.select(F.col(id_col).alias("doc_id"), norm.alias("__norm"), shared.alias("__shared"))
        .select("doc_id", recipe.alias("recipe"), F.sha2(F.col("__norm"), 256).alias("text_sha256")))
    # written: groups of several join by their size, and a large group's rows can be split
    groups = written(rows.groupBy(F.col("recipe").alias("__recipe")).agg(
        F.max("doc_id").alias("__keep"), F.count(F.lit(1)).alias("__size")).where("__size > 1"))
    joined = rows.join(groups, F.col("recipe") == F.col("__recipe"), "left")
    keep = F.when(F.col("__size").isNull(), F.col("doc_id")).otherwise(F.col("__keep"))
    return joined.select("doc_id", keep.alias("keep_id"), F.coalesce("__size", F.lit(1)).cast("long").alias("group_size"),
                         F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def drop_copies(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``df`` for each different text, with all columns of ``df``.

    The largest id of a text stays. Rows that agree in id and text, null ids
    included, are one document delivered more than once, and one of them stays.
    """
    kept = exact_groups(df, id_col, text).where("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n"))
    sha = F.sha2(ascii_lower(F.coalesce(F.col(text), F.lit(""))), 256)
    return one_of_each(df, kept, (F.col(id_col), "doc_id"), (sha, "text_sha256"))

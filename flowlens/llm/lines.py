"""Quality rules: cross-document line frequency (DataFrame functions only).

Lines are normalised (lower case, white space and digits folded) and hashed.
For each host the distinct documents of a line are counted; a line in more than
``MAX_SHARE`` of the host's documents, and in more than ``MIN_DOCS`` of them, is
boilerplate. Removing those lines, a document that keeps less than ``MIN_LEFT``
of its words is depleted and rejected, as is one that fails the base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, let, written

MAX_SHARE = 0.01
MIN_DOCS = 10
MIN_LEFT = 0.2
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Words that lie in a window of five words found twice or more in the text.

    Windows are compared by 64-bit hashes first; only for texts where some hash
    repeats are the windows themselves sorted beside their places. The repeated
    places in order then cover min(5, step to the next place) words each.
    """
    def windows(w: Column, make) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), make)

    def rough(w: Column) -> Column:
        hashes = F.transform(w, lambda x: F.xxhash64(x))
        return let(hashes, lambda h: windows(h, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(-1, WINDOW - 1)])))

    def covered(w: Column) -> Column:
        placed = F.sort_array(windows(w, lambda i: F.struct(F.slice(w, i, F.lit(WINDOW)).alias("w"), i.alias("i"))))
        return let(placed, lambda p: let(
            F.sort_array(F.transform(F.filter(p, lambda x, k: (
                x.getField("w") == F.get(p, k + 1).getField("w")) & F.get(p, k + 1).isNotNull()
                | (k > 0) & (x.getField("w") == F.get(p, F.greatest(k - 1, F.lit(0))).getField("w"))),
                lambda x: x.getField("i"))),
            lambda at: F.aggregate(
                F.transform(at, lambda a, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - a, F.lit(WINDOW)))),
                F.lit(0), lambda s, x: s + x)))

    def count(w: Column) -> Column:
        return F.when(F.size(w) <= WINDOW, 0).otherwise(let(
            rough(w), lambda r: F.when(F.size(F.array_distinct(r)) == F.size(r), 0).otherwise(covered(w))))

    return let(words, count).cast("long")


def _base(text: str, words: str) -> dict[str, Column]:
    """The base statistics from a text column without nulls and its words."""
    body = F.col(text)
    spaces = F.char_length(F.regexp_replace(body, WORD, ""))
    plain = F.char_length(F.regexp_replace(body, SYMBOLS + "+", ""))
    solid = F.filter(F.split(body, "\n"), lambda l: F.regexp_like(l, F.lit(WORD)))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": (F.char_length(body) - spaces).cast("long"),
        "n_symbols": (F.char_length(body) - plain).cast("long"),
        "n_dup_lines": let(solid, lambda l: (F.size(l) - F.size(F.array_distinct(l))).cast("long")),
        "n_repeat_words": repeat_words(F.col(words)),
    }


def normalised(line: Column) -> Column:
    """Lower case, runs of digits as 0, runs of white space as a space, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), r"[\x20\x09-\x0D]+", " "))


def line_verdicts(df: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source",
                  max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """One row per row of ``df``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_left.

    ``n_left`` counts the words outside removed lines. Null hosts are a host of
    their own; a null or empty text has no words and fails the base rules. Each
    row is a document: repeated rows all count towards a line's documents and
    get the same verdict. An empty table gives an empty result. Texts are read
    once and not moved: line hashes and counts are shuffled, equal lines of a
    document count once, and a line that a third of the host's documents hold
    is one row of the pre-aggregated counts.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(host).alias("host"), body.alias("__text"),
                     _words(body).alias("__words"))
    base = _base("__text", "__words")
    with_word = F.filter(F.split("__text", "\n"), lambda l: F.regexp_like(l, F.lit(WORD)))
    rows = written(rows.select(
        "doc_id", "host", F.xxhash64("__text").alias("version"), *[c.alias(n) for n, c in base.items()],
        F.transform(with_word, lambda l: F.struct(
            F.xxhash64(normalised(l)).alias("line"), F.size(_words(l)).alias("words"))).alias("lines")))
    counts = (rows.select("host", F.explode(F.array_distinct("lines.line")).alias("line"))
              .groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") > min_docs))
    hosts = rows.groupBy(F.col("host").alias("__h")).agg(F.count(F.lit(1)).alias("host_docs"))
    # written: its measured size decides whether the join below broadcasts it
    frequent = written(counts.join(hosts, F.col("host").eqNullSafe(F.col("__h")))
                       .where(F.col("docs") > max_share * F.col("host_docs"))
                       .select(F.col("host").alias("__h"), F.col("line").alias("__l")))
    key = ["doc_id", "host", "version"]
    hits = (rows.select(*key, F.posexplode("lines").alias("pos", "l")).select(*key, "pos", "l.line", "l.words")
            .join(frequent, F.col("host").eqNullSafe(F.col("__h")) & (F.col("line") == F.col("__l")), "left_semi"))
    removed = (hits.select(*key, "pos", "words").distinct().groupBy(*[F.col(k).alias(f"__{k}") for k in key])
               .agg(F.sum("words").alias("__removed")))
    same = F.col("doc_id").eqNullSafe(F.col("__doc_id")) & F.col("host").eqNullSafe(F.col("__host")) \
        & (F.col("version") == F.col("__version"))
    left = F.col("n_words") - F.coalesce(F.col("__removed"), F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.drop("lines").join(removed, same, "left").select(
        "doc_id", *base, failed.alias("base_failed"),
        (~failed & (left >= min_left * F.col("n_words"))).alias("kept"), left.alias("n_left"))

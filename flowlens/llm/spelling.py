"""Spelling variants: near words found by asymmetric q-chunks (DataFrame functions only).

Two words within one inserted, deleted or replaced code point. Of such a pair the
shorter word (of equal ones the first in order) contributes two disjoint chunks,
its halves, and the other its positional grams of those lengths. One edit leaves
one of the two chunks whole, at a place shifted by one at most, so the pair meets
at a gram; only grams at places that a chunk can take are sent. Candidates are
verified on the whole words. Where a chunk is shared by many words, candidates
would be all their pairs: there the words also meet at what remains of them
beside the chunk, less the one code point that differs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _UPPER, written

RUN = "[A-Za-z\\u00C0-\\u00FF]"
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
#: A chunk whose two sides give more candidates than this is hot.
HOT = 1024
#: Links of forms grow tenfold a step, so that chains of longs end within 19 steps.
_DOUBLINGS = 5


def word_runs(df: DataFrame, id_col: str = "doc_id", text: str = "text", damage: int = 31,
              min_length: int = MIN_LENGTH) -> DataFrame:
    """Column ``word``: the letter runs of at least ``min_length`` code points, A-Z lower-cased.

    With ``damage``, a run whose crc32 of ``<id>:<run>`` that number divides has one
    code point taken out (a null id is written as nothing). Runs are maximal.
    """
    run = F.translate("run", _UPPER, _UPPER.lower())
    runs = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                     F.explode(F.regexp_extract_all(F.col(text), F.lit(f"{RUN}{{{min_length},}}"), F.lit(0))).alias("run"))
    runs = runs.select("id", run.alias("run"))
    if damage:
        runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
        at = F.pmod(F.col("h"), F.char_length("run")).cast("int")
        less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
        runs = runs.select(F.when(F.col("h") % damage == 0, less).otherwise(F.col("run")).alias("run"))
    return runs.where(F.char_length("run") >= min_length).select(F.col("run").alias("word"))


def frequent_words(runs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with at least ``min_count`` occurrences; pre-aggregated."""
    return runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _part(word: Column, start: Column, length: Column) -> Column:
    return F.substring(word, start + 1, length)


def _gram(word: Column, start: Column, size: Column, length: Column, second: int) -> Column:
    """A gram as it is sent: a hash of its text, the length of the chunk's word and
    which chunk it is (words of equal hashes are compared whole), and its place."""
    key = F.xxhash64(_part(word, start, size), length.cast("int"), F.lit(second))
    return F.struct(key.alias("key"), start.cast("int").alias("at"), size.cast("int").alias("size"))


def _chunk_side(words: DataFrame) -> DataFrame:
    """(s, key, at, size): two disjoint chunks of each word, its halves."""
    word, n = F.col("word"), F.char_length("word")
    half = F.floor(n / 2).cast("int")
    both = F.array(_gram(word, F.lit(0), half, n, 0), _gram(word, half, n - half, n, 1))
    return words.select(word.alias("s"), F.explode(both).alias("c")).select("s", "c.key", "c.at", "c.size")


def _gram_side(words: DataFrame) -> DataFrame:
    """(t, key, gram_at, gram_size, grows): the positional grams of each word at the
    places where a chunk of a word as long, or one shorter, can stand."""
    word, n = F.col("word"), F.char_length("word")

    def gram(length: Column, second: int, shift: int) -> Column:
        half = F.floor(length / 2).cast("int")
        start, size = (half + shift, length - half) if second else (F.lit(0), half)
        return F.struct(_gram(word, start, size, length, second).alias("g"), (length < n).alias("grows"))

    # a replaced code point shifts nothing; an inserted one shifts what stands behind it
    grams = F.array(gram(n, 0, 0), gram(n, 1, 0), gram(n - 1, 0, 0), gram(n - 1, 1, 1))
    return words.select(word.alias("t"), F.explode(grams).alias("x")).select(
        "t", "x.g.key", F.col("x.g.at").alias("gram_at"), F.col("x.g.size").alias("gram_size"), "x.grows")


def _beside(word: str, at: str, size: str) -> Column:
    """What remains of a word beside a gram."""
    return F.concat(_part(F.col(word), F.lit(0), F.col(at)), _part(F.col(word), F.col(at) + F.col(size), F.char_length(word)))


def _without_one(rest: Column) -> Column:
    """(place, rest without that code point) for each place."""
    return F.transform(F.sequence(F.lit(0), F.char_length(rest) - 1), lambda i: F.struct(
        i.alias("place"), F.concat(F.substring(rest, F.lit(1), i), F.substring(rest, i + 2, F.char_length(rest))).alias("less")))


def near_pairs(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(s, t): each pair of different words that differ by exactly one edit, once.

    ``words`` has distinct words of at least two code points; of a pair, s is the
    shorter word or the first in order. Chunks with more than ``hot`` candidates
    go by what remains beside the chunk: there words meet only where the rest
    agrees but for one code point. Both ways are exact.
    """
    words = words.select("word")
    chunks, grams = written(_chunk_side(words)), written(_gram_side(words))
    sides = (chunks.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.lit(0).alias("g"))
             .unionByName(grams.groupBy("key").agg(F.lit(0).alias("c"), F.count(F.lit(1)).alias("g")))
             .groupBy("key").agg(F.sum("c").alias("c"), F.sum("g").alias("g")))
    size = F.col("c").cast("double") * F.col("g")
    # a word meets itself at its own chunks: keys of one word each have nothing to find
    sides = written(sides.where((F.col("c") > 0) & (F.col("g") > 0) & (F.col("c") + F.col("g") > 2))
                    .select(F.col("key").alias("k"), (size > hot).alias("hot")))
    chunks = chunks.join(sides, F.col("key") == F.col("k")).drop("k")
    grams = grams.join(sides, F.col("key") == F.col("k")).drop("k")

    def matched(left: DataFrame, right: DataFrame, *on: str) -> DataFrame:
        right = right.select(*[F.col(c).alias(f"__{c}") for c in on], "t", "gram_at", "grows")
        same = None
        for c in on:
            same = (F.col(c) == F.col(f"__{c}")) if same is None else same & (F.col(c) == F.col(f"__{c}"))
        near = left.join(right, same & (F.abs(F.col("at") - F.col("gram_at")) <= 1))
        return near.where((F.col("grows") | (F.col("s") < F.col("t"))) & (F.levenshtein("s", "t", 1) == 1)).select("s", "t")

    plain = matched(chunks.where(~F.col("hot")), grams.where(~F.col("hot")), "key")
    left = chunks.where("hot").select("s", "key", "at", _beside("s", "at", "size").alias("less"))
    right = grams.where("hot").select("t", "key", "gram_at", "grows", F.explode(
        _without_one(_beside("t", "gram_at", "gram_size"))).alias("v")).select("t", "key", "gram_at", "grows", "v.place", "v.less")
    inserted = matched(left, right.where("grows"), "key", "less")
    replaced = matched(left.select("s", "key", "at", F.explode(_without_one(F.col("less"))).alias("v"))
                       .select("s", "key", "at", "v.place", "v.less"), right.where(~F.col("grows")), "key", "place", "less")
    return plain.unionByName(replaced).unionByName(inserted).distinct()


def variant_forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word of ``words`` (word, n): word, form, root, n, n_near, form_n.

    ``n_near`` counts the words one edit away. ``form`` is the near word of largest
    n (ties: the smallest in code-point order) where that n is at least ``ratio``
    times the word's, else null; ``root`` is what following the forms ends at, the
    word itself if it has none. An empty table gives an empty result.
    """
    words = written(words.select("word", "n"))
    pairs = written(near_pairs(words))
    both = pairs.unionByName(pairs.select(F.col("t").alias("s"), F.col("s").alias("t")))
    near = both.join(words.select(F.col("word").alias("w"), "n"), F.col("t") == F.col("w")).groupBy("s").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("t").alias("form"))).alias("best"))
    rows = words.join(near, F.col("word") == F.col("s"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.struct(F.col("best.form").alias("form"), (-F.col("best.less")).alias("n"))).alias("to"))
    rows = written(rows.select("word", "n", "n_near", F.col("to.form").alias("form"), F.col("to.n").alias("form_n")))
    # the end of each chain: links are doubled, only words with a form move
    links = written(rows.where(F.col("form").isNotNull()).select(F.col("word").alias("from"), F.col("form").alias("end")))
    for _ in range(_DOUBLINGS):
        onward = links.select(F.col("from").alias("f"), F.col("end").alias("e"))
        links = written(links.join(onward, F.col("end") == F.col("f"), "left").select(
            "from", F.coalesce("e", "end").alias("end")))
    return rows.join(links, F.col("word") == F.col("from"), "left").select(
        "word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(df: DataFrame, id_col: str = "doc_id", text: str = "text", damage: int = 31) -> DataFrame:
    """Spelling variants among the words of all texts: see ``word_runs`` and ``variant_forms``.

    Null and empty texts have no words, repeated rows count again, other columns
    are ignored, very long texts are read whole.
    """
    return variant_forms(frequent_words(word_runs(df, id_col, text, damage)))

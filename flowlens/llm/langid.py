"""Language identification by interpolated Kneser-Ney character models.

A text becomes lower-case letters with single spaces for all else. For each
learned language an order-``ORDER`` character model with absolute discounting
and continuation counts is kept in sorted hash arrays: the hashes of all seen
n-grams of an order, sorted, beside a row of log-probabilities and back-off
weights per language. Counts, discounts, back-offs and probabilities are grouped
and joined on the executors; only the finished arrays reach the driver.

The language of the lowest cross-entropy per character wins. A text is rejected
where that entropy lies further above the language's usual one than documents
set aside from learning do at the same effective length (their different
n-grams, so that a text that repeats itself counts as the short text it is).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .textbytes import give_back

ORDER = 4
#: Learning takes about this many documents of a language, whole (those with the lowest hashes),
MAX_DOCS = 1500
#: and fewer where there are many languages, so that n-grams times languages stay
#: below some MAX_CELLS (a document brings some GRAMS_A_DOC n-grams that others lack).
MAX_CELLS = 20_000_000
GRAMS_A_DOC = 100
#: One in this many learning documents calibrates instead of counting, in languages
#: with at least MIN_ROWS of them; smaller languages count all.
CALIBRATION = 5
MIN_ROWS = 50
#: Rejection beyond this many times the QUANTILE of the calibration documents'
#: distances, by octaves of the effective length with at least MIN_SHOWN documents
#: each. The quantile does not move where some of them are in a wrong language; the
#: factor covers the heavy tail of right ones (one in 300 lies beyond).
REACH = 10.0
QUANTILE = 0.9
MIN_SHOWN = 20
OCTAVES = 14
UNKNOWN = "und"
_WINDOW = 1 << 17
_P = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def symbols(text: str) -> np.ndarray:
    """Code points of the letters, each run of anything else being one space; a
    space before and after."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]
    return np.where(letter, points, 32)[keep]


def gram_hashes(points: np.ndarray, order: int) -> np.ndarray:
    """Hash of the n-gram that ends at each place from order - 1 on."""
    n = len(points) - order + 1
    h = np.zeros(max(n, 0), np.uint64)
    for k in range(order if n > 0 else 0):
        h = (h + points[k:k + n] + np.uint64(1)) * _P
        h ^= h >> np.uint64(29)
    return h


@dataclass
class Model:
    """``grams[n]``: sorted hashes of order n + 1; ``logp[n]`` and ``backoff[n]``
    per n-gram and language."""

    languages: list[str]
    grams: list[np.ndarray]
    logp: list[np.ndarray]
    backoff: list[np.ndarray]
    floor: np.ndarray
    #: per language the usual entropy of its calibration documents (null: too few),
    usual: np.ndarray = field(default_factory=lambda: np.zeros(0))
    #: and how far above it a text may lie, by octave of its effective length
    limits: np.ndarray = field(default_factory=lambda: np.full(OCTAVES, np.inf))

    def _find(self, order: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        table = self.grams[order - 1]
        at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
        return at, table[at] == hashes

    def _scores(self, points: np.ndarray, where: np.ndarray, order: int) -> np.ndarray:
        """Log-probabilities (places x languages) of the symbols at ``where``,
        given the order - 1 before them."""
        if order == 0:
            return np.broadcast_to(self.floor, (len(where), len(self.floor)))
        grams = np.zeros(len(where), np.uint64)
        context = grams
        for k in range(order):
            context = grams
            grams = (grams + points[where - order + 1 + k] + np.uint64(1)) * _P
            grams ^= grams >> np.uint64(29)
        at, seen = self._find(order, grams)
        out = self.logp[order - 1][at]
        miss = np.flatnonzero(~seen)
        if len(miss):
            lower = self._scores(points, where[miss], order - 1)
            if order > 1:
                c_at, c_seen = self._find(order - 1, context[miss])
                lower = lower + np.where(c_seen[:, None], self.backoff[order - 2][c_at], np.float32(0))
            out[miss] = lower
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy per symbol for each text and language, symbols)."""
        total = np.zeros((len(texts), len(self.languages)))
        count = np.zeros(len(texts), np.int64)
        lead = np.full(ORDER - 1, 32, np.uint32)
        pending, owners, size = [], [], 0

        def flush():
            if pending:
                points = np.concatenate(pending)
                owner = np.concatenate(owners)
                where = np.flatnonzero(owner >= 0)
                for a in range(0, len(where), _WINDOW):
                    w = where[a:a + _WINDOW]
                    scores = self._scores(points, w, ORDER)
                    first = np.flatnonzero(np.diff(owner[w], prepend=-2))
                    total[owner[w][first]] -= np.add.reduceat(scores, first, axis=0, dtype=np.float64)
                pending.clear()
                owners.clear()

        for i, text in enumerate(texts):
            points = symbols(text)[1:] if text else np.zeros(0, np.uint32)
            count[i] = len(points)
            pending += [lead, points]
            owners += [np.full(len(lead), -1), np.full(len(points), i)]
            size += len(points)
            if size >= _WINDOW:
                flush()
                size = 0
        flush()
        return total / np.maximum(count, 1)[:, None], count

    def allowed(self, best: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The highest entropy that passes. Languages without calibration documents
        of their own borrow the highest usual entropy and the widest limit."""
        if not np.isfinite(self.usual).any():
            return np.full(len(best), np.inf)
        own = np.isfinite(self.usual[best])
        usual = np.where(own, self.usual[best], np.nanmax(self.usual))
        return usual + np.where(own, self.limits[octave(length)], self.limits[0])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score from 0 to 1, rejected) of each text."""
        texts = [t or "" for t in texts]
        entropy, n = self.entropies(texts)
        best = entropy.argmin(1)
        lowest = entropy[np.arange(len(best)), best]
        weight = np.minimum(n, 40)[:, None]
        odds = np.exp((lowest[:, None] - entropy) * weight)
        score = 1.0 / odds.sum(1)
        # limits fall with the length: only texts beyond the limit of their full length need the effective one
        out = lowest > self.allowed(best, n)
        far = np.flatnonzero(out)
        out[far] = lowest[far] > self.allowed(best[far], np.array([effective_length(texts[i]) for i in far], np.int64))
        # a text without a letter is a single space or nothing
        bare = n <= 1
        names = [UNKNOWN if b else self.languages[k] for b, k in zip(bare, best)]
        return names, np.where(bare, 0.0, score), bare | out


def octave(length: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(length, 1)).astype(int), OCTAVES - 1)


def effective_length(text: str) -> int:
    """Different n-grams of a text."""
    return len(np.unique(gram_hashes(symbols(text), ORDER)))


def _learning_rows(df: DataFrame, text: str, lang: str, key: Column, max_docs: int) -> tuple[DataFrame, list[str]]:
    """(lang, text, calibrate) of some ``max_docs`` rows of each language, and the languages.

    Rows are taken by a hash of key and text below a threshold that follows from
    the language's number of rows (one count, nothing is sorted); equal rows are
    one document.
    """
    keyed = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(key, F.col(text)).alias("h"))
    sizes = written(keyed.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")))
    count = sizes.count()
    docs = max(1, min(max_docs, MAX_CELLS // (GRAMS_A_DOC * max(count, 1) ** 2)))
    # the lowest 53 bits of the hash, a fraction of one
    place = F.shiftrightunsigned("h", 11) / float(1 << 53)
    part = sizes.select(F.col("lang").alias("l"), (F.lit(float(docs)) / F.col("rows")).alias("part"), "rows")
    taken = keyed.join(part, (F.col("lang") == F.col("l")) & (place < F.col("part")))
    rows = taken.groupBy("lang", "h").agg(F.any_value("text").alias("text"), F.any_value("rows").alias("rows"))
    aside = (F.least("rows", F.lit(docs)) >= MIN_ROWS) & (F.pmod("h", F.lit(CALIBRATION)) == 0)
    return written(rows.select("lang", "text", aside.alias("calibrate"))), [r["lang"] for r in sizes.orderBy("lang").collect()]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, hash, context hash, suffix hash, n) of the n-grams of whole texts."""
    lead = np.full(ORDER - 1, 32, np.uint32)
    for batch in batches:
        langs = batch.column(0).to_pylist()
        texts = batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            parts = []
            for l, t in zip(langs, texts):
                if l == lang:
                    parts.append(np.concatenate([lead, symbols(t)[1:]]))
            points = np.concatenate(parts)
            text = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            for order in range(1, ORDER + 1):
                # n-grams that do not reach from one text into the next
                inside = text[order - 1:] == text[:len(text) - order + 1]
                grams = gram_hashes(points, order)[inside]
                different, first, n = np.unique(grams, return_index=True, return_counts=True)
                context = suffix = np.zeros(len(different), np.uint64)
                if order > 1:
                    shorter = gram_hashes(points, order - 1)
                    at = np.flatnonzero(inside)[first]
                    context, suffix = shorter[at], shorter[at + 1]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(different), pa.string()),
                    pa.array(np.full(len(different), order, np.int32)),
                    pa.array(different.view(np.int64)), pa.array(context.view(np.int64)),
                    pa.array(suffix.view(np.int64)), pa.array(n.astype(np.int64))],
                    names=["lang", "gram", "hash", "context", "suffix", "n"])
        give_back()


def _by_language(value: Column, size: int, body) -> Column:
    """An array with ``body(entry, index)`` for each language, from a map by index."""
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: body(F.try_element_at(value, i), i))


def kneser_ney(counts: DataFrame, languages: list[str]) -> tuple[list[DataFrame], np.ndarray]:
    """Per order a table (hash, logp, backoff), with a number for each language,
    and the log-probability of a symbol never seen.

    ``counts`` has lang, gram (its order), hash, context, suffix and n. The highest
    order goes by counts, lower ones by how many different symbols stand before
    the n-gram. ``backoff`` weighs the shorter n-gram behind this one as context.
    """
    size = len(languages)
    codes = counts.sparkSession.createDataFrame(list(enumerate(languages)), "l int, name string")
    coded = counts.join(codes, F.col("lang") == F.col("name"))
    raw = []
    for k in range(1, ORDER + 1):
        own = coded.where(F.col("gram") == k)
        if k < ORDER:
            before = coded.where(F.col("gram") == k + 1).groupBy(F.col("l").alias("bl"), F.col("suffix").alias("bh")).agg(
                F.count(F.lit(1)).alias("before"))
            own = own.join(before, (F.col("l") == F.col("bl")) & (F.col("hash") == F.col("bh")), "left").select(
                "l", "hash", "context", "suffix", F.coalesce("before", F.lit(0)).cast("double").alias("raw"))
        else:
            own = own.select("l", "hash", "context", "suffix", F.col("n").cast("double").alias("raw"))
        raw.append(written(own))
    discounts = []
    for own in raw:
        seen = own.groupBy("l").agg(F.count_if(F.col("raw") == 1).alias("one"), F.count_if(F.col("raw") == 2).alias("two"))
        d = np.full(size, 0.5)
        for r in seen.collect():
            if r["one"] + r["two"]:
                d[r["l"]] = np.clip(r["one"] / (r["one"] + 2 * r["two"]), 0.1, 0.9)
        discounts.append(F.array(*[F.lit(float(x)) for x in d]))

    def contexts(k: int) -> DataFrame:
        """(c, m): for each context of order ``k`` n-grams, languages to (total, weight of shorter ones)."""
        sums = raw[k - 1].groupBy("context", "l").agg(F.sum("raw").alias("total"), F.count_if(F.col("raw") > 0).alias("kinds"))
        weight = F.element_at(discounts[k - 1], F.col("l") + 1) * F.col("kinds") / F.col("total")
        return sums.where("total > 0").groupBy(F.col("context").alias("c")).agg(F.map_from_entries(F.collect_list(
            F.struct("l", F.struct("total", weight.alias("weight"))))).alias("m"))

    alphabet = raw[0].select("hash").distinct().count()
    unseen = 1.0 / (alphabet + 1)
    # n-grams that nothing is known of: the weight of the root times an even share
    root = contexts(1).first()
    floor = np.array([np.log((root["m"][i]["weight"] if root and i in root["m"] else 1.0) * unseen) for i in range(size)])
    tables, low = [], None
    for k in range(1, ORDER + 1):
        grams = raw[k - 1].groupBy("hash").agg(
            F.min("context").alias("context"), F.min("suffix").alias("suffix"),
            F.map_from_entries(F.collect_list(F.struct("l", "raw"))).alias("counts"))
        rows = grams.join(contexts(k), F.col("context") == F.col("c"), "left")
        if low is None:
            rows = rows.withColumn("low", F.array_repeat(F.lit(unseen), size))
        else:
            rows = rows.join(low.select(F.col("hash").alias("s"), F.col("p").alias("low")), F.col("suffix") == F.col("s"))

        def probability(entry: Column, i: Column) -> Column:
            shorter = F.element_at("low", i + 1)
            count = F.coalesce(F.try_element_at(F.col("counts"), i), F.lit(0.0))
            own = F.greatest(count - F.element_at(discounts[k - 1], i + 1), F.lit(0.0)) / entry["total"]
            return F.when(entry.isNull(), shorter).otherwise(own + entry["weight"] * shorter)

        low = written(rows.select("hash", _by_language(F.col("m"), size, probability).alias("p")))
        table = low.select("hash", F.transform("p", lambda x: F.log(x)).cast("array<float>").alias("logp"))
        if k < ORDER:
            behind = contexts(k + 1)
            weight = _by_language(F.col("m"), size, lambda e, i: F.log(F.coalesce(e["weight"], F.lit(1.0))))
            table = table.join(behind, F.col("hash") == F.col("c"), "left").select(
                "hash", "logp", weight.cast("array<float>").alias("backoff"))
        else:
            table = table.withColumn("backoff", F.array_repeat(F.lit(0.0).cast("float"), size))
        tables.append(table)
    return tables, floor.astype(np.float32)


def _arrays(table: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The finished arrays of one order, sorted by hash."""
    rows = table.toArrow().combine_chunks()
    hashes = rows["hash"].combine_chunks().to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    dense = [rows[c].combine_chunks().flatten().to_numpy().reshape(-1, size)[order] for c in ("logp", "backoff")]
    return hashes[order], *dense


def fit(df: DataFrame, key: Column, text: str = "text", lang: str = "lang",
        max_docs: int = MAX_DOCS) -> Model | None:
    """A model of all languages in ``lang``; None where no row has one with a text.

    ``key`` and the text order the rows of the learning sample, which is bounded
    for each language (``max_docs``); its texts are read whole. What reaches the
    driver are the finished arrays, some MAX_CELLS numbers at most, and one
    distance for each calibration document. Every language with a text is learned.
    """
    rows, languages = _learning_rows(df, text, lang, key, max_docs)
    if not languages:
        return None
    counted = rows.where(~F.col("calibrate")).select("lang", "text").mapInArrow(
        _count, "lang string, gram int, hash long, context long, suffix long, n long")
    counts = written(counted.groupBy("lang", "gram", "hash").agg(
        F.sum("n").alias("n"), F.min("context").alias("context"), F.min("suffix").alias("suffix")))
    tables, floor = kneser_ney(counts, languages)
    grams, logp, backoff = zip(*[_arrays(t, len(languages)) for t in tables])
    model = Model(languages, list(grams), list(logp), list(backoff), floor, np.full(len(languages), np.nan))
    shown = rows.where(F.col("calibrate")).select("text").mapInArrow(
        lambda batches: _calibrate(batches, model), "best int, length long, entropy double").toArrow()
    _set_limits(model, *[shown[c].to_numpy() for c in ("best", "length", "entropy")])
    return model


def _set_limits(model: Model, best: np.ndarray, length: np.ndarray, entropy: np.ndarray) -> None:
    """Usual entropies and limits from calibration documents (language that fits
    best, effective length, entropy in it)."""
    for i in range(len(model.languages)):
        own = entropy[(best == i) & (length > 1)]
        if len(own) >= 5:
            model.usual[i] = np.median(own)
    away = entropy - model.usual[best]
    known = np.isfinite(away) & (length > 1)
    away, place = away[known], octave(length[known])
    if not len(away):
        return
    limits = np.zeros(OCTAVES)
    for k in range(OCTAVES):
        # an octave with few documents takes those of shorter ones along, then those of longer ones
        low, high = k, k
        while ((place >= low) & (place <= high)).sum() < min(MIN_SHOWN, len(away)):
            low, high = (low - 1, high) if low > 0 else (low, high + 1)
        shown = away[(place >= low) & (place <= high)]
        # beyond the largest of a few documents an exponential tail goes on
        tail = max(1.0, np.log(1 / (1 - QUANTILE)) / np.log(len(shown) + 1))
        limits[k] = REACH * max(np.quantile(shown, QUANTILE, method="higher"), 1e-3) * tail
    # longer texts vary less
    model.limits = np.maximum.accumulate(limits[::-1])[::-1]


def _calibrate(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(0).to_pylist()
        entropy, _ = model.entropies(texts)
        best = entropy.argmin(1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.astype(np.int32)), pa.array([effective_length(t) for t in texts], pa.int64()),
             pa.array(entropy[np.arange(len(best)), best])], names=["best", "length", "entropy"])


def identify(df: DataFrame, model: Model | None, text: str = "text") -> Column:
    """Column struct(lang_pred, score, rejected) for each whole text.

    ``und`` with score 0, rejected, for a null text, an empty one, one without a
    letter, or without a model. Only the text column goes to Python.
    """
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double, rejected: boolean>")
    def predict(texts: pa.Array) -> pa.Array:
        names, scores, rejected = [], [], []
        for a in range(0, len(texts), 128):
            n, s, r = shared.value.predict(texts.slice(a, 128).to_pylist())
            names += n
            scores.append(s)
            rejected.append(r)
        give_back()
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()),
             pa.array(np.concatenate(scores) if scores else np.zeros(0)),
             pa.array(np.concatenate(rejected) if rejected else np.zeros(0, bool))],
            names=["lang_pred", "score", "rejected"])

    return predict(F.col(text))


def learning_part(df: DataFrame, id_col: str = "doc_id", folds: int = 5, held: int = 0) -> DataFrame:
    """Rows whose crc32(id as text) mod ``folds`` is not ``held``."""
    return df.where(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds)) != held)

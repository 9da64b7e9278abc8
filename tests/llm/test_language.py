"""Language identification against a plain Kneser-Ney model, held-out texts and foreign texts."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.llm import langid

BIG = "/root/testdata/sf0.01"


class Plain:
    """Interpolated Kneser-Ney from dictionaries, one language at a time."""

    def __init__(self, texts, alphabet):
        self.floor = 1 / (alphabet + 1)
        self.raw = []
        seen = [Counter() for _ in range(langid.ORDER + 1)]
        for t in texts:
            points = " " * (langid.ORDER - 1) + "".join(map(chr, langid.symbols(t)[1:]))
            for k in range(1, langid.ORDER + 1):
                seen[k].update(points[i:i + k] for i in range(len(points) - k + 1))
        for k in range(1, langid.ORDER + 1):
            raw = {g: n for g, n in seen[k].items()}
            if k < langid.ORDER:
                raw = dict.fromkeys(seen[k], 0)
                for g in seen[k + 1]:
                    raw[g[1:]] += 1
            self.raw.append(raw)
        self.sums = []
        for raw in self.raw:
            one, two = sum(n == 1 for n in raw.values()), sum(n == 2 for n in raw.values())
            d = min(max(one / (one + 2 * two), 0.1), 0.9) if one + two else 0.5
            total, kinds = Counter(), Counter()
            for g, n in raw.items():
                total[g[:-1]] += n
                kinds[g[:-1]] += n > 0
            self.sums.append((d, total, kinds))

    def p(self, gram):
        if not gram:
            return self.floor
        d, total, kinds = self.sums[len(gram) - 1]
        shorter = self.p(gram[1:]) if len(gram) > 1 else self.floor
        t = total[gram[:-1]]
        return max(self.raw[len(gram) - 1].get(gram, 0) - d, 0) / t + d * kinds[gram[:-1]] / t * shorter if t else shorter


def _rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_scores_are_those_of_a_plain_model(spark, docs):
    texts = {"x": ["abracadabra cad", "a bad crab", "Rad bar"], "y": ["some other words, and words", "wörter and cab"], "z": ["solo"]}
    df = _rows(spark, [(100 * i + k, t, l) for i, (l, ts) in enumerate(texts.items()) for k, t in enumerate(ts)])
    model = langid.fit(df, F.col("doc_id"))
    assert model.languages == ["x", "y", "z"]
    alphabet = {c for ts in texts.values() for t in ts for c in map(chr, langid.symbols(t))}
    plain = [Plain(ts, len(alphabet)) for ts in texts.values()]
    for context in ("abr", "zzz", " ra", "cad", "  s", "ds ", "   ", "sol"):
        for c in [*sorted(alphabet), "q"]:
            points = np.array([ord(x) for x in context + c], np.uint32)
            got = np.exp(model._scores(points, np.array([3]), langid.ORDER)[0])
            want = [p.p(context + c) for p in plain]
            assert np.allclose(got, want, rtol=2e-4), (context, c)
    # probabilities of all symbols, and one for what was never seen, sum to one
    for context in ("abr", "zzz", "wor"):
        points = np.array([[ord(x) for x in context + c] for c in [*sorted(alphabet), "q"]], np.uint32).ravel()
        assert np.allclose(np.exp(model._scores(points, np.arange(3, len(points), 4), langid.ORDER)).sum(0), 1, atol=1e-3)
    entropy, n = model.entropies(["abra cab"])
    points = "   " + "".join(map(chr, langid.symbols("abra cab")[1:]))
    want = -sum(math.log(plain[0].p(points[i - 3:i + 1])) for i in range(3, len(points))) / n[0]
    assert abs(entropy[0, 0] - want) < 1e-3


def test_every_language_is_learned_from_whole_texts(spark, docs):
    rows = [(k, f"the words of text {k} are plain and english and so on", "en") for k in range(200)]
    rows += [(500, "ein einziger satz auf deutsch genügt hier schon", "de"), (501, None, "fr"), (502, "sin lengua", None)]
    # a language that shows only behind 20,000 characters of another one
    rows += [(600 + k, "the words of text are plain " * 800 + "zażółć gęślą jaźń " * 30, "pl") for k in range(3)]
    model = langid.fit(_rows(spark, rows), F.col("doc_id"))
    assert model.languages == ["de", "en", "pl"]
    names, _, _ = model.predict(["ein satz auf deutsch", "english and so on", "gęślą jaźń"])
    assert names == ["de", "en", "pl"]
    # equal rows are one document, and the sample is bounded for each language
    learned, languages = langid._learning_rows(_rows(spark, rows * 3), "text", "lang", F.col("doc_id"), 50)
    sizes = Counter(r["lang"] for r in learned.collect())
    assert languages == ["de", "en", "pl"] and sizes["de"] == 1 and sizes["pl"] == 3 and sizes["en"] < 100
    many = _rows(spark, [(k, f"text {k % 5} words", f"l{k % 400:03}") for k in range(2000)])
    learned, languages = langid._learning_rows(many, "text", "lang", F.col("doc_id"), 1500)
    assert len(languages) == 400 and learned.count() < 2000


@pytest.fixture(scope="module")
def models(spark, docs):
    big = docs.sparkSession.read.parquet(f"{BIG}/documents.parquet")
    learn = langid.learning_part(big)
    return {None: langid.fit(learn, F.col("doc_id")),
            **{l: langid.fit(learn.where(F.col("lang") != l), F.col("doc_id")) for l in ("de", "es")}}


def test_held_out_documents(docs, rows, models):
    got = {r["doc_id"]: r["p"] for r in docs.select("doc_id", langid.identify(docs, models[None]).alias("p")).collect()}
    held = [(i, lang) for i, t, _, lang in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum(got[i]["lang_pred"] == lang for i, lang in held)
    assert len(held) > 20 and right >= 0.97 * len(held)
    assert sum(p["rejected"] for p in got.values()) <= 0.02 * len(got)
    few = langid.fit(langid.learning_part(docs), F.col("doc_id"))
    small = docs.select("doc_id", langid.identify(docs, few).alias("p")).collect()
    by = {r["doc_id"]: r["p"] for r in small}
    assert sum(by[i]["lang_pred"] == lang for i, lang in held) >= 0.9 * len(held)
    assert sum(p["rejected"] for p in by.values()) <= 0.05 * len(by)


@pytest.mark.parametrize("foreign", ["de", "es"])
def test_foreign_and_half_foreign_texts_are_rejected(docs, models, foreign):
    """Long texts of a language left out, and texts of which half is in it."""
    by = defaultdict(list)
    for r in docs.sparkSession.read.parquet(f"{BIG}/documents.parquet").select("text", "lang").collect():
        # ordinary prose: several lines of different words
        if r["text"] and 800 < len(r["text"]) < 6000 and langid.effective_length(r["text"]) > 500:
            by[r["lang"]].append(r["text"])
    model = models[foreign]
    alien = by[foreign][:80]
    own = [t for l in by for t in by[l][:40] if l != foreign]
    half = [a[:len(a) // 2] + " " + b[:len(a) // 2] for a, b in zip(alien, own)]
    assert len(alien) >= 40 and len(half) >= 40
    assert model.predict(alien)[2].mean() >= 0.97
    assert model.predict(half)[2].mean() >= 0.9
    assert model.predict(own)[2].mean() <= 0.02


def test_odd_texts(odd, odd_rows, none, models):
    strange = odd.select("doc_id", langid.identify(odd, models[None]).alias("p")).collect()
    by = {r["doc_id"]: r["p"] for r in strange}
    assert len(strange) == len(odd_rows)
    assert all(by[i]["lang_pred"] == "und" and by[i]["rejected"] and by[i]["score"] == 0 for i in (1, 2, 3, 10, 12))
    assert none.select(langid.identify(none, models[None])).count() == 0
    alien = odd.sparkSession.createDataFrame([(1, "Это предложение написано по-русски и ничего больше")], "doc_id long, text string")
    assert alien.select(langid.identify(alien, models[None]).alias("p")).first()["p"]["rejected"]
    assert langid.fit(none, F.col("doc_id")) is None
    assert odd.select(langid.identify(odd, None).alias("p")).first()["p"]["lang_pred"] == "und"
    # a text that repeats itself is held against short texts
    names, _, out = models[None].predict([(t := "the house and that") + f" {t}" * 200])
    assert names == ["en"] and not out[0]

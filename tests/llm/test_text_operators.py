import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowlens.llm import chunks, lines, minhash, pack, rules
from flowlens.llm.queries import tokenizer_path
from flowlens.llm.textbytes import SpanHasher, column_bytes

from . import brute


def test_line_rules_match_brute_force(docs, rows):
    got = lines.line_verdicts(docs, min_docs=1, max_share=0.05, min_left=0.9).collect()
    want = brute.line_rules([r[:3] for r in rows], 0.05, 1, 0.9)
    text = {i: t for i, t, *_ in rows}
    assert len(got) == len(rows)
    assert any(not r["kept"] and not r["base_failed"] for r in got)
    for r in got:
        assert tuple(r[1:6]) == brute.base_rules(text[r["doc_id"]])
        assert (r["base_failed"], r["kept"], r["n_left"]) == want[r["doc_id"]]


def test_line_rules_on_odd_rows(odd, odd_rows, none):
    got = lines.line_verdicts(odd).collect()
    assert len(got) == len(odd_rows)
    want = defaultdict(set)
    for i, t, *_ in odd_rows:
        want[i].add(brute.base_rules(t))
    assert all(tuple(r[1:6]) in want[r["doc_id"]] for r in got)
    assert {r["doc_id"] for r in got if r["n_words"] == 0 and r["base_failed"]} == {1, 2, 3}
    assert lines.line_verdicts(none).count() == 0


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates_match_brute_force(docs, rows, words):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in minhash.near_duplicates(docs, words=words).collect()}
    assert got == brute.near([r[:2] for r in rows], words, 80)


def test_large_neighbourhood_in_blocks(docs, monkeypatch):
    """300 near copies of one text, compared in many small blocks."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(160)]
    texts = []
    for i in range(300):
        w = list(base)
        for p in rng.choice(160, 3, replace=False):
            w[p] = f"n{i}x{p}"
        texts.append((i, " ".join(w)))
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 40)
    df = docs.sparkSession.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df, words=4).collect()}
    assert got == brute.near(texts, 4, 80)


def test_near_duplicates_on_odd_rows(odd, odd_rows, none):
    got = minhash.near_duplicates(odd, words=4).collect()
    assert len(got) == len(odd_rows)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["n_shingles"] for i in (1, 2, 3)] == [0, 0, 0]
    assert all(by[i]["component_id"] == i for i in (1, 2, 3, 10))
    assert by[5]["component_id"] == 4 and by[9]["component_id"] == 8 and by[7]["component_id"] == 6
    assert minhash.near_duplicates(none).count() == 0


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 102), (205, 201), (7, 7)]
    got = dict(map(tuple, minhash.connected(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100, 205: 201, 201: 201}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab \n\t' é1.!<|>"), max_size=40), min_size=1, max_size=6))
def test_encoder_equals_tokenizer(texts):
    encoder = pack._encoder(tokenizer_path())
    ids, at = encoder.encode(*column_bytes(pa.array(texts)))
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want


def _check_packing(got, texts, length):
    tokenizer = pack._encoder(tokenizer_path()).tokenizer
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in texts}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        assert zlib.crc32(struct.pack(f"<{r['length']}I", *ids[r["doc_id"]][r["start"]:r["start"] + r["length"]])) \
            == r["ids_crc32"]
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, own in ids.items():
        p = sorted(pieces[i])
        assert [x[0] for x in p] == list(range(-(-len(own) // length)))
        assert p[0][1] == 0 and sum(x[2] for x in p) == len(own)
        assert all(x[2] == length for x in p[1:])
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= length
    return len(sequences), -(-sum(map(len, ids.values())) // length)


def test_packing_covers_all_and_is_dense(docs, rows):
    used, least = _check_packing(pack.pack_documents(docs, tokenizer_path()).collect(), [r[:2] for r in rows], 1024)
    assert used <= least * 1.05 + 2


def test_packing_odd_rows_in_blocks(odd, odd_rows, none):
    texts = [(i, t) for i, t, *_ in odd_rows if i not in (None, 12)]
    got = pack.pack_documents(odd.where("doc_id <> 12"), tokenizer_path(), block=50).collect()
    _check_packing(got, texts, 1024)
    assert pack.pack_documents(odd, tokenizer_path()).count() > len(odd_rows)
    assert pack.pack_documents(none, tokenizer_path()).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 16), min_size=1, max_size=40))
def test_sum_of_squares_rule(lengths):
    """Every piece goes to the open sequence with room where the sum of squares
    becomes smallest, by trying all; to a new one where none has room."""
    seq, offset = pack.sum_of_squares(np.array(lengths), 16)
    free = {}
    for n, s, at in zip(lengths, seq.tolist(), offset.tolist()):
        def after(b):
            counts = defaultdict(int)
            for k, v in free.items():
                counts[v - n if k == b else v] += 1
            return sum(v * v for k, v in counts.items() if k)
        room = [b for b, v in free.items() if v >= n]
        assert at == 16 - free.get(s, 16)
        if room:
            assert s in room and after(s) == min(after(b) for b in room)
        else:
            assert s not in free
        free[s] = free.get(s, 16) - n


def test_gear_hash_is_the_rolling_hash():
    data = np.frombuffer(bytes(range(200)) * 2, np.uint8)
    h, rolled = chunks.gear(data), 0
    for i, b in enumerate(data):
        rolled = (rolled << 1) + int(chunks.BYTE_VALUES[b])
        assert rolled & 0xFFFF == h[i]


@settings(max_examples=50, deadline=None)
@given(st.binary(max_size=3000), st.binary(max_size=50))
def test_chunks_cover_and_resist_insertions(body, head):
    def spans(raw):
        data = np.frombuffer(raw, np.uint8)
        cuts = chunks.chunk_starts(data)
        ends = np.append(cuts[1:], len(data))[:len(cuts)]
        assert not len(cuts) or (ends - cuts).max() <= chunks.MAX_CHUNK
        return [raw[a:b] for a, b in zip(cuts, ends)]
    one, two = spans(body), spans(head + body)
    assert b"".join(one) == body and b"".join(two) == head + body


def test_span_hashes_do_not_depend_on_place(monkeypatch):
    h = SpanHasher()
    raw = np.frombuffer(b"abc def abc" * 50, np.uint8)
    starts = np.arange(0, 550, 11)
    a, b = h(raw, starts, starts + 3), h(raw, starts + 8, starts + 11)
    assert len(set(a.tolist()) | set(b.tolist())) == 1


def test_repeated_passages(spark, docs, rows):
    rng = np.random.default_rng(3)
    words = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n))
    passage, line = words(55), words(8)
    texts = [(i, f"{words(60)} {passage} {words(40)}" if i < 4 else f"{words(150)} {line}") for i in range(40)]
    texts += [(50, None), (51, ""), (52, passage), (53, passage + " " + passage)]
    got = chunks.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string"))
    found = got.collect()
    assert {r["doc_id"] for r in found} == {0, 1, 2, 3, 52, 53}
    for r in found:
        span = dict(texts)[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert span[4:-4] in passage + " " + passage
        assert r["kept"] == (r["first_doc_id"] == r["doc_id"])
    assert all(r["kept"] for r in found if r["doc_id"] == 0)
    assert all(any(not r["kept"] for r in found if r["doc_id"] == i) for i in (2, 3, 52, 53))
    cut = dict(map(tuple, chunks.cut_passages(spark.createDataFrame(texts, "doc_id long, text string"), got).collect()))
    assert cut[10] == dict(texts)[10] and cut[0] == dict(texts)[0] and len(cut[2]) < len(dict(texts)[2]) - 100


def test_planted_passages_of_the_table(docs, rows):
    seen = defaultdict(set)
    for i, t, *_ in rows:
        w = brute.WORD.findall(t or "")
        for k in range(len(w) - 50):
            seen[tuple(w[k:k + 51])].add(i)
    planted = {i for s in seen.values() if len(s) > 1 for i in s}
    found = {r["doc_id"] for r in chunks.repeated_passages(docs).collect()}
    assert planted and planted <= found


@pytest.mark.parametrize("letters", [3, 4, 5])
def test_planted_passages_of_short_words(spark, docs, letters):
    """51 words between random words, in two documents each: caught, and nothing else is."""
    rng = random.Random(letters)
    abc = "abcdefghijklmnopqrstuvwxyz"

    def words(n):
        return [rng.choice(abc) + "".join(rng.choices(abc, k=letters - 1)) for _ in range(n)]

    rows, n = [], 150
    for k in range(n):
        passage = words(51)
        rows += [(2 * k + side, " ".join(words(rng.randint(40, 90)) + passage + words(rng.randint(40, 90)))) for side in (0, 1)]
    # two common lines in a row, 40 words that repeat, and clean texts
    line = [" ".join(words(12)) for _ in range(2)]
    rows += [(10_000 + k, " ".join(words(50)) + "\n" + line[0] + "\n" + line[1] + "\n" + " ".join(words(50))) for k in range(20)]
    for k in range(20):
        short = words(40)
        rows += [(20_000 + 2 * k + side, " ".join(words(60) + short + words(60))) for side in (0, 1)]
    rows += [(30_000 + k, " ".join(words(150))) for k in range(100)]
    got = chunks.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r["doc_id"] for r in got}
    both = sum({2 * k, 2 * k + 1} <= found for k in range(n))
    assert both >= 0.98 * n, both
    assert not [d for d in found if d >= 10_000]


def test_passages_of_rows_without_an_id(spark, docs):
    rng = random.Random(1)
    passage = " ".join(f"word{rng.randint(0, 9999)}" for _ in range(60))
    rows = [(None, f"{k} unlike others {passage} and {k * k} ends") for k in range(3)] + [(1, f"one more {passage}"), (2, "nothing here")]
    got = chunks.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got} == {1, None}
    assert [r["kept"] for r in got if r["first_doc_id"] == 1] == [r["doc_id"] == 1 for r in got if r["first_doc_id"] == 1]
    assert sum(r["first_doc_id"] == 1 and r["doc_id"] is None for r in got) == 3


def test_passages_on_odd_rows(odd, none):
    got = chunks.repeated_passages(odd)
    assert {6, 7, 8, 9} <= {r["doc_id"] for r in got.collect()}
    assert chunks.cut_passages(odd, got).columns == odd.columns
    assert chunks.cut_passages(odd, got).count() == odd.count()
    assert chunks.repeated_passages(none).count() == 0


def test_quality_rules(spark, docs, odd, odd_rows, none):
    from pyspark.sql import functions as F

    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    stats = rules.measured(big)
    model = rules.fit(stats, labels.where(~held))
    assert 0 < len(model.rules) < 200 and all(w for w, _ in model.rules)
    got = rules.scored(stats, model).join(labels.where(held), "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in got) >= 0.95 * len(got)
    strange = rules.scored(rules.measured(odd), model).collect()
    assert len(strange) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in strange)
    assert rules.scored(rules.measured(none), model).count() == 0
    assert rules.fit(stats, labels.where("1 = 0")).rules == []
    only = rules.fit(stats, labels.where("quality = 1"))
    assert rules.scored(rules.measured(odd), only).first()["score"] > 0.99

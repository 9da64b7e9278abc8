"""Piece encoding, token alignment and spelling variants against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from flowlens.llm import crossalign, pieces, queries, spelling

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return queries.tokenizer_path("piece_bpe_32k.model")


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- pieces -------------------------------------------------------------------

def _field(number, body):
    size, out = len(body), b""
    while True:
        out += bytes([size & 127 | (128 if size > 127 else 0)])
        size >>= 7
        if not size:
            return bytes([number << 3 | 2]) + out + body


def _with_rules(path, rule, dummy, squeeze, escape):
    """The model with a compiled character map of the library and other white-space rules."""
    import sentencepiece

    with open(path, "rb") as f:
        raw = f.read()
    if rule is None:
        return raw
    own = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    blob = dict(pieces.message_fields(dict(pieces.message_fields(own))[3]))[2]
    return raw + _field(3, _field(2, blob) + bytes([0x18, dummy, 0x20, squeeze, 0x28, escape]))


@pytest.mark.parametrize("rules", [(None, 1, 0, 1), ("nmt_nfkc", 1, 1, 1), ("nfkc_cf", 1, 0, 1),
                                   ("nmt_nfkc", 0, 1, 1), ("nfkc", 1, 1, 0)])
def test_ids_and_spans_are_those_of_the_library(model, rules):
    import sentencepiece

    raw = _with_rules(model, *rules)
    encoder, library = pieces.PieceEncoder.from_bytes(raw), sentencepiece.SentencePieceProcessor(model_proto=raw)
    rng = random.Random(5)
    parts = [*"ab cdé ß漢🙂 ꙮ▁  ﬁｱﾞ①\n\t​ \x00̀　Å가", "</s>", "<s>", "<unk>", "hello ", " the", "<0x41>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(1500)] + ["", " ", "  ", "▁", "▁▁ "]
    encoded = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in encoded])])
    ids, begins, ends, at = encoder.encode(np.frombuffer(b"".join(encoded), np.uint8), offsets)
    for i, text in enumerate(texts):
        place = np.concatenate([[0], np.cumsum([len(c.encode()) for c in text])]).tolist()
        own = slice(at[i], at[i + 1])
        want = library.encode_as_offset_mapping(text) if text else {"ids": [], "offsets": []}
        assert ids[own].tolist() == want["ids"], text
        assert list(zip(begins[own].tolist(), ends[own].tolist())) == [(place[a], place[b]) for a, b in want["offsets"]], text


def test_bytes_that_are_no_text(model):
    import sentencepiece

    encoder, library = pieces.PieceEncoder(model), sentencepiece.SentencePieceProcessor(model_file=model)
    rng = random.Random(2)
    raw = [bytes(rng.choices([0x61, 0x20, 0xC0, 0xC3, 0xA9, 0xE2, 0x96, 0x81, 0xED, 0xF0, 0x9F, 0x98, 0x80, 0xFF], k=9)) for _ in range(600)]
    offsets = np.arange(len(raw) + 1) * 9
    ids, _, _, at = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for i, b in enumerate(raw):
        assert ids[at[i]:at[i + 1]].tolist() == library.encode(b), b


def test_encoding_query(docs, rows, model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model)
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op12_piece_encoding"](docs.sparkSession, SF).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_eos=True)
        assert got[i] == (len(ids), _sha(" ".join(map(str, ids))), _sha(library.decode(ids)))


def test_encoding_of_odd_rows(odd, odd_rows, none, model):
    encoded = pieces.encode_documents(odd, model).collect()
    assert sorted(str(r["doc_id"]) for r in encoded) == sorted(str(i) for i, *_ in odd_rows)
    by_text = defaultdict(list)
    for i, text, *_ in odd_rows:
        by_text[i].append(text or "")
    for r in encoded:
        text = by_text[r["doc_id"]][0]
        assert r["decoded"] == text and r["ids"][-1] == 2 and r["ends"][-1] == len(text.encode()) == r["begins"][-1]
        assert all(a <= b for a, b in zip(r["begins"], r["ends"]))
    assert pieces.encode_documents(none, model).count() == 0
    assert pieces.encoding_digests(pieces.encode_documents(none, model)).count() == 0


# --- alignment ----------------------------------------------------------------

def _brute_alignment(rows, byte_level, model):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(byte_level)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=model)
    # the byte-level rule: bytes that print stay, the others follow from 256 on
    stay = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or c >= 174]
    byte = {chr(c): c for c in stay}
    byte.update({chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in stay)})
    docs, counts = [], Counter()
    for i, text, *_ in rows:
        text = text or ""
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw_a = [bytes(byte[c] for c in a.id_to_token(t)) for t in ids_a]
        raw_b = [bytes([int(p[3:5], 16)]) if b.is_byte(t) else p.replace("▁", " ").encode()
                 for t in ids_b for p in [b.id_to_piece(t)]]
        groups = []
        if text and b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            ends_a = np.cumsum([len(t) for t in raw_a]).tolist()
            ends_b = np.cumsum([len(t) for t in raw_b]).tolist()
            low = 0
            for end in sorted(set(ends_a) & set(ends_b)):
                groups.append(([t for t, e in zip(ids_a, ends_a) if low < e <= end],
                               [t for t, e in zip(ids_b, ends_b) if low < e <= end]))
                low = end
        links = Counter((x, y) for xs, ys in groups for x in xs for y in ys)
        counts.update(links.keys())
        docs.append((i, groups, links))
    top = defaultdict(int)
    for (x, _), n in counts.items():
        top[x] = max(top[x], n)
    out = []
    for i, groups, links in docs:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if counts[p] == top[p[0]]),
                    sum(n * counts[p] for p, n in links.items()), _sha(text) if groups else ""))
    return sorted(map(str, out))


_SHORT = [(1, None), (2, ""), (3, " "), (4, "a▁b"), (5, "plain words, twice: plain words"), (5, "plain words"), (None, "no id é🙂ꙮ"),
          (6, "<|endoftext|> </s> <0x41>"), (7, "tabs\t\tand\n\n  spaces   "), (8, "x" * 300), (9, "naïve 漢字 test\r\n"), (None, "no id")]


@pytest.mark.parametrize("hot", [100_000, 3])
def test_alignment_of_short_texts(spark, docs, model, hot):
    path = queries.tokenizer_path()
    df = spark.createDataFrame([(*r, "x") for r in _SHORT], "doc_id long, text string, n_a string")
    got = crossalign.score_alignments(crossalign.align_documents(df, path, model, digest=hot == 3), hot)
    assert sorted(str(tuple(r)) for r in got.collect()) == _brute_alignment(_SHORT, path, model)


def test_alignment_query(docs, rows, model):
    got = queries.QUERIES["op11_token_alignment"](docs.sparkSession, SF).collect()
    want = _brute_alignment(rows, queries.tokenizer_path(), model)
    assert sorted(str(tuple(r)) for r in got) == want


def test_alignment_of_odd_rows(odd, odd_rows, none, model):
    got = crossalign.align_documents(odd, queries.tokenizer_path(), model)
    assert got.count() == len(odd_rows)
    assert crossalign.score_alignments(crossalign.align_documents(none, queries.tokenizer_path(), model)).count() == 0


def test_windows_of_one_hash_are_noticed(model):
    aligner = crossalign.Aligner(queries.tokenizer_path(), model)
    aligner._tuple_hashes = lambda ids, starts, ends: np.zeros(len(starts), np.uint64)
    text = np.frombuffer(b"a few words extraordinarily different", np.uint8)
    with pytest.raises(RuntimeError):
        aligner.align(text, np.array([0, len(text)]))


# --- spelling -----------------------------------------------------------------

def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _brute_forms(counts):
    out = []
    near = {w: [v for v in counts if v != w and abs(len(v) - len(w)) <= 1 and _near(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(map(str, out))


def _brute_words(rows):
    out = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


@pytest.mark.parametrize("hot", [0, 6, 10_000])
def test_forms_against_all_pairs(spark, hot):
    rng = random.Random(hot)
    words = {"".join(rng.choices("abé", k=rng.randint(7, 9))) for _ in range(250)}
    words |= {"commons" + c for c in "abcdefgh"} | {c + "ommonsx" for c in "abcdefgh"} | {"aaaaaaa", "aaaaaaaa", "éééééééé", "×÷×÷×÷×"}
    counts = {w: rng.choice([2, 3, 5, 40, 700, 9000]) for w in sorted(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    pairs = [tuple(r) for r in spelling.near_pairs(df, hot).collect()]
    assert len(set(pairs)) == len(pairs)
    assert {frozenset(p) for p in pairs} == {frozenset((a, b)) for a in words for b in words if a != b and _near(a, b)}
    assert sorted(str(tuple(r)) for r in spelling.variant_forms(df).collect()) == _brute_forms(counts)


def test_long_chain_of_forms(spark):
    counts = {"a" * 7 + "b" * k: 2 * 10 ** k for k in range(18)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert sorted(str(tuple(r)) for r in spelling.variant_forms(df).collect()) == _brute_forms(counts)


def test_words_of_odd_rows(spark, odd, odd_rows, none):
    rows = odd_rows + [(20, "Aéronaute aéronaute AÉRONAUTE abc×def÷gh Straße-straßenbahn", None, None)] * 3
    df = odd.unionByName(spark.createDataFrame(
        [(i, t, s, l, 0, 7) for i, t, s, l in rows[len(odd_rows):]], odd.schema))
    got = spelling.frequent_words(spelling.word_runs(df)).collect()
    assert {r["word"]: r["n"] for r in got} == _brute_words(rows)
    assert spelling.spelling_variants(none).count() == 0

"""The queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chunks, crossalign, exact, langid, lines, minhash, mix, pack, pieces, rules, shard, spelling, wrapper
from .common import ship

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ship(spark), sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _held(folds: int, fold: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == fold


@query
def op1_language_id(spark, sf_dir):
    """Language of every document by Kneser-Ney character models."""
    docs = documents(spark, sf_dir)
    model = langid.fit(langid.learning_part(docs), F.col("doc_id"))
    return docs.select("doc_id", _held(5, 0).alias("held_out"), langid.identify(docs, model).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected")


@query
def op2_sharding(spark, sf_dir):
    """All documents in 40 shards by proportional stratified interleaving."""
    return shard.interleave_shards(documents(spark, sf_dir), 40)


@query
def op3_minhash_neardup(spark, sf_dir):
    """Near-duplicate components of all documents (four-word shingles, 0.8)."""
    return minhash.near_duplicates(documents(spark, sf_dir), words=4, percent=80)


@query
def op4_html_extraction(spark, sf_dir):
    """Main text of every page by wrappers induced for each host."""
    return wrapper.main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op5_exact_dedup(spark, sf_dir):
    """Exact duplicates of all documents by chunk recipes."""
    return exact.exact_groups(documents(spark, sf_dir))


@query
def op6_line_frequency(spark, sf_dir):
    """Base statistics and the cross-document line verdict of all documents."""
    return lines.line_verdicts(documents(spark, sf_dir))


@query
def op7_packing(spark, sf_dir):
    """All documents packed into sequences of 1024 ids by the sum-of-squares rule."""
    return pack.pack_documents(documents(spark, sf_dir), tokenizer_path())


@query
def op8_source_mixing(spark, sf_dir):
    """All documents mixed to the target weights of their sources."""
    return mix.mix_sources(documents(spark, sf_dir)).drop("source")


@query
def op9_quality(spark, sf_dir):
    """Quality score of every document by a sparse ensemble of rules."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stats = rules.written(rules.measured(docs))
    model = rules.fit(stats, labels.where(~_held(4, 2)))
    return rules.scored(stats, model).select("doc_id", _held(4, 2).alias("held_out"), "score", "predicted")


@query
def op10_substring_dedup(spark, sf_dir):
    """Passages of all documents that stand in several of them."""
    return chunks.repeated_passages(documents(spark, sf_dir))


@query
def op11_token_alignment(spark, sf_dir):
    """Byte-level and piece tokens of every document aligned at anchors, links scored by document counts."""
    return crossalign.score_alignments(crossalign.align_documents(
        documents(spark, sf_dir), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"), digest=True))


@query
def op12_piece_encoding(spark, sf_dir):
    """Every document encoded and decoded by the piece model, spans kept on the way."""
    return pieces.encoding_digests(pieces.encode_documents(
        documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model")))


@query
def op13_spelling_variants(spark, sf_dir):
    """Spelling variants among the words of all documents."""
    return spelling.spelling_variants(documents(spark, sf_dir))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op5_exact_dedup"] = f"""
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_LOWER} AS t FROM documents)
"""


_WORD = r"[^\x20\x09-\x0D]+"
_SPACE = r"[\x20\x09-\x0D]+"

ORACLES["op3_minhash_neardup"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT p.a, p.b FROM p JOIN n x ON p.a = x.doc_id JOIN n y ON p.b = y.doc_id
  WHERE 100 * p.c >= 80 * (x.n + y.n - p.c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(x, y) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a)
SELECT r.x AS doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.y) AS component_id, r.x = min(r.y) AS kept
FROM r LEFT JOIN n ON r.x = n.doc_id GROUP BY r.x
"""

ORACLES["op6_line_frequency"] = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c
  FROM (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) > 4))),
rep AS (
  SELECT doc_id, sum(step) AS n
  FROM (SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS step FROM g WHERE c > 1)
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, l, len(regexp_extract_all(l, '{_WORD}')) AS words,
    trim(regexp_replace(regexp_replace(lower(l), '[0-9]+', '0', 'g'), '{_SPACE}', ' ', 'g'), ' ') AS norm
  FROM (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '{_WORD}')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY doc_id),
freq AS (
  SELECT source, norm FROM lines JOIN (SELECT source AS s, count(*) AS host_docs FROM d GROUP BY s) h
    ON source IS NOT DISTINCT FROM h.s
  GROUP BY source, norm, host_docs
  HAVING count(DISTINCT doc_id) > {lines.MIN_DOCS} AND count(DISTINCT doc_id) > {lines.MAX_SHARE} * host_docs),
gone AS (
  SELECT doc_id, sum(words) AS n FROM lines JOIN freq
    ON lines.source IS NOT DISTINCT FROM freq.source AND lines.norm = freq.norm GROUP BY doc_id),
b AS (
  SELECT d.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '{lines.SYMBOLS}', '', 'g')) AS n_symbols,
    coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, len(ws) - coalesce(gone.n, 0) AS n_left
  FROM d LEFT JOIN dup ON d.doc_id = dup.doc_id LEFT JOIN rep ON d.doc_id = rep.doc_id
    LEFT JOIN gone ON d.doc_id = gone.doc_id),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND n_left >= {lines.MIN_LEFT} * n_words AS kept, CAST(n_left AS BIGINT) AS n_left
FROM f
"""

ORACLES["op13_spelling_variants"] = f"""
WITH RECURSIVE tab AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
runs AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS r FROM documents)
  WHERE length(r) >= {spelling.MIN_LENGTH} GROUP BY ALL),
hexed AS (SELECT r, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r)) AS x FROM runs),
bytes AS (
  SELECT r, n, list_transform(range(1, len(x) + 1, 2), lambda k:
    16 * (instr('0123456789ABCDEF', substr(x, k, 1)) - 1) + instr('0123456789ABCDEF', substr(x, k + 1, 1)) - 1) AS bs FROM hexed),
crc AS (
  SELECT r, n, xor(list_reduce(list_prepend(4294967295, bs),
    lambda c, b: xor(c >> 8, tab.tab[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM bytes, tab),
damaged AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, n FROM crc),
w AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= {spelling.MIN_LENGTH}
  GROUP BY word HAVING sum(n) >= {spelling.MIN_COUNT}),
less AS (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM w)),
pairs AS (
  SELECT a.word AS s, b.word AS t FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT word, rest FROM less WHERE rest IN (SELECT word FROM w)
  UNION SELECT rest, word FROM less WHERE rest IN (SELECT word FROM w)),
near AS (
  SELECT s, count(*) AS n_near, first(t ORDER BY w.n DESC, t) AS form, max(w.n) AS form_n
  FROM pairs JOIN w ON t = w.word GROUP BY s),
f AS (
  SELECT w.word, CASE WHEN form_n >= {spelling.RATIO} * n THEN form END AS form, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN form_n >= {spelling.RATIO} * n THEN form_n END AS form_n
  FROM w LEFT JOIN near ON w.word = s),
chain(word, stop, nxt) AS (
  SELECT word, word, form FROM f UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN f ON c.nxt = f.word)
SELECT f.word, f.form, chain.stop AS root, f.n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM f JOIN chain ON chain.word = f.word AND chain.nxt IS NULL
"""


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)

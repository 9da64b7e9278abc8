"""Substring deduplication by content-defined chunks (gear rolling hash).

A text's bytes are cut where ``CUT_BITS`` bits of the gear hash of the last 16
bytes are zero, unless the preceding such place is too near; long gaps are cut at
fixed steps. Cuts depend on nearby bytes only, so a passage gets the same chunks
wherever it stands. Chunks are grouped by digest over all documents; runs of
neighbouring chunks that also occur in other documents are candidates. A passage
also covers part of the chunks before and behind its run: every chunk carries
two-bit hashes of the ``BESIDE`` words on either side, and a run is as many words
longer as these agree with those of another document that holds its outer chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, written
from .textbytes import BYTE_VALUES, SpanHasher, column_bytes, give_back, slices, word_spans

#: A cut needs this many zero bits, MIN_CHUNK bytes from the preceding candidate, MAX_CHUNK at most.
CUT_BITS = 4
MIN_CHUNK = 8
MAX_CHUNK = 256
#: Bytes of repeated neighbouring chunks from which a run is a candidate,
MIN_RUN = 16
#: words of a passage, its ends included,
MIN_WORDS = 51
#: and bytes from which a run counts whatever its words (scripts without spaces).
LONG_RUN = 768
#: Words beside a chunk whose hashes it carries, two bits each.
BESIDE = 31
#: Bits 11 to 15 of the hash depend on the last 16 bytes.
_REACH = 16
#: Rows without an id are documents of their own: numbers from here on stand for them.
_NAMELESS = (1 << 63) - (1 << 62)

_SCHEMA = "doc long, start int, length int, digest long, words int, before long, after long"
_NARROW = "doc long, digest long"


def gear(data: np.ndarray) -> np.ndarray:
    """The lowest 16 bits of the gear hash behind each byte.

    The hash is the sum of value(byte) << distance; a byte leaves these bits
    after 16 steps, so the sum over the last 16 bytes, built by doubling, is
    the rolling hash itself.
    """
    h = (BYTE_VALUES & np.uint64(0xFFFF)).astype(np.uint16)[data]
    step = 1
    while step < _REACH:
        shifted = h[:-step] << np.uint16(step)
        h[step:] = h[step:] + shifted
        step *= 2
    return h


def chunk_starts(data: np.ndarray) -> np.ndarray:
    """Starts of the chunks of one text (the first is 0)."""
    if not len(data):
        return np.zeros(0, np.int64)
    marks = np.flatnonzero(gear(data) >> np.uint16(16 - CUT_BITS) == 0) + 1
    marks = marks[marks < len(data)]
    apart = np.diff(marks, prepend=0) >= MIN_CHUNK
    cuts = np.concatenate([[0], marks[apart]])
    gaps = np.diff(np.append(cuts, len(data)))
    pieces = -(-gaps // MAX_CHUNK)
    if pieces.max() > 1:
        which = np.repeat(np.arange(len(cuts)), pieces)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        cuts = cuts[which] + nth * MAX_CHUNK
    return cuts


def _beside(marks: np.ndarray, first: np.ndarray, step: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The hashes of the words first, first + step, .. packed, nearest lowest; words
    outside [low, high) are 0."""
    out = np.zeros(len(first), np.uint64)
    for k in range(BESIDE):
        at = first + step * k
        inside = (at >= low) & (at < high)
        out |= np.where(inside, marks[np.where(inside, at, 0)], np.uint64(0)) << np.uint64(2 * k)
    return out.view(np.int64)


def _chunk_rows(batches: Iterator[pa.RecordBatch], narrow: bool) -> Iterator[pa.RecordBatch]:
    hashes = SpanHasher()
    nameless = _NAMELESS + (TaskContext.get().partitionId() << 36)
    for batch in batches:
        ids = batch.column(0)
        missing = np.asarray(ids.is_null())
        owners = ids.fill_null(0).to_numpy(zero_copy_only=False).copy()
        owners[missing] = nameless + np.arange(missing.sum())
        nameless += int(missing.sum())
        data, offsets = column_bytes(batch.column(1))
        for lo, hi in slices(offsets):
            rows, start, length, digest = [], [], [], []
            for i in range(lo, hi):
                text = data[offsets[i]:offsets[i + 1]]
                cuts = chunk_starts(text)
                ends = np.append(cuts[1:], len(text))[:len(cuts)]
                rows.append(np.full(len(cuts), i))
                start.append(cuts)
                length.append(ends - cuts)
                digest.append(hashes(text, cuts, ends).view(np.int64))
            rows, start, length = (np.concatenate(x) for x in (rows, start, length))
            if narrow:
                yield pa.RecordBatch.from_arrays([pa.array(owners[rows]), pa.array(np.concatenate(digest))], names=["doc", "digest"])
                continue
            own = data[offsets[lo]:offsets[hi]]
            word_starts, word_ends = word_spans(own, offsets[lo:hi + 1] - offsets[lo])
            marks = hashes(own, word_starts, word_ends) % np.uint64(3) + np.uint64(1)
            marks = marks if len(marks) else np.zeros(1, np.uint64)
            begin = start + offsets[rows] - offsets[lo]
            inner, outer = np.searchsorted(word_starts, begin), np.searchsorted(word_starts, begin + length)
            low, high = (np.searchsorted(word_starts, offsets[rows + k] - offsets[lo]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([
                pa.array(owners[rows]), pa.array(start.astype(np.int32)), pa.array(length.astype(np.int32)),
                pa.array(np.concatenate(digest)), pa.array((outer - inner).astype(np.int32)),
                pa.array(_beside(marks, inner - 1, -1, low, high)), pa.array(_beside(marks, outer, 1, low, high))],
                names=["doc", "start", "length", "digest", "words", "before", "after"])
        give_back()


def _chunk_table(df: DataFrame, id_col: str, text: str, narrow: bool = False) -> DataFrame:
    rows = df.select(F.col(id_col).cast("long").alias("doc"), F.col(text).alias("text"))
    return rows.mapInArrow(lambda b: _chunk_rows(b, narrow), _NARROW if narrow else _SCHEMA)


def _named(doc: str) -> Column:
    return F.when(F.col(doc) < _NAMELESS, F.col(doc))


def document_chunks(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Chunks of every text: doc_id, start, length (bytes), digest."""
    return _chunk_table(df, id_col, text).select(_named("doc").alias("doc_id"), "start", "length", "digest")


def _agreeing(a: Column, b: Column) -> Column:
    """How many words beside two chunks agree, from the nearest on: pairs of bits
    below the lowest bit that differs, and no more than there are words."""
    differ = a.bitwiseXOR(b)
    below = F.bit_count(F.bitwise_not(differ).bitwiseAND(differ - 1))
    there = F.bit_count(a.bitwiseOR(F.shiftrightunsigned(a, 1)).bitwiseAND(F.lit(0x5555555555555555).cast("long")))
    return F.least(F.floor(below / 2).cast("int"), there)


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
                      min_run: int = MIN_RUN, long_run: int = LONG_RUN) -> DataFrame:
    """One row per passage, or part of one, that also stands in another document.

    Columns: doc_id, start and length (in UTF-8 bytes of the text, whole chunks),
    n_chunks, n_words (of the whole run, with the words at its ends that agree with
    another document), first_doc_id (the smallest id that holds one of these
    chunks), kept (true where the chunks occur in this document first, false where
    they are to be cut). Runs of ``min_words`` words or more count, if ``min_run``
    bytes of them are whole chunks, and runs of ``long_run`` bytes; a run of which
    some chunks occur here first and others elsewhere gives a row for each part.
    Repeats within one document are not reported; rows that share an id are one
    document, rows without an id are documents of their own, after all others.
    Null and empty texts have no chunks; an empty table gives an empty result. Only
    ids, places and hashes are shuffled; counts are pre-aggregated, and a digest
    that a third of all documents hold is one row of the aggregate.
    """
    # texts are cut twice: first for the digests alone, then for the rows of those that are shared
    # written: the join is planned by its size, and the rows of a frequent digest can be split
    shared = written(_chunk_table(df, id_col, text, narrow=True).groupBy("digest").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
                     .where("lo < hi").select(F.col("digest").alias("__d")))
    hits = written(_chunk_table(df, id_col, text).join(shared, F.col("digest") == F.col("__d")).drop("__d").distinct())
    place = F.struct("doc", "before", "after")
    ends = hits.groupBy(F.col("digest").alias("__d")).agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
    other = F.when(F.col("doc") == F.col("lo.doc"), F.col("hi")).otherwise(F.col("lo"))
    hits = hits.join(ends, F.col("digest") == F.col("__d")).select(
        "doc", "start", "length", "words", F.col("lo.doc").alias("first"), let(other, lambda o: F.struct(
            _agreeing(F.col("before"), o["before"]).alias("left"), _agreeing(F.col("after"), o["after"]).alias("right"))).alias("more"))
    # chunks that follow each other have the same start less the lengths before
    def island(*keys):
        before = Window.partitionBy("doc", *keys).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
        return F.col("start") - F.coalesce(F.sum("length").over(before), F.lit(0))

    whole = Window.partitionBy("doc", "run")
    runs = (hits.withColumn("run", island())
            .withColumns({"bytes": F.sum("length").over(whole),
                          "n_words": F.sum("words").over(whole) + F.min_by("more.left", "start").over(whole)
                          + F.max_by("more.right", "start").over(whole)})
            .where(((F.col("bytes") >= min_run) & (F.col("n_words") >= min_words)) | (F.col("bytes") >= long_run))
            .withColumn("kept", F.col("first") == F.col("doc")))
    return (runs.withColumn("part", island("run", "kept")).groupBy("doc", "run", "kept", "part", "n_words").agg(
        F.min("start").alias("start"), F.sum("length").alias("length"),
        F.count(F.lit(1)).alias("n_chunks"), F.min("first").alias("first"))
        .select(_named("doc").alias("doc_id"), F.col("start").cast("long").alias("start"), "length", "n_chunks", "n_words",
                _named("first").alias("first_doc_id"), "kept"))


def cut_passages(df: DataFrame, passages: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with the passages that are not kept cut out of the text column.

    Spans are byte ranges; each is cut at character borders because chunks of
    valid UTF-8 may start inside a character: such bytes stay. Rows without an id
    cannot be told apart and stay as they are.
    """
    spans = (passages.where(~F.col("kept") & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id"))
             .agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("__spans")))

    @F.pandas_udf("string")
    def cut(texts, spans):
        import pandas as pd

        out = []
        for body, drop in zip(texts, spans):
            if body is not None and drop is not None and len(drop):
                raw, keep, at = body.encode(), [], 0
                for s in drop:
                    a, b = s["start"], s["start"] + s["length"]
                    while a < b and raw[a] & 0xC0 == 0x80:
                        a += 1
                    while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
                        b -= 1
                    keep.append(raw[at:a])
                    at = max(at, b)
                body = b"".join([*keep, raw[at:]]).decode()
            out.append(body)
        return pd.Series(out, dtype=object)

    joined = df.join(spans, F.col(id_col).eqNullSafe(F.col("__id")), "left")
    return joined.withColumn(text, cut(F.col(text), F.col("__spans"))).select(*df.columns)

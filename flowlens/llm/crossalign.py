"""Alignment of two tokenisations of the same texts.

Both tokenizers encode the whole text, and both must give back its bytes. A byte
offset where tokens of both end is a shared end; one behind which both next
tokens start with a space is an anchor. Anchors split a document into windows,
tuples of ids on either side, and the alignment of a window (groups between
shared ends, links within groups) is worked out once and remembered by its id
tuples. Over the corpus, a pair of linked ids counts the documents that hold it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .pack import Encoder
from .pieces import PieceEncoder
from .textbytes import WINDOW, column_bytes, give_back, mix64, slices

#: Rows of pair counts that are broadcast at most: pairs that occur in at least
#: (all occurrences / HOT_PAIRS) documents, of which there are no more than that.
HOT_PAIRS = 100_000
#: Windows that a task remembers.
MEMORY = 400_000
_SPACE = 32


def byte_level_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    Latin-1 characters are themselves, the other bytes in order follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def ramp(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. count - 1 for each count, one behind the other."""
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - counts, counts)


class Rows:
    """Variable-length rows of one type, gathered by row numbers."""

    def __init__(self, kind: type):
        self.values, self.counts, self.starts = np.zeros(0, kind), np.zeros(0, np.int64), np.zeros(0, np.int64)

    @classmethod
    def of_strings(cls, strings: list[bytes]) -> Rows:
        rows = cls(np.uint8)
        rows.add(np.frombuffer(b"".join(strings), np.uint8), np.array([len(x) for x in strings], np.int64))
        return rows

    def add(self, values: np.ndarray, counts: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.values) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.values = np.concatenate([self.values, values.astype(self.values.dtype)])

    def __getitem__(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values of these rows, one behind the other; count of each)."""
        counts = self.counts[rows]
        upto = np.cumsum(counts)
        total = int(upto[-1]) if len(upto) else 0
        kind = np.int32 if max(total, len(self.values)) < 1 << 31 else np.int64
        shift = (self.starts[rows] - upto + counts).astype(kind)
        return self.values[np.repeat(shift, counts) + np.arange(total, dtype=kind)], counts


def byte_level_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizer file."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    byte = byte_level_characters()
    entries = dict(file["model"]["vocab"])
    entries.update((t["content"], t["id"]) for t in file.get("added_tokens", []))
    tokens = [b""] * (1 + max(entries.values()))
    for entry, i in entries.items():
        if all(c in byte for c in entry):
            tokens[i] = bytes(byte[c] for c in entry)
    return tokens


def piece_tokens(library) -> list[bytes]:
    """The bytes of each id of a piece model."""
    names = [library.id_to_piece(i) for i in range(library.vocab_size())]
    return [b"" if library.is_control(i) else bytes([int(p[3:5], 16)]) if library.is_byte(i)
            else p.replace("▁", " ").encode() for i, p in enumerate(names)]


class WindowMemory:
    """Alignments of windows, found by a 64-bit hash of their id tuples; the tuples
    are kept beside them and compared with those asked for."""

    def __init__(self):
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.groups = np.zeros(0, np.int64)
        #: ids of either side, linked pairs, and the groups as text
        self.a, self.b, self.pairs, self.text = Rows(np.int32), Rows(np.int32), Rows(np.int64), Rows(np.uint8)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``hashes`` of windows met for the first time, their hashes)."""
        different, first = np.unique(hashes, return_index=True)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, different), len(self.known) - 1)
            new = self.known[at] != different
            different, first = different[new], first[new]
        return first, different

    def add(self, hashes: np.ndarray, groups: np.ndarray, *rows: tuple[np.ndarray, np.ndarray]) -> None:
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.place = np.insert(self.place, at, len(self.groups) + np.arange(len(hashes)))
        self.groups = np.concatenate([self.groups, groups])
        for table, (values, counts) in zip((self.a, self.b, self.pairs, self.text), rows):
            table.add(values, counts)

    def index(self, hashes: np.ndarray) -> np.ndarray:
        return self.place[np.searchsorted(self.known, hashes)]


class Aligner:
    """Aligns the ids of batches of texts; remembers windows."""

    def __init__(self, byte_level: str, pieces: str):
        self.a, self.b = Encoder(byte_level), PieceEncoder(pieces)
        tokens_a, tokens_b = byte_level_tokens(byte_level), piece_tokens(self.b.library)
        self.bytes_a, self.bytes_b = Rows.of_strings(tokens_a), Rows.of_strings(tokens_b)
        self.spaced_a, self.spaced_b = (np.array([t[:1] == b" " for t in tokens]) for tokens in (tokens_a, tokens_b))
        #: each id in decimal digits, with room for a separator
        self.decimal = Rows.of_strings([b"%d " % i for i in range(max(len(tokens_a), len(tokens_b)))])
        #: a random 64-bit value for each id, and powers of an odd number and of its inverse
        self.id_values = mix64(np.arange(1, len(self.decimal.counts) + 1, dtype=np.uint64))
        odd = 0x9E3779B97F4A7C15
        self.powers = tuple(np.array([1, base], np.uint64) for base in (odd, pow(odd, -1, 1 << 64)))
        self.memory = WindowMemory()

    def _tuple_hashes(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of id tuples: a polynomial over random values of the ids, scrambled."""
        up, down = self.powers
        while len(up) < len(ids):
            up, down = self.powers = tuple(np.concatenate([p, p * (p[-1:] * p[1:2])]) for p in (up, down))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.id_values[ids] * up[:len(ids)])])
        return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def _learn(self, hashes: np.ndarray, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray,
               n_a: np.ndarray, n_b: np.ndarray) -> None:
        """Remember windows given by their ids, one behind the other; ``last_a`` and
        ``last_b`` mark ids that end at a shared end, ``n_a`` and ``n_b`` are the windows' sizes."""
        window = np.repeat(np.arange(len(n_a)), n_a)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        in_a, in_b = np.bincount(group_a), np.bincount(group_b)
        first_b = np.cumsum(in_b) - in_b
        # links: each id of A with all ids of B of its group
        each = in_b[group_a]
        pairs = np.repeat(a, each) << 32 | b[np.repeat(first_b[group_a], each) + ramp(each)]
        # a group is written as its ids of A, then those of B
        ids = np.zeros(len(a) + len(b), np.int64)
        mark = np.full(len(ids), ord(","), np.uint8)
        place_a = np.arange(len(a)) + first_b[group_a]
        place_b = np.arange(len(b)) + np.cumsum(in_a)[group_b]
        ids[place_a], ids[place_b] = a, b
        mark[place_a[last_a]], mark[place_b[last_b]] = ord("|"), ord(";")
        text, sizes = self.decimal[ids]
        text[np.cumsum(sizes) - 1] = mark
        whose = np.zeros(len(ids), np.int64)
        whose[place_a], whose[place_b] = window, np.repeat(np.arange(len(n_b)), n_b)
        n = len(n_a)
        self.memory.add(hashes, np.bincount(window, last_a, n).astype(np.int64), (a, n_a), (b, n_b),
                        (pairs, np.bincount(window, each, n).astype(np.int64)),
                        (text, np.bincount(whose, sizes, n).astype(np.int64)))

    def _checked(self, data, offsets, ids_a, at_a, ids_b, at_b) -> np.ndarray:
        """Which texts both tokenisations give back byte by byte (none of them empty)."""
        good = np.diff(offsets) > 1
        sides = ((ids_a, at_a, self.bytes_a), (ids_b, at_b, self.bytes_b))
        for ids, at, table in sides:
            upto = np.concatenate([[0], np.cumsum(table.counts[ids])])
            good &= upto[at[1:]] - upto[at[:-1]] == np.diff(offsets)
        text = np.repeat(np.arange(len(good)), np.diff(offsets))
        for ids, at, table in sides:
            held = good[text]
            differ = table[ids[np.repeat(good, np.diff(at))]][0] != data[held]
            good[text[held][differ]] = False
        return good

    def align(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups, pairs, times) of each text."""
        n = len(offsets) - 1
        if not len(data):
            return [_NOTHING] * n
        # a space in front of every text that is not empty
        some = np.diff(offsets) > 0
        spaced = np.insert(data, offsets[:-1][some], _SPACE)
        off = offsets + np.concatenate([[0], np.cumsum(some)])
        ids_a, at_a = self.a.encode(spaced, off)
        ids_b, _, _, at_b = self.b.encode(data, offsets)
        good = self._checked(spaced, off, ids_a, at_a, ids_b, at_b)
        if not good.any():
            return [_NOTHING] * n
        ids_a, ids_b = (ids[np.repeat(good, np.diff(at))].astype(np.int64) for ids, at in ((ids_a, at_a), (ids_b, at_b)))
        n_a, n_b = (np.where(good, np.diff(at), 0) for at in (at_a, at_b))
        upto_a = np.cumsum(n_a)
        ends_a, ends_b = np.cumsum(self.bytes_a.counts[ids_a]), np.cumsum(self.bytes_b.counts[ids_b])
        # shared ends, then anchors: a space-marked token follows on both sides
        at = np.searchsorted(ends_b, ends_a)
        shared_a = ends_b[at] == ends_a
        shared_b = np.zeros(len(ids_b), bool)
        shared_b[at[shared_a]] = True
        last = np.zeros(len(ids_a), bool)
        last[upto_a[good] - 1] = True
        follows_a = np.append(self.spaced_a[ids_a[1:]], True)
        follows_b = np.append(self.spaced_b[ids_b[1:]], True)
        stop_a = np.flatnonzero(shared_a & ((follows_a & follows_b[at]) | last)) + 1
        stop_b = at[stop_a - 1] + 1
        start_a, start_b = np.append(0, stop_a[:-1]), np.append(0, stop_b[:-1])
        keys = mix64(self._tuple_hashes(ids_a, start_a, stop_a)) + self._tuple_hashes(ids_b, start_b, stop_b)
        if len(self.memory.known) > MEMORY:
            self.memory = WindowMemory()
        new, hashes = self.memory.find(keys)
        if len(new):
            size_a, size_b = stop_a[new] - start_a[new], stop_b[new] - start_b[new]
            in_a, in_b = np.repeat(start_a[new], size_a) + ramp(size_a), np.repeat(start_b[new], size_b) + ramp(size_b)
            self._learn(hashes, ids_a[in_a], ids_b[in_b], shared_a[in_a], shared_b[in_b], size_a, size_b)
        index = self.memory.index(keys)
        for table, ids in ((self.memory.a, ids_a), (self.memory.b, ids_b)):
            if not np.array_equal(table[index][0], ids):
                raise RuntimeError("two windows of ids share a 64-bit hash")
        # windows, links and the written groups of each text
        edge = np.concatenate([[0], np.searchsorted(stop_a, upto_a, "right")])
        pairs, links = self.memory.pairs[index]
        text, sizes = self.memory.text[index]
        upto = [np.concatenate([[0], np.cumsum(c)])[edge] for c in (links, sizes, self.memory.groups[index])]
        rows, chars, groups = (u.tolist() for u in upto)
        text, out = text.tobytes(), []
        for i in range(n):
            if not good[i]:
                out.append(_NOTHING)
                continue
            own, times = np.unique(pairs[rows[i]:rows[i + 1]], return_counts=True)
            out.append((int(n_a[i]), int(n_b[i]), groups[i + 1] - groups[i], rows[i + 1] - rows[i],
                        text[chars[i]:chars[i + 1] - 1], own, times))
        return out


_NOTHING = (0, 0, 0, 0, b"", np.zeros(0, np.int64), np.zeros(0, np.int64))


@lru_cache(maxsize=1)
def _aligner(byte_level: str, pieces: str) -> Aligner:
    """One for each Python worker: tasks that follow reuse its memory."""
    return Aligner(byte_level, pieces)


_SCHEMA = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, {} string, "
           "pairs array<long>, times array<int>")


def _aligned(batches: Iterator[pa.RecordBatch], byte_level: str, pieces: str, digest: bool) -> Iterator[pa.RecordBatch]:
    aligner = _aligner(byte_level, pieces)
    for batch in batches:
        data, offsets = column_bytes(batch.column(1))
        for lo, hi in slices(offsets, WINDOW // 2):
            rows = aligner.align(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            n_a, n_b, n_groups, n_links, groups, pairs, times = zip(*rows)
            if digest:
                groups = [hashlib.sha256(g).hexdigest().encode() if g else b"" for g in groups]
            at = np.cumsum([0, *map(len, pairs)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), *(pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups, n_links)),
                 pa.array(groups, pa.binary()).cast(pa.string()),
                 pa.ListArray.from_arrays(at, pa.array(np.concatenate(pairs))),
                 pa.ListArray.from_arrays(at, pa.array(np.concatenate(times).astype(np.int32)))],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "written", "pairs", "times"])
        give_back()


def align_documents(df: DataFrame, byte_level: str, pieces: str, digest: bool = False, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times.

    A is the byte-level tokenizer on a space and the text, B the piece model on
    the text. ``groups`` is written ``a1,a2|b1;a3|b2,b3`` (with ``digest`` there is
    ``groups_sha256`` instead, its hash); ``pairs`` holds each linked pair once
    (A id << 32 | B id) and ``times`` how often it is linked.
    Null and empty texts, and those that either side does not give back byte by
    byte, have no tokens: zeros, an empty string and empty arrays. Rows that
    repeat an id are rows of their own, a null id stays null, other columns are
    ignored; an empty table gives an empty result. Nothing is shuffled.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(lambda b: _aligned(b, byte_level, pieces, digest), _SCHEMA.format("groups_sha256" if digest else "groups"))


def pair_statistics(pairs: DataFrame) -> DataFrame:
    """(pair, docs, best) of a table of (pair) rows, one for each document and pair.

    ``docs`` counts documents, ``best`` says that no pair of the same A id counts
    more. Rows are pre-aggregated; the highest counts are one row for each A id.
    """
    counts = written(pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
                     .withColumn("a", F.shiftright("pair", 32)))
    top = counts.groupBy(F.col("a").alias("__a")).agg(F.max("docs").alias("top"))
    return written(counts.join(top, F.col("a") == F.col("__a")).select("pair", "docs", (F.col("docs") == F.col("top")).alias("best")))


def score_alignments(aligned: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``aligned`` without its lists, with n_best, count_sum and groups_sha256.

    ``n_best`` counts the links whose pair has its A id's highest document count,
    ``count_sum`` adds the document counts of all links. Pairs in at least
    1 / ``hot_pairs`` of all (document, pair) rows are at most ``hot_pairs`` and
    are broadcast, whatever the corpus; all others are joined by shuffle, and no
    key there holds more than that share of the rows. Rows are told apart by a
    number that is written with them, so ids may be null or repeat.
    """
    if "groups" in aligned.columns:
        aligned = aligned.withColumn("groups_sha256", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(""))
    rows = written(aligned.select(
        F.monotonically_increasing_id().alias("__row"), "doc_id", "n_a", "n_b", "n_groups", "n_links",
        "groups_sha256", "pairs", "times"))
    statistics = pair_statistics(rows.select(F.explode("pairs").alias("pair")))
    occurrences = statistics.agg(F.sum("docs")).first()[0] or 0
    least = -(-occurrences // hot_pairs)
    links = rows.select("__row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(
        "__row", F.col("l.pairs").alias("link"), F.col("l.times").alias("times"))
    found = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
             F.sum(F.col("times") * F.col("docs")).alias("count_sum")]

    def sums(part: DataFrame, table: DataFrame) -> DataFrame:
        return part.join(table, F.col("link") == F.col("pair")).groupBy("__row").agg(*found)

    hot = F.broadcast(statistics.where(F.col("docs") >= least))
    cold = links.join(hot.select("pair"), F.col("link") == F.col("pair"), "left_anti")
    total = sums(links, hot).unionByName(sums(cold, statistics.where(F.col("docs") < least))).groupBy(
        F.col("__row").alias("__r")).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))

    def filled(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("long").alias(name)

    return rows.drop("pairs", "times").join(total, F.col("__row") == F.col("__r"), "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", filled("n_best"), filled("count_sum"), "groups_sha256")

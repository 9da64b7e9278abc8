"""SentencePiece encoding with source offsets, and decoding.

A text is normalised first: at each place the longest prefix that the model's
compiled character map knows (a double-array trie) is replaced, anything else
stays a character, white space is handled as the model says, and every byte
written records the source byte it comes from. The library encodes the normalised
text, and its pieces are projected through the recorded alignment to byte spans of
the original text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbytes import column_bytes, give_back, slices

_MARK = "▁".encode()
_BAD = "�".encode()
_SPACE = 32
#: A normaliser message without map, prefix, white-space rules or escapes: behind
#: a model's bytes it replaces those settings (the text is normalised already).
_NO_RULES = bytes([0x1A, 8, 0x12, 0, 0x18, 0, 0x20, 0, 0x28, 0])


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, data[at:at + size]
            at += size


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. count - 1 for each count, one behind the other."""
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - counts, counts)


class CharacterMap:
    """The compiled character map: a double-array trie over byte strings and the
    texts that replace them (blob: size, trie units, texts ended by a zero byte)."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob, "<u4", size // 4, 4)
        self.texts = np.frombuffer(blob, np.uint8, offset=4 + size)
        zeros = np.flatnonzero(self.texts == 0)
        self.ends = np.append(zeros, len(self.texts))

    @staticmethod
    def _offset(unit: np.ndarray) -> np.ndarray:
        return (unit >> np.uint32(10)) << ((unit & np.uint32(512)) >> np.uint32(6))

    def longest(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(length, text offset) of the longest known prefix at each start; length 0
        where there is none. All starts walk down the trie together."""
        length = np.zeros(len(starts), np.int64)
        value = np.zeros(len(starts), np.int64)
        alive = np.flatnonzero(starts < ends)
        node = np.full(len(alive), int(self._offset(self.units[:1])[0]), np.uint32)
        depth = 0
        while len(alive):
            byte = data[starts[alive] + depth].astype(np.uint32)
            node = node ^ byte
            inside = node < len(self.units)
            unit = self.units[np.where(inside, node, 0)]
            on = inside & ((unit & np.uint32(0x800000FF)) == byte)
            alive, node, unit = alive[on], node[on], unit[on]
            node = node ^ self._offset(unit)
            depth += 1
            leaf = (unit >> np.uint32(8)) & np.uint32(1) == 1
            length[alive[leaf]] = depth
            value[alive[leaf]] = self.units[node[leaf]] & np.uint32(0x7FFFFFFF)
            more = starts[alive] + depth < ends[alive]
            alive, node = alive[more], node[more]
        return length, value

    def replacements(self, value: np.ndarray) -> np.ndarray:
        """Lengths of the texts at these offsets."""
        return self.ends[np.searchsorted(self.ends, value)] - value


def _is_text(data: np.ndarray, offsets: np.ndarray) -> bool:
    """Whether all texts are valid UTF-8."""
    inner = offsets[:-1][offsets[:-1] < len(data)]
    if ((data[inner] & 0xC0) == 0x80).any():
        return False
    try:
        str(data.data, "utf-8")
    except UnicodeDecodeError:
        return False
    return True


def character_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, valid) of the characters; a byte that starts no valid UTF-8
    sequence is a character of its own, not valid."""
    n = len(data)
    lead = data
    if _is_text(data, offsets):
        starts = np.flatnonzero((data & 0xC0) != 0x80)
        return starts, np.diff(starts, append=n), np.ones(len(starts), bool)
    size = np.ones(n, np.int64)
    size[(lead >= 0xC2) & (lead < 0xE0)] = 2
    size[(lead >= 0xE0) & (lead < 0xF0)] = 3
    size[(lead >= 0xF0) & (lead < 0xF5)] = 4
    tail = (data & 0xC0) == 0x80
    valid = (lead < 0x80) | (size > 1)
    end = np.repeat(offsets[1:], np.diff(offsets))
    places = np.arange(n)
    for k in (1, 2, 3):
        need = size > k
        at = places + k
        inside = at < end
        valid &= ~need | (inside & tail[np.where(inside, at, 0)])
    after = data[np.minimum(places + 1, max(n - 1, 0))] if n else data
    # overlong forms, surrogates and what lies beyond the last code point
    valid &= ~((lead == 0xE0) & (after < 0xA0)) & ~((lead == 0xED) & (after >= 0xA0))
    valid &= ~((lead == 0xF0) & (after < 0x90)) & ~((lead == 0xF4) & (after >= 0x90))
    covered = np.zeros(n, bool)
    for k in (1, 2, 3):
        wide = np.flatnonzero(valid & (size > k)) + k
        covered[wide] = True
    starts = np.flatnonzero(~covered)
    return starts, np.where(valid, size, 1)[starts], valid[starts]


class Normaliser:
    """Normalises byte strings and records where each written byte comes from."""

    def __init__(self, spec: bytes, kept: list[bytes], suffix: bool = False):
        settings = {2: b"", 3: 1, 4: 1, 5: 1}
        settings.update(message_fields(spec))
        self.map = CharacterMap(settings[2]) if len(settings[2]) > 4 else None
        self.dummy, self.squeeze, self.escape = (bool(settings[k]) for k in (3, 4, 5))
        #: strings of the vocabulary that are never replaced, longest first
        self.kept = sorted(kept, key=len, reverse=True)
        if suffix:
            raise ValueError("models with white space as a suffix are not supported")

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, offsets, source of each byte, source end of each text).

        Sources are byte places in ``data``; a deleted character belongs to what
        stands before it.
        """
        n = len(offsets) - 1
        if not len(data):
            return data, np.zeros(n + 1, np.int64), np.zeros(0, np.int64), offsets[1:].astype(np.int64)
        if self.map is None and not self.kept and not self.squeeze and _is_text(data, offsets):
            # nothing is replaced or dropped: every byte is written as it stands
            text = np.repeat(np.arange(n), np.diff(offsets))
            return self._escaped(data, np.arange(len(data)), text, offsets[:-1], offsets)
        starts, width, valid = character_starts(data, offsets)
        # units: source place, source length, place and length of the text written
        pool = [data, np.frombuffer(_BAD, np.uint8)]
        place, size, took = starts.copy(), width.copy(), width.copy()
        place[~valid], size[~valid] = len(data), len(_BAD)
        owner = np.searchsorted(offsets, starts, "right") - 1
        if self.map is not None:
            pool.append(self.map.texts)
            long, value = self.map.longest(data, starts, offsets[owner + 1])
            hit = long > 0
            took[hit] = long[hit]
            place[hit] = len(data) + len(_BAD) + value[hit]
            size[hit] = self.map.replacements(value[hit])
        for text in self.kept:
            raw, at = data.tobytes(), -1
            while (at := raw.find(text, at + 1)) >= 0:
                k = int(np.searchsorted(starts, at))
                if k < len(starts) and starts[k] == at and at + len(text) <= offsets[owner[k] + 1] and place[k] >= 0:
                    place[k], size[k], took[k] = -1 - at, len(text), len(text)
        place = np.where(place < 0, -1 - place, place)
        # a unit of several characters swallows those behind it
        if (wide := np.flatnonzero(took > width)).size:
            gone, reach = np.zeros(len(starts), bool), -1
            for k in wide.tolist():
                if starts[k] >= reach:
                    reach = int(starts[k] + took[k])
                    gone[k + 1:int(np.searchsorted(starts, reach))] = True
            starts, took, place, size, owner = (a[~gone] for a in (starts, took, place, size, owner))
        pool = np.concatenate(pool)
        written = pool[np.repeat(place, size) + _ramp(size)]
        unit = np.repeat(np.arange(len(starts)), size)
        if self.squeeze:
            keep = self._squeezed(written, unit, size, owner)
            written, unit = written[keep], unit[keep]
        # the prefix of a text stands at its first unit that is not a space
        solid = np.flatnonzero((size != 1) | (pool[np.minimum(place, len(pool) - 1)] != _SPACE))
        first = np.asarray(offsets[:-1], np.int64).copy()
        if self.squeeze:
            which, at = np.unique(owner[solid], return_index=True)
            first[which] = starts[solid[at]]
        return self._escaped(written, starts[unit], owner[unit], first, offsets)

    @staticmethod
    def _squeezed(written: np.ndarray, unit: np.ndarray, size: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Which written bytes stay: a unit's leading spaces go at the start of a
        text and behind a space."""
        blank = written == _SPACE
        upto = np.cumsum(size)
        some = size > 0
        last = np.zeros(len(size), bool)
        last[some] = blank[upto[some] - 1]
        # the nearest unit before that wrote something
        seen = np.maximum.accumulate(np.where(some, np.arange(len(size)), -1))
        before = np.concatenate([[-1], seen[:-1]])
        fresh = (before < 0) | (owner[np.maximum(before, 0)] != owner)
        after_space = fresh | last[np.maximum(before, 0)]
        first_solid = np.full(len(size), np.iinfo(np.int64).max)
        solid = np.flatnonzero(~blank)
        np.minimum.at(first_solid, unit[solid], solid)
        leading = blank & (np.arange(len(written)) < first_solid[unit])
        return ~(leading & after_space[unit])

    def _escaped(self, written: np.ndarray, source: np.ndarray, text: np.ndarray, first: np.ndarray, offsets: np.ndarray):
        """Trailing white space goes where asked, spaces become marks, and the prefix
        of a text stands at the source ``first``."""
        n = len(offsets) - 1
        ends = np.asarray(offsets[1:], np.int64).copy()
        if self.squeeze and len(written):
            mark = np.zeros(len(written), bool)
            three = np.flatnonzero((written[:-2] == _MARK[0]) & (written[1:-1] == _MARK[1]) & (written[2:] == _MARK[2])
                                   & (text[:-2] == text[2:])) if len(written) > 2 else np.zeros(0, np.int64)
            if self.escape:
                for k in range(3):
                    mark[three + k] = True
            mark |= written == _SPACE
            solid = np.flatnonzero(~mark)
            last = np.full(n, -1, np.int64)
            last[text[solid]] = solid
            trailing = np.arange(len(written)) > last[text]
            if (gone := np.flatnonzero(trailing)).size:
                which, at = np.unique(text[gone], return_index=True)
                ends[which] = source[gone[at]]
            written, source, text = written[~trailing], source[~trailing], text[~trailing]
        space = written == _SPACE
        escaped = _MARK if self.escape else b" "
        counts = np.where(space & self.escape, 3, 1)
        has = np.zeros(n, bool)
        has[text] = True
        if not self.squeeze:
            has = np.diff(offsets) > 0
        lead = has & self.dummy
        head = np.searchsorted(text, np.flatnonzero(lead))
        sizes = np.insert(counts, head, len(escaped))
        filler = np.insert(np.where(space, _SPACE, written), head, _SPACE).astype(np.uint8)
        out_source = np.repeat(np.insert(source, head, first[lead]), sizes)
        out_text = np.repeat(np.insert(text, head, np.flatnonzero(lead)), sizes)
        out = np.repeat(filler, sizes)
        if self.escape:
            wide = np.flatnonzero(np.repeat(filler == _SPACE, sizes))
            out[wide] = np.resize(np.frombuffer(_MARK, np.uint8), len(wide))
        return out, np.searchsorted(out_text, np.arange(n + 1)), out_source, ends


class PieceEncoder:
    """Ids and source spans of texts by a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            raw = f.read()
        self._setup(sentencepiece, raw)

    @classmethod
    def from_bytes(cls, raw: bytes) -> PieceEncoder:
        import sentencepiece

        self = cls.__new__(cls)
        self._setup(sentencepiece, raw)
        return self

    def _setup(self, sentencepiece, raw: bytes) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=raw + _NO_RULES)
        spec, trainer, kept = b"", {}, []
        for number, value in message_fields(raw):
            if number == 1:
                piece = dict(message_fields(value))
                if piece.get(3) == 4:
                    kept.append(piece[1])
            elif number == 2:
                trainer.update(message_fields(value))
            elif number == 3:
                spec += value  # later settings replace earlier ones, as in the library
        self.normalise = Normaliser(spec, kept, bool(trainer.get(24)))
        names = [self.library.id_to_piece(i) for i in range(self.library.vocab_size())]
        self.byte = np.array([self.library.is_byte(i) for i in range(len(names))])
        #: normalised bytes of each piece; of a byte piece, those of the character that it begins
        self.size = np.array([_utf8_width(int(p[3:5], 16)) if b else len(p.encode()) for p, b in zip(names, self.byte)])
        self.unknown = self.library.unk_id()
        self.end_id = self.library.eos_id()

    def _sizes(self, ids: np.ndarray, texts: list[bytes], upto: np.ndarray) -> np.ndarray:
        """Normalised bytes that each piece takes: of the byte pieces of one
        character, the last takes all."""
        took = self.size[ids]
        where = np.flatnonzero(self.byte[ids])
        lead = where[took[where] > 0]
        wide = took[lead]
        took[where] = 0
        took[lead + wide - 1] = wide
        if (ids == self.unknown).any():  # without byte pieces: an unknown piece takes what it stands for
            for k in np.unique(np.searchsorted(upto, np.flatnonzero(ids == self.unknown), "right") - 1):
                took[upto[k]:upto[k + 1]] = [len(p.encode()) for p in self.bare.encode(texts[k], out_type=str)]
        return took

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begins, ends, offsets) of the texts data[offsets[i]:offsets[i + 1]];
        begins and ends are byte places in each text."""
        norm, upto, source, finish = self.normalise(data, offsets)
        if not len(norm):
            none = np.zeros(0, np.int64)
            return none.astype(np.int32), none, none, np.zeros(len(offsets), np.int64)
        raw = norm.tobytes()
        texts = [raw[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]
        found = self.bare.encode_as_numpy(texts, num_threads=1)
        ids = np.concatenate(found)
        at = np.concatenate([[0], np.cumsum([len(f) for f in found])])
        took = self._sizes(ids, texts, at)
        stop = np.cumsum(took)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
        # a zero-length piece stands where its character does
        places = np.append(source, 0)
        begins = places[stop - took]
        ends = np.where(stop == upto[text + 1], finish[text], places[stop])
        ends = np.where(took > 0, ends, begins)
        return ids, begins - offsets[text], ends - offsets[text], at


def _utf8_width(byte: int) -> int:
    """Bytes of the character that a byte begins; 0 where it continues one."""
    return 1 if byte < 0x80 else 0 if byte < 0xC0 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """One for each Python worker: tasks that follow reuse its memory."""
    return PieceEncoder(path)


_SCHEMA = "doc_id long, ids array<int>, begins array<int>, ends array<int>, decoded string"


def _encoded(batches: Iterator[pa.RecordBatch], path: str, end: bool) -> Iterator[pa.RecordBatch]:
    encoder = piece_encoder(path)
    for batch in batches:
        data, offsets = column_bytes(batch.column(1))
        for lo, hi in slices(offsets):
            own = offsets[lo:hi + 1] - offsets[lo]
            ids, begins, ends, at = encoder.encode(data[offsets[lo]:offsets[hi]], own)
            if end:
                sizes = np.diff(own)
                ids = np.insert(ids, at[1:], encoder.end_id)
                begins, ends = np.insert(begins, at[1:], sizes), np.insert(ends, at[1:], sizes)
                at = at + np.arange(len(at))
            rows = np.split(ids, at[1:-1])
            lists = [pa.ListArray.from_arrays(at.astype(np.int32), pa.array(c.astype(np.int32))) for c in (ids, begins, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), *lists, pa.array(encoder.library.decode(rows), pa.string())],
                names=["doc_id", "ids", "begins", "ends", "decoded"])
        give_back()


def encode_documents(df: DataFrame, model: str, end: bool = True, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, ids, begins, ends, decoded.

    ``ids`` are those of the library for the whole text (with the end id where
    ``end``), ``begins`` and ``ends`` the UTF-8 bytes of the original text that
    each piece stands for (a character that is written as bytes belongs to its
    last byte piece, the end id to nothing), ``decoded`` the library's decoding of
    the ids. A null or empty text has the end id only and decodes to the empty
    string. Strings of special pieces in a text are ordinary text. Rows that
    repeat an id are rows of their own, a null id stays null, other columns are
    ignored; an empty table gives an empty result. Nothing is shuffled; a task
    holds one window of texts, or one longer text, at a time.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(lambda b: _encoded(b, model, end), _SCHEMA)


def encoding_digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by one space), decoded_sha256."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))

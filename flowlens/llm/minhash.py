"""Near-duplicate detection by bottom-k sketches of one hash function.

A document's set is its distinct word shingles, each hashed once (64 bits); the
sketch is the K smallest hashes, for smaller sets the whole set. Documents with
equal sets form a class, and only one of them goes on.

Inverted lists of retained values find who can be similar. Two sets with a
similarity of T or more share nearly T of their sketches, so with values in the
order of their list lengths (rarest first) two such sketches share a value
among the first few already: only these enter lists. Values of common passages
have long lists, come last, and enter none. All members of a list are tied to
its smallest member (a star, never all pairs), and connected stars make the
neighbourhoods. Within a neighbourhood the sketch of the union estimates each
pair's similarity, and pairs that come near are verified on the full sets. A
large neighbourhood is compared in pairs of blocks, each a task of its own that
returns a spanning forest of its links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import one_of_each, written
from .textbytes import LOWER, SpanHasher, column_bytes, give_back, mix64, slices, word_spans

K = 64
#: Sketches of sets as similar as asked share fewer values than this share of
#: the similarity with a chance of 1e-6 (binomial tail of K draws).
SAFE = 0.7
#: Pairs whose estimate lies this far below the threshold are not verified:
#: five deviations of a K-value estimate.
MARGIN = 0.25
#: Members and set values of a block.
BLOCK_ROWS = 256
BLOCK_VALUES = 1 << 20

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, hashes: SpanHasher, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes (63 bits) of each text; lower-cases A-Z.

    A text with fewer words has its whole sequence as the only shingle.
    """
    data = LOWER[data]
    starts, ends = word_spans(data, offsets)
    hashed = hashes(data, starts, ends)
    at = np.searchsorted(starts, offsets)
    for a, b in zip(at, at[1:]):
        own = hashed[a:b]
        n = min(words, len(own))
        h = np.full(max(len(own) - n + 1, 0) if n else 0, n, np.uint64)
        for k in range(n):
            h = (h * _A + own[k:k + len(h)]) * _B
            h ^= h >> np.uint64(32)
        yield np.unique(mix64(h) >> np.uint64(1))


def _digest(values: np.ndarray) -> int:
    """64-bit digest of a set."""
    with np.errstate(over="ignore"):
        return int((mix64(values + _A).sum(dtype=np.uint64) ^ mix64(values ^ _B).sum(dtype=np.uint64) * _B).view(np.int64))


def _sketches(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    hashes = SpanHasher()
    for batch in batches:
        data, offsets = column_bytes(batch.column(2))
        for lo, hi in slices(offsets):
            sets = list(shingle_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], hashes, words))
            kept = [s[:K] for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(lo, hi - lo),
                batch.column(1).slice(lo, hi - lo),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_digest(s) for s in sets], pa.int64()),
                pa.array([int(s.sum(dtype=np.uint64) >> np.uint64(1)) for s in sets], pa.int64()),
                pa.ListArray.from_arrays(np.cumsum([0, *map(len, kept)]).astype(np.int32),
                                         np.concatenate([*kept, np.zeros(0, np.uint64)]).view(np.int64))],
                names=["doc_id", "key", "n_shingles", "node", "check", "sketch"])
        give_back()


def _full_sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    hashes = SpanHasher()
    for batch in batches:
        data, offsets = column_bytes(batch.column(0))
        for lo, hi in slices(offsets):
            sets = list(shingle_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], hashes, words))
            yield pa.RecordBatch.from_arrays([
                pa.array([_digest(s) for s in sets], pa.int64()),
                pa.ListArray.from_arrays(np.cumsum([0, *map(len, sets)]).astype(np.int32),
                                         np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64))],
                names=["node", "values"])
        give_back()


def _common(sets: list[np.ndarray], left: int) -> np.ndarray:
    """Sizes of the intersections of sets[:left] with sets[left:] (or with
    themselves where left is all of them); columns in slabs, memory bounded."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = n > 1
    number = np.cumsum(shared) - 1
    pick = shared[column]
    owner, column = owner[pick], number[column[pick]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    same = left == len(sets)
    out = np.zeros((left, left if same else len(sets) - left), np.float32)
    width = 4096
    for a in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(column, [a, a + width])
        slab = np.zeros((len(sets), width), np.float32)
        slab[owner[lo:hi], column[lo:hi] - a] = 1
        out += slab[:left] @ (slab if same else slab[left:]).T
    return out


def _links(sets: list[np.ndarray], left: int, percent: int) -> list[tuple[int, int]]:
    """All pairs (i, j) of the two sides with similarity of ``percent`` or more."""
    same = left == len(sets)
    shift = 0 if same else left
    a = [s[:K] for s in sets]
    full = np.array([len(s) <= K for s in sets])
    # below the smaller of the two largest retained values, both sketches know all of the union
    top = np.array([np.iinfo(np.int64).max if f else int(s[-1]) for s, f in zip(a, full)])
    known = np.stack([np.searchsorted(s, top, "right") for s in a])
    both = _common(a, left)
    union = known[:left, shift:] + known[shift:, :left].T - both
    near = both >= (percent / 100 - MARGIN) * union
    if same:
        near &= np.tri(left, k=-1, dtype=bool)
    i, j = np.nonzero(near)
    if not len(i):
        return []
    # verify on the full sets of those that are still in question
    rows, columns = np.unique(i), np.unique(j + shift)
    if same:
        rows = columns = np.unique(np.concatenate([i, j]))
        exact = _common([sets[r] for r in rows], len(rows))
    else:
        exact = _common([sets[r] for r in [*rows, *columns]], len(rows))
    size = np.array([len(s) for s in sets])
    inter = exact[np.searchsorted(rows, i), np.searchsorted(columns, j + shift)].astype(np.int64)
    ok = 100 * inter >= percent * (size[i] + size[j + shift] - inter)
    return list(zip(i[ok].tolist(), (j + shift)[ok].tolist()))


def _forest(block: pd.DataFrame, percent: int) -> pd.DataFrame:
    """A spanning forest of the links of one pair of blocks (columns a, b)."""
    block = block.drop_duplicates(["side", "node"]).sort_values(["side", "node"])
    nodes = block["node"].tolist()
    sets = [np.asarray(v, np.int64) for v in block["values"]]
    left = int((block["side"] == 0).sum())
    root = list(range(len(nodes)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in _links(sets, left, percent) if left else []:
        x, y = find(i), find(j)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((nodes[i], nodes[j]))
    del sets, block
    give_back()
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node of ``edges`` (a, b) reaches.

    Alternates large-star and small-star rounds, in which a node's neighbours
    move to its smallest neighbour, until nothing changes. Only minima are
    gathered for a node, whatever its degree. Every round is written down.
    """
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def small_star(e: DataFrame) -> DataFrame:
        low = e.groupBy(F.col("a").alias("x")).agg(F.min("b").alias("m"))
        near = e.join(low, F.col("a") == F.col("x"))
        return (near.select(F.col("b").alias("a"), F.col("m").alias("b"))
                .unionByName(low.select(F.col("x").alias("a"), F.col("m").alias("b")))
                .where("a <> b").distinct())

    def large_star(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("x")).agg(F.least(F.min("b"), F.col("x")).alias("m"))
        return (both.where("b > a").join(low, F.col("a") == F.col("x"))
                .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())

    # a is the larger end throughout
    now = written(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before, after = None, state(now)
    while after != before:
        before, now = after, written(small_star(large_star(now)))
        after = state(now)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def candidate_stars(classes: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that tie the members of each list of rare retained values.

    ``classes`` has node, n_shingles and sketch. Of k retained values, sketches
    of similar sets share t or more, so they share one of the k - t + 1 rarest.
    """
    n, k = F.col("n_shingles"), F.size("sketch")
    # sets this small have similar sets that are retained whole too: t is exact
    whole = n <= math.floor((K - 1) * percent / 100)
    t = F.when(whole, F.ceil(n * percent / 100)).otherwise(F.lit(math.floor(SAFE * K * percent / 100)))
    values = classes.select("node", k.alias("k"), (k - t + 1).cast("int").alias("take"), F.explode("sketch").alias("value"))
    # written: the rows of a frequent value can then be split in the join
    shared = written(values.groupBy(F.col("value").alias("v")).agg(F.count(F.lit(1)).alias("members"))
                     .where("members > 1"))
    # values of a single class are the rarest and tie nothing: only their number counts
    ranked = (values.join(shared, F.col("value") == F.col("v")).groupBy("node", "k", "take")
              .agg(F.sort_array(F.collect_list(F.struct("members", "value"))).alias("order")))
    left = F.greatest(F.lit(0), F.col("take") - (F.col("k") - F.size("order")))
    rare = written(ranked.select("node", F.explode(F.slice("order", F.lit(1), left)).alias("l"))
                   .select("node", "l.value"))
    center = rare.groupBy(F.col("value").alias("v")).agg(F.min("node").alias("b"))
    return rare.join(center, F.col("value") == F.col("v")).select(F.col("node").alias("a"), "b")


def verified_links(df: DataFrame, classes: DataFrame, near: DataFrame, text: str, id_col: str,
                   words: int, percent: int) -> DataFrame:
    """Links (a, b) whose connections are those of all links within neighbourhoods.

    ``near`` has (node, root). Every full set of a neighbourhood moves once for
    each block it is compared with.
    """
    members = near.join(classes.select(F.col("node").alias("c"), "n_shingles", "rep"), F.col("node") == F.col("c")).drop("c")
    blocks = members.groupBy(F.col("root").alias("r")).agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n_shingles") / BLOCK_VALUES))
        .cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = written(members.join(blocks, F.col("root") == F.col("r"))
                     .select("node", "rep", "root", "blocks", own.alias("own")))
    # representatives are the narrow side, held partition by partition; texts stream past them
    texts = df.select(F.col(text).alias("text"), F.col(id_col).cast("long").alias("id")).join(
        placed.select("rep").distinct().hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("rep")), "left_semi").select("text")
    sets = texts.mapInArrow(lambda b: _full_sets(b, words), "node long, values array<long>")
    spread = placed.select("node", "root", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    spread = spread.select(F.col("node").alias("m"), "root", F.least("own", "other").alias("i"),
                           F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    return (sets.join(spread, F.col("node") == F.col("m")).drop("m").groupBy("root", "i", "j")
            .applyInPandas(lambda block: _forest(block, percent), "a long, b long"))


def _components(df: DataFrame, words: int, percent: int, id_col: str, text: str) -> DataFrame:
    """One row per row of ``df``: doc_id, key (hash of the whole text), n_shingles,
    label (the component's smallest id) and component (null without shingles)."""
    rows = written(df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("key"), F.col(text).alias("text")).mapInArrow(
        lambda b: _sketches(b, words),
        "doc_id long, key long, n_shingles long, node long, check long, sketch array<long>"))
    classes = written(rows.where("n_shingles > 0").groupBy("node", "n_shingles", "check").agg(
        F.min("doc_id").alias("rep"), F.any_value("sketch").alias("sketch")))
    near = connected(candidate_stars(classes, percent))
    links = verified_links(df, classes, near, text, id_col, words, percent)
    roots = connected(links).withColumnRenamed("node", "linked")
    named = classes.select("node", "rep")
    smallest = (named.join(roots, F.col("node") == F.col("linked"))
                .groupBy(F.col("root").alias("r")).agg(F.min("rep").alias("smallest")))
    names = roots.join(smallest, F.col("root") == F.col("r")).select("linked", "root", "smallest")
    labels = written(named.join(names, F.col("node") == F.col("linked"), "left").select(
        F.col("node").alias("c"), F.coalesce("smallest", "rep").alias("label"), F.coalesce("root", "node").alias("component")))
    out = rows.select("doc_id", "key", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("node")).alias("node"))
    return out.join(labels, F.col("node") == F.col("c"), "left").select("doc_id", "key", "n_shingles", "label", "component")


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= percent * union of their
    shingle sets; ``component_id`` is the smallest id reachable. Null, empty and
    word-less texts have no shingles and are linked with nothing. Rows with
    equal sets are always linked, also where they share an id; a null id never
    names a component before another id. Fewer words than a shingle make one
    shingle. An empty table gives an empty result. The text is read twice, the
    second time for candidates only.
    """
    component = F.coalesce("label", "doc_id")
    return _components(df, words, percent, id_col, text).select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text: str = "text") -> DataFrame:
    """One row of ``df`` for each component, with all columns of ``df``.

    The smallest id stays, null last; where it stands for several texts of the
    component, the one with the lowest hash, and one of equal rows. Texts without
    shingles are linked with nothing: one row for each id and text stays.
    """
    rows = _components(df, words, percent, id_col, text)
    alone = F.col("component").isNull()
    per = rows.groupBy("component", "doc_id", "key").agg(F.count(F.lit(1)).alias("n"))
    first = (per.groupBy("component", F.when(alone, F.col("doc_id")).alias("own"), F.when(alone, F.col("key")).alias("text"))
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "n")).alias("f")))
    return one_of_each(df, first.select("f.doc_id", "f.key", "f.n"),
                       (F.col(id_col).cast("long"), "doc_id"), (F.xxhash64(F.col(text)), "key"))

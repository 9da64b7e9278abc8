"""Boosted trees of all classes, grown together until patience ends them (M3-M6).

MLlib grows one ensemble at a time, runs a job for each level of each tree, and
cannot go on with an ensemble, so that rounds are fitted again when more are asked
for. Here the trees that all classes get in a round grow side by side: a job a level
adds up the histograms of all of them, the driver chooses the splits, and the
validation loss of the round before comes with the first level. Rows that are worth
one partition have all their rounds in one task instead.

The trees are those of MLlib's ``GBTClassifier``: its split candidates, its bins, its
Bernoulli samples (seed, round and partition), its variance gains summed up in the
order of the rows, its rules for leaves and its pruning; they come back as its models.

The cached rows are their bins, a byte for each value. What the rounds make of them
(margins, residuals, the nodes rows are in) stays in the Python worker that made it,
up to ``KEPT`` bytes; another worker, or one that let go of it, makes it again from
the trees and splits, which go out with each job.
"""

from __future__ import annotations

import math
import pickle
import sys
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.constants import LOGLOSS_EPS
from flowlens.operators.boosting import Rounds, patience_stop
from flowlens.session import ship_package

#: Feature values in a partition: from the first number on a job a level is worth its start,
#: the second is what one grows to before there are more of them than cores.
LEAST_VALUES, MOST_VALUES = 250_000, 8_000_000
#: Bytes of margins, and of what else a round needs, that a Python worker keeps.
KEPT = 192_000_000, 128_000_000
#: Rounds whose trees go out with each job; older ones are broadcast. Bytes of histograms
#: that come to the driver at once; larger ones are added up on the way.
RECENT, COLLECTED = 32, 32_000_000


@dataclass(frozen=True)
class Growth:
    """What a task needs: upper ends of the bins, the label each ensemble tells from the
    others (None: never seen), the weight of rows with that label, and the rules."""

    cuts: list[np.ndarray]
    targets: list[int | None]
    joint: bool
    weight: float
    step: float
    depth: int
    least_gain: float
    subsample: float
    seed: int
    limit: int
    patience: int
    min_gain: float


@dataclass
class Node:
    """``sums``: weight, sum and sum of squares of the residuals, and rows. A node that
    was looked at and not split has no impurity (-1), as in MLlib."""

    sums: np.ndarray
    impurity: float
    feature: int = -1
    bin: int = 0
    gain: float = 0.0
    left: int = -1
    right: int = -1

    @property
    def value(self) -> float:
        return float(self.sums[1] / self.sums[0]) if self.sums[0] else 0.0


def can_grow(vectors: DataFrame) -> bool:
    """Features are taken as numbers; those with categories are left to MLlib."""
    attrs = vectors.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    return not attrs.get("nominal") and not attrs.get("binary")


def grow_partitions(values: int, cores: int) -> int:
    return max(1, min(math.ceil(values / LEAST_VALUES), cores), math.ceil(values / MOST_VALUES))


def _only(name: str):
    """A Scala object."""
    package, _, own = name.rpartition(".")
    found = SparkContext._jvm
    for part in package.split("."):
        found = getattr(found, part)
    return getattr(getattr(found, f"{own}$"), "MODULE$")


def split_candidates(rows: DataFrame, estimator: GBTClassifier) -> list[np.ndarray]:
    """MLlib's candidates for each feature, after its checks of labels, weights and vectors."""
    jvm, ml = SparkContext._jvm, "org.apache.spark.ml"
    estimator._transfer_params_to_java()
    instances = _only(f"{ml}.util.DatasetUtils").extractInstances(estimator._java_obj, rows._jdf, jvm.scala.Option.apply(2))
    strategy = jvm.org.apache.spark.mllib.tree.configuration.Strategy.defaultStrategy("Regression")
    strategy.setMaxBins(estimator.getMaxBins())
    metadata = jvm.org.apache.spark.ml.tree.impl.DecisionTreeMetadata.buildMetadata(instances, strategy)
    found = _only(f"{ml}.tree.impl.RandomForest").findSplits(instances, metadata, estimator.getSeed())
    return [np.array([s.threshold() for s in splits]) for splits in found]


# ------------------------------------------------------------ samples
@lru_cache(maxsize=2)
def _jumps(doublings: int) -> list[np.ndarray]:
    """Tables of the xorshift step taken 1, 2, 4, ... times (a byte of the state each)."""
    def step(x):
        x = x ^ (x << np.uint64(21))
        x = x ^ (x >> np.uint64(35))
        return x ^ (x << np.uint64(4))

    out, bits = [], step(np.uint64(1) << np.arange(64, dtype=np.uint64))
    for _ in range(doublings):
        tables = []
        for byte in bits.reshape(8, 8):
            t = np.zeros(1, np.uint64)
            for b in byte:
                t = np.concatenate([t, t ^ b])
            tables.append(t)
        out.append(np.stack(tables))
        bits = _jump(out[-1], bits)
    return out


def _jump(tables: np.ndarray, states: np.ndarray) -> np.ndarray:
    each = np.ascontiguousarray(states, "<u8").view(np.uint8).reshape(-1, 8)
    out = tables[0][each[:, 0]]
    for i in range(1, 8):
        out ^= tables[i][each[:, i]]
    return out


def _hashed_seed(seed: int) -> int:
    """Of Spark's XORShiftRandom: MurmurHash3 of the eight bytes, twice."""
    data = (seed & (2**64 - 1)).to_bytes(8, "big")

    def murmur(h: int) -> int:
        for i in (0, 4):
            k = int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
            h ^= ((k << 15 | k >> 17) & 0xFFFFFFFF) * 0x1B873593 & 0xFFFFFFFF
            h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
        h ^= 8
        h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
        h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
        return h ^ h >> 16

    low = murmur(0x3C074A61)
    return murmur(low) << 32 | low


def drawn(seed: int, n: int, rate: float) -> np.ndarray:
    """Which of ``n`` rows Spark's XORShiftRandom takes (``nextDouble() < rate``)."""
    jumps = _jumps(max(1, math.ceil(math.log2(2 * n + 1))))
    states = _jump(jumps[0], np.array([_hashed_seed(seed)], np.uint64))
    for tables in jumps:
        if len(states) < 2 * n:
            states = np.concatenate([states, _jump(tables, states)])
    high, low = states[:2 * n:2] & np.uint64(2**26 - 1), states[1:2 * n:2] & np.uint64(2**27 - 1)
    return ((high << np.uint64(27)) + low) * 2.0**-53 < rate


# ------------------------------------------------------------ trees
def _sums(bins: np.ndarray, rows, slot, nodes: int, width: int, values: list) -> list[np.ndarray]:
    """Sums of each of ``values`` (None: rows) by node, feature and bin."""
    out = [np.empty((nodes, len(bins), width)) for _ in values]
    for f, own in enumerate(bins):
        at = (own if rows is None else own[rows]).astype(np.intp)
        if slot is not None:
            at += slot
        for o, v in zip(out, values):
            o[:, f] = np.bincount(at, v, nodes * width).reshape(nodes, width)
    return out


def _variance(sums: np.ndarray) -> np.ndarray:
    weight = np.where(sums[0] == 0, 1, sums[0])
    return np.where(sums[0] == 0, 0, (sums[2] - sums[1] * sums[1] / weight) / weight)


def _best_splits(sums: np.ndarray, parents, first: int, least: float):
    """(parents, gains, features, bins, left, right) of the nodes in ``sums`` (4, nodes,
    features, bins); a node without a valid split has gain -inf."""
    left = np.cumsum(sums, axis=3)
    whole, left = left[..., -1:], left[..., :-1]
    right = whole - left
    if parents is None:
        parents = left[:, :, first, 0] + right[:, :, first, 0]
    n = left[0] + right[0]
    n = np.where(n == 0, 1, n)
    gain = _variance(parents)[:, None, None] - left[0] / n * _variance(left) - right[0] / n * _variance(right)
    gain[(left[3] < 1) | (right[3] < 1) | (gain < least)] = -np.inf
    at = gain.reshape(len(gain), -1).argmax(axis=1)
    feature, cut = np.divmod(at, gain.shape[2])
    each = np.arange(len(gain))
    return parents, gain[each, feature, cut], feature, cut, left[:, each, feature, cut], right[:, each, feature, cut]


@dataclass
class Step:
    """A level of the trees of a round: the splits of the nodes of each ensemble that were
    looked at (feature, bin), and where their children stand on the next level (left and
    right of each node, -1: nothing more to look at)."""

    feature: np.ndarray
    bin: np.ndarray
    child: np.ndarray


def _round(ask: Callable[[list], np.ndarray], g: Growth, root: np.ndarray) -> list[list[Node]]:
    """A tree for each ensemble from the sums over all rows, those of the root and those that
    ``ask`` has of the level that some steps lead to."""
    first = next((f for f, c in enumerate(g.cuts) if len(c)), 0)
    seen = sum(t is not None for t in g.targets)
    trees: list[list[Node]] = [[] for _ in range(seen)]
    live: list[list[int]] = [[0] for _ in range(seen)]      # nodes to look at
    steps: list[list[Step | None]] = []
    parents = None
    for level in range(max(1, g.depth)):
        sums = ask(steps) if steps else root
        parents, gain, feature, cut, left, right = _best_splits(sums, parents, first, g.least_gain)
        impurity, kids = _variance(parents), (_variance(left), _variance(right))
        at, following, step = 0, [], []
        for e, nodes in enumerate(live):
            tree, fresh, child = trees[e], [], np.full(2 * len(nodes), -1)
            if level == 0:
                tree.append(Node(parents[:, at], float(impurity[at])))
            for i, node in enumerate(nodes, at):
                own = tree[node]
                if not gain[i] > 0:
                    own.impurity = -1.0
                elif level < g.depth:
                    own.feature, own.bin, own.gain = int(feature[i]), int(cut[i]), float(gain[i])
                    own.left, own.right = len(tree), len(tree) + 1
                    for k, side in enumerate((left, right)):
                        tree.append(Node(side[:, i], float(kids[k][i])))
                        if level + 1 < g.depth and abs(tree[-1].impurity) >= sys.float_info.epsilon:
                            child[2 * (i - at) + k] = len(fresh)
                            fresh.append(len(tree) - 1)
                            following.append(tree[-1].sums)
            now = slice(at, at + len(nodes))
            step.append(Step(feature[now], cut[now], child) if fresh else None)
            live[e], at = fresh, at + len(nodes)
        if not following:
            break
        steps.append(step)
        parents = np.stack(following, axis=1)
    return [_pruned(t) for t in trees]


def _pruned(tree: list[Node]) -> list[Node]:
    """Leaves side by side that say the same become one."""
    for node in reversed(tree):
        if node.left >= 0:
            a, b = tree[node.left], tree[node.right]
            if a.left < 0 and b.left < 0 and a.value == b.value:
                node.left = node.right = -1
    return tree


def _plain(tree: list[Node]) -> list[tuple]:
    return [(n.feature, n.bin, n.left, n.right, n.value) for n in tree]


def _add(tree: list[tuple], bins: np.ndarray, margin: np.ndarray, scale: float) -> None:
    stack = [(0, None)]
    while stack:
        i, rows = stack.pop()
        feature, cut, left, right, value = tree[i]
        if left < 0:
            margin[slice(None) if rows is None else rows] += value * scale
            continue
        goes = (bins[feature] if rows is None else bins[feature][rows]) <= cut
        for child, side in ((left, goes), (right, ~goes)):
            stack.append((child, np.flatnonzero(side) if rows is None else rows[side]))


def _loss(margins: list, y: np.ndarray, g: Growth) -> float:
    probs = [np.zeros(len(y)) if m is None else 1 / (1 + np.exp(-2 * m)) for m in margins]
    if g.joint:
        whole, inside = np.sum(probs, axis=0), (y >= 0) & (y < len(probs))
        own = np.stack(probs)[np.where(inside, y, 0), np.arange(len(y))] * inside
        p = np.where(whole > 0, own / np.where(whole > 0, whole, 1), 1 / len(probs))
    else:
        p = np.where(y == 1, probs[0], 1 - probs[0])
    return float(-np.log(np.clip(p, LOGLOSS_EPS, 1)).sum())


# ------------------------------------------------------------ rows
def _read(batches: Iterator[pa.RecordBatch], cuts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Bins and labels of the training and of the validation rows of a partition, in one row."""
    size = np.min_scalar_type(max(len(c) for c in cuts))
    parts = [([np.empty((len(cuts), 0), size)], [np.empty(0, np.int64)]) for _ in range(2)]
    for b in batches:
        x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(cuts))
        bins = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)]).astype(size)
        y, val = b.column(1).fill_null(-1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False)
        for (some, labels), mine in zip(parts, (~val, val)):
            some.append(bins[:, mine])
            labels.append(y[mine])
    whole = pickle.dumps([(np.concatenate(some, axis=1), np.concatenate(labels)) for some, labels in parts], 5)
    yield pa.RecordBatch.from_arrays([pa.array([whole], pa.large_binary())], names=["whole"])


class Margins:
    """Of the rows of a partition, after ``rounds`` rounds."""

    def __init__(self, part: list, g: Growth):
        (_, y), (_, truth) = part
        self.rounds = 0
        self.train = [np.zeros(len(y)) for t in g.targets if t is not None]
        self.shown = [None if t is None else np.zeros(len(truth)) for t in g.targets]
        self.size = sum(m.nbytes for m in [*self.train, *self.shown] if m is not None)

    def add(self, part: list, trees: list, g: Growth) -> None:
        scale = 1.0 if self.rounds == 0 else g.step
        for margins, (bins, _) in zip((self.train, [m for m in self.shown if m is not None]), part):
            for tree, margin in zip(trees, margins):
                _add(tree, bins, margin, scale)
        self.rounds += 1


class Sample:
    """The rows that a round takes of a partition, and the nodes they are in."""

    def __init__(self, part: list, margins: Margins, index: int, g: Growth):
        (bins, y), _ = part
        self.bins, rows = bins, slice(None)
        if g.subsample < 1:
            rows = np.flatnonzero(drawn(g.seed + margins.rounds + index + 1, len(y), g.subsample))
            self.bins = bins[:, rows]
        self.width, self.residuals = max(2, max(len(c) for c in g.cuts) + 1), []
        self.round = margins.rounds
        for t, margin in zip((t for t in g.targets if t is not None), margins.train):
            s = np.where(y[rows] == t, 1.0, -1.0)
            r = s if margins.rounds == 0 else 4.0 * s / (1.0 + np.exp(2.0 * s * margin[rows]))
            w = None if g.weight == 1.0 else np.where(s > 0, g.weight, 1.0)
            self.residuals.append((w, r))
        # rows of each ensemble in nodes to look at, their nodes, the number of these
        self.live: list = [(None, None, 1)] * len(self.residuals)
        self.level = 0

    @property
    def size(self) -> int:
        arrays = [*(v for each in self.residuals for v in each), *(v for live in self.live for v in live[:2])]
        return self.bins.nbytes + sum(v.nbytes for v in arrays if v is not None)

    def go(self, steps: list) -> None:
        """To the level that ``steps`` lead to."""
        for step in steps[self.level:]:
            self.live = [self._kids(s, *live) for s, live in zip(step, self.live)]
            self.level += 1

    def _kids(self, s: Step | None, rows, slot, _):
        if s is None:
            return None, None, 0
        if rows is None:
            goes = s.child[(self.bins[s.feature[0]] > s.bin[0]).astype(np.intp)]
            rows = np.flatnonzero(goes >= 0)
            return rows, goes[rows], int(s.child.max()) + 1
        goes = s.child[2 * slot + (self.bins[s.feature[slot], rows] > s.bin[slot])]
        return rows[goes >= 0], goes[goes >= 0], int(s.child.max()) + 1

    def sums(self) -> np.ndarray:
        """Weights, first and second moments and rows by node, feature and bin: (4, nodes, ...)."""
        def moments(w, r) -> list:
            return [r, r * r, None] if w is None else [w * r, w * r * r, None, w]

        if self.level == 0:                                    # the same rows for all: they are counted once
            each = [moments(w, r) for w, r in self.residuals]
            count, *rest = _sums(self.bins, None, None, 1, self.width, [None, *(v for m in each for v in m if v is not None)])
            rest = iter(rest)
            found = [[count if v is None else next(rest) for v in m] for m in each]
        else:
            found = [_sums(self.bins, rows, slot * self.width, nodes, self.width, moments(None if w is None else w[rows], r[rows]))
                     for (w, r), (rows, slot, nodes) in zip(self.residuals, self.live) if nodes]
        # without weights these are the rows
        return np.stack([np.concatenate([f[i] for f in found]) for i in (-1, 0, 1, 2)])


class Kept:
    """What was used last, up to so many bytes."""

    def __init__(self, most: int):
        self.most, self.values = most, OrderedDict()

    def get(self, key):
        return self.values.get(key)

    def keep(self, key, value) -> None:
        self.values[key] = value
        self.values.move_to_end(key)
        while len(self.values) > 1 and sum(v.size for v in self.values.values()) > self.most:
            self.values.popitem(last=False)


#: Of this process, by (fit, partition).
_MARGINS, _SAMPLES = Kept(KEPT[0]), Kept(KEPT[1])


def _level(fit: str, index: int, part: list, g: Growth, done: int, trees: Callable[[int], list], steps: list) -> tuple:
    """(sums, loss of the last round, validation rows) of a partition, after ``done`` rounds
    and some steps of the next one."""
    margins = _MARGINS.get((fit, index))
    if margins is None or margins.rounds > done:
        margins = Margins(part, g)
    while margins.rounds < done:
        margins.add(part, trees(margins.rounds), g)
    _MARGINS.keep((fit, index), margins)
    sample = _SAMPLES.get((fit, index))
    if sample is None or sample.round != done or sample.level > len(steps):
        sample = Sample(part, margins, index, g)
    sample.go(steps)
    _SAMPLES.keep((fit, index), sample)
    return sample.sums(), _loss(margins.shown, part[1][1], g) if done and not steps else 0.0, len(part[1][1])


def _added(a: tuple, b: tuple) -> tuple:
    return tuple(x + y for x, y in zip(a, b))


def _rounds(ask: Callable[[list, list], tuple], g: Growth) -> tuple[list, list[float]]:
    """Trees of all rounds, and their losses, until the rule or the limit ends them."""
    rounds: list = []
    losses: list[float] = []
    while True:
        root, loss, shown = ask(rounds, [])
        if rounds:
            losses.append(loss / shown)
            if len(losses) >= g.limit or patience_stop(losses, g.patience, g.min_gain)[2]:
                return rounds, losses
        rounds.append(_round(lambda steps: ask(rounds, steps)[0], g, root))


#: Java, compiled at run time by Spark's own compiler: a tree is some 20 objects, a call
#: for each of them from Python would take longer than its fit.
_MAKE = """
DecisionTreeRegressionModel[] out = new DecisionTreeRegressionModel[trees];
for (int t = 0; t < trees; t++) {
    int n = (int) data.getDouble();
    int at = data.position();
    Node[] made = new Node[n];
    for (int i = n - 1; i >= 0; i--) {  // children come after their parents
        data.position(at + i * 88);
        double value = data.getDouble(), impurity = data.getDouble(), gain = data.getDouble();
        int feature = (int) data.getDouble(), left = (int) data.getDouble(), right = (int) data.getDouble();
        double cut = data.getDouble();
        double[] sums = new double[] {data.getDouble(), data.getDouble(), data.getDouble()};
        VarianceCalculator stats = new VarianceCalculator(sums, (long) data.getDouble());
        if (left < 0) made[i] = new LeafNode(value, impurity, stats);
        else made[i] = new InternalNode(value, impurity, gain, made[left], made[right], new ContinuousSplit(feature, cut), stats);
    }
    data.position(at + n * 88);
    out[t] = new DecisionTreeRegressionModel(made[0], features);
}
return out;
"""


def _model(trees: list[list[Node]], g: Growth, estimator: GBTClassifier) -> GBTClassificationModel:
    """MLlib's model of these trees."""
    gateway, jvm = SparkContext._gateway, SparkContext._jvm
    ml = "org.apache.spark.ml"

    def array(kind, values):
        out = gateway.new_array(kind, len(values))
        for i, v in enumerate(values):
            out[i] = v
        return out

    def loaded(name: str):
        return jvm.org.apache.spark.util.Utils.classForName(name, True, False)

    script = jvm.org.codehaus.janino.ScriptEvaluator()
    script.setParentClassLoader(loaded(f"{ml}.tree.Node").getClassLoader())
    script.setDefaultImports(array(jvm.String, [f"{ml}.tree.*", f"{ml}.regression.DecisionTreeRegressionModel",
                                                "org.apache.spark.mllib.tree.impurity.VarianceCalculator"]))
    script.setReturnType(loaded(f"[L{ml}.regression.DecisionTreeRegressionModel;"))
    number = jvm.java.lang.Integer.TYPE
    script.setParameters(array(jvm.String, ["data", "trees", "features"]), array(jvm.Class, [loaded("java.nio.ByteBuffer"), number, number]))
    script.cook(_MAKE)
    data: list = []
    for tree in trees:
        data.append(len(tree))
        for n in tree:
            data += [n.value, n.impurity, n.gain, n.feature, n.left, n.right, g.cuts[n.feature][n.bin] if n.left >= 0 else 0.0, *n.sums]
    wrapped = jvm.java.nio.ByteBuffer.wrap(np.array(data, ">f8").tobytes())
    made = script.evaluate(array(jvm.Object, [wrapped, len(trees), len(g.cuts)]))
    scale = array(jvm.double, [1.0] + [g.step] * (len(trees) - 1))
    return estimator._copyValues(GBTClassificationModel(
        jvm.org.apache.spark.ml.classification.GBTClassificationModel(estimator.uid, made, scale, len(g.cuts), 2)))


def _bytes(g: Growth, steps: list) -> int:
    """Of the histograms of a partition."""
    nodes = sum(int(s.child.max()) + 1 for s in steps[-1] if s is not None) if steps else sum(t is not None for t in g.targets)
    return 32 * nodes * len(g.cuts) * (max(len(c) for c in g.cuts) + 1)


def grown(vectors: DataFrame, rows: DataFrame, partitions: int, estimator: GBTClassifier, targets: list[int | None], *,
          joint: bool, weight: float, limit: int, patience: int, min_gain: float) -> tuple[list, Rounds]:
    """Ensembles cut back to their best round (None for a label never seen), and how they ended.

    ``vectors``: features, _label and _val (validation rows); ``rows``: the training
    rows as ``estimator`` reads them, which has the other rules.
    """
    spark = ship_package(vectors.sparkSession)
    if limit < 1:
        raise ValueError("max_iter must be 1 at least")
    g = Growth(split_candidates(rows, estimator), targets, joint, weight, estimator.getStepSize(), estimator.getMaxDepth(),
               estimator.getMinInfoGain(), estimator.getSubsamplingRate(), estimator.getSeed(), limit, patience, min_gain)
    context, fit = spark.sparkContext, uuid.uuid4().hex
    own = context.broadcast(g)
    dealt = vectors.select(vector_to_array("features").alias("x"), F.col("_label").cast("long").alias("y"), "_val").repartition(partitions)
    whole = dealt.mapInArrow(lambda b: _read(b, own.value.cuts), "whole binary").rdd.map(lambda r: bytes(r[0]))
    old: list = []
    try:
        if partitions == 1:
            def alone(index: int, parts: Iterator[bytes]) -> Iterator[tuple]:
                g = own.value
                for part in map(pickle.loads, parts):
                    plain: list = []

                    def ask(rounds: list, steps: list):
                        plain.extend([_plain(t) for t in trees] for trees in rounds[len(plain):])
                        return _level(fit, index, part, g, len(rounds), plain.__getitem__, steps)

                    yield _rounds(ask, g)

            (rounds, losses), = whole.mapPartitionsWithIndex(alone).collect()
        else:
            whole.persist(StorageLevel.MEMORY_AND_DISK)
            recent: list = []

            def ask(rounds: list, steps: list):
                recent.extend([_plain(t) for t in trees] for trees in rounds[len(recent) + RECENT * len(old):])
                if len(recent) > RECENT:
                    old.append(context.broadcast(recent[:RECENT]))
                    del recent[:RECENT]
                done, before, now = len(rounds), list(old), list(recent)

                def trees(r: int) -> list:
                    return before[r // RECENT].value[r % RECENT] if r < RECENT * len(before) else now[r - RECENT * len(before)]

                each = whole.mapPartitionsWithIndex(
                    lambda index, parts: [_level(fit, index, pickle.loads(p), own.value, done, trees, steps) for p in parts])
                if partitions * _bytes(g, steps) > COLLECTED:
                    return each.treeReduce(_added)
                return reduce(_added, each.collect())

            rounds, losses = _rounds(ask, g)
    finally:
        whole.unpersist()
        for b in (own, *old):
            b.unpersist()
    best, tried, stopped = patience_stop(losses, patience, min_gain)
    each = iter(zip(*rounds[:best]))
    models = [None if t is None else _model(next(each), g, estimator) for t in targets]
    return models, Rounds(losses, best, tried, stopped, limit, patience)

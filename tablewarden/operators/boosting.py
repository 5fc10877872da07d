"""Boosted trees from gradient and Hessian histograms, for 0/1 labels and log loss.

Features are binned once (all distinct values of a feature with few, else quantiles) and stored in the shared folder as
blocks of bin numbers. A round sums, in one Spark job per step, gradients p - y, Hessians p (1 - p) and rows
per node, feature and bin: every partition adds its blocks' histograms and only sums travel. A split has the gain

    G_l^2 / (H_l + ridge) + G_r^2 / (H_r + ridge) - G^2 / (H + ridge),  halved,

and a leaf the Newton step -G / (H + ridge). Of two children only the smaller one is summed; the other is its
parent less that one. Trees grow level by level (a job per level), or leaf by leaf: then a priority queue splits
the leaf with the largest gain next, until the tree has its leaves. For these the children of all waiting leaves are summed
together, so a tree takes about as many jobs as it has levels.

The driver holds histograms of the open nodes, of a size set by features, bins and leaves and checked against
``HISTOGRAM_BYTES``. Bins of zeros are not added up: they are what a node's sum leaves over. Features of few bins are added
up together (:class:`Joint`), so columns of indicators cost little. Margins are kept with the blocks and brought up to date every ``KEEP_EVERY`` trees; between, a worker
remembers those of the blocks that it met. A lost block is read again and gets its margin from the trees. A table
that fills one partition only (``PART_ROWS`` rows) has no sums to exchange, so there the task that holds it grows
``KEEP_EVERY`` trees in turn, by the same steps; larger ones are dealt over all cores. (Here, jobs of a few milliseconds
over blocks of arrays, hundreds to thousands of them, are RDD jobs: planning a query for each would take longer than
running it.)

Null features are not allowed, NaN counts as larger than all numbers. Gains that differ by less than a
billionth count as equal; of equal ones the first feature, then the lower threshold wins.
"""

from __future__ import annotations

import heapq
import pickle
from collections import OrderedDict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.session import materialize

HISTOGRAM_BYTES = 1 << 30
KEEP_EVERY = 10
PART_ROWS = 1 << 19  # rows of a task, 150 bytes each with 80 features; fewer where cores would stay idle, but not for smaller tables
_LEAST_ROWS = 1 << 13
_REMEMBERED = 1 << 26  # bytes of margins in a worker
JOINT = 1 << 10  # values of a joint code; fewer for tables of few rows
_LEAST_JOINT = 1 << 5
_CHUNK_ROWS = 1 << 17  # rows that are added up at once
_FEW_PARTS = 16
_SAME = 1e-9


@dataclass(frozen=True)
class BoostParams:
    """``leaves`` is None for growth by levels; ``prior`` starts at the log-odds of the labels instead of 0.

    With ``first_order`` splits are chosen by gradients alone, G^2 / rows (the fall in their squared error), and
    leaves stay Newton steps.
    """

    rounds: int = 200
    rate: float = 0.1
    depth: int = 7
    leaves: int | None = None
    bins: int = 256
    ridge: float = 1.0
    min_hessian: float = 1.0
    min_rows: int = 1
    prior: bool = False
    first_order: bool = False


@dataclass
class Tree:
    """Nodes as lists; a node without a feature (-1) is a leaf. Rows with a bin of the feature up to ``code`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    code: list[int] = field(default_factory=lambda: [0])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    value: list[float] = field(default_factory=lambda: [0.0])
    rows: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, code: int, threshold: float, gain: float) -> tuple[int, int]:
        at = len(self.feature)
        self.feature[node], self.code[node], self.threshold[node], self.gain[node] = feature, code, threshold, gain
        self.left[node], self.right[node] = at, at + 1
        for name, empty in (("feature", -1), ("code", 0), ("threshold", 0.0), ("left", 0), ("right", 0), ("gain", 0.0), ("value", 0.0), ("rows", 0)):
            getattr(self, name).extend([empty, empty])
        return at, at + 1

    def paths(self) -> list[str]:
        out = [""] * len(self.feature)
        for node, feature in enumerate(self.feature):  # children come after their parent
            if feature >= 0:
                out[self.left[node]], out[self.right[node]] = out[node] + "L", out[node] + "R"
        return out

    def _walk(self, x: np.ndarray, cut: Sequence) -> np.ndarray:
        feature, cut, here = np.array(self.feature), np.array(cut), np.arange(len(self.feature))
        inner = feature >= 0
        feature = np.where(inner, feature, 0)
        # A node's children side by side, the right one first; a leaf is its own child.
        child = np.stack([np.where(inner, self.right, here), np.where(inner, self.left, here)], axis=1).ravel()
        flat, first = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(max(map(len, self.paths()))):
            node = child[2 * node + (flat[first + feature[node]] <= cut[node])]
        return node

    def leaf_of_codes(self, codes: np.ndarray) -> np.ndarray:
        return self._walk(codes, self.code)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, self.threshold)


def bin_edges(arrays: DataFrame, d: int, bins: int) -> list[np.ndarray]:
    """Upper bounds of the bins of each feature of ``features`` (an array column); the last one is the maximum.

    Distinct values are counted inside the tasks, up to ``bins`` of a feature; only features with more are ranked.
    """
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: list[np.ndarray | None] = [np.zeros(0)] * d
        for batch in batches:
            x = batch.column("features").flatten().to_numpy().reshape(batch.num_rows, -1)
            for f, own in enumerate(met):
                if own is not None:
                    own = np.unique(np.concatenate([own, x[:, f]]))
                    own = own[~np.isnan(own)] + 0.0  # no negative zeros
                    met[f] = own if len(own) <= bins else None
        yield pa.RecordBatch.from_pydict({
            "f": pa.array(range(d), pa.int32()), "v": pa.array(met, pa.list_(pa.float64()))})

    each = arrays.select("features").mapInArrow(distinct, "f int, v array<double>")
    listed = each.groupBy("f").agg(
        F.array_distinct(F.flatten(F.collect_list("v"))).alias("v"), F.count_if(F.col("v").isNull()).alias("over"))
    known = {r["f"]: np.unique(r["v"]) for r in listed.where((F.col("over") == 0) & (F.size("v") <= bins)).collect()}
    edges = {f: v for f, v in known.items() if len(v)}
    many = [f for f in range(d) if f not in known] if known or not arrays.isEmpty() else []
    if many:
        marks = [i / bins for i in range(1, bins + 1)]
        value = [F.get("features", F.lit(f)) for f in many]
        ranked = arrays.agg(*[
            F.percentile_approx(F.when(~F.isnan(v), v), marks, 10_000).alias(f"q{f}") for f, v in zip(many, value, strict=True)]).first()
        edges |= {f: np.unique(ranked[f"q{f}"]) for f in many}
    return [edges.get(f, np.zeros(1)) for f in range(d)]


@dataclass(frozen=True)
class Binned:
    """Blocks in the shared folder: (bin of each feature, cells, cells of each row, label).

    Cells number all bins of all features through; a row has one for each feature whose bin is not that of zero.
    """

    blocks: DataFrame
    edges: list[np.ndarray]
    offsets: np.ndarray

    @classmethod
    def of(cls, train: DataFrame, features: str, label: str, bins: int, deal: bool = True) -> Binned:
        """Without ``deal`` the blocks stay in the partitions in which they are stored."""
        arrays = train.select(vector_to_array(features).alias("features"), F.col(label).cast("double").alias("label"))
        first = arrays.first()
        edges = bin_edges(arrays, len(first["features"]) if first else 0, bins)
        offsets = np.concatenate([[0], np.cumsum([len(e) for e in edges])]).astype(np.int64)
        zeros = _zeros(edges)
        small, number = (np.min_scalar_type(int(n)) for n in (max(map(len, edges), default=1) - 1, offsets[-1]))

        def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = batch.column("features").flatten().to_numpy().reshape(batch.num_rows, -1)
                    codes = np.empty(x.shape, dtype=small)
                    for f, e in enumerate(edges):
                        codes[:, f] = np.minimum(np.searchsorted(e, x[:, f]), len(e) - 1)
                    y = batch.column("label").to_numpy()
                    for at in range(0, len(y), _LEAST_ROWS):
                        part = codes[at : at + _LEAST_ROWS]
                        met = part != zeros
                        cells = (part + offsets[:-1])[met].astype(number)
                        made = (part, cells, met.sum(axis=1).astype(np.int32), y[at : at + _LEAST_ROWS])
                        yield pa.RecordBatch.from_pydict({"block": [pickle.dumps(made)]})

        blocks = materialize(arrays.mapInArrow(block, "block binary"), "binned")
        if not deal:
            return cls(blocks, edges, offsets)
        rows = arrays.count()
        if rows <= PART_ROWS:
            return cls(blocks.coalesce(1), edges, offsets)
        cores = train.sparkSession.sparkContext.defaultParallelism
        return cls(blocks.repartition(max(-(-rows // PART_ROWS), min(cores, -(-rows // _LEAST_ROWS)))), edges, offsets)


def _zeros(edges: list[np.ndarray]) -> np.ndarray:
    """The bin of zero in each feature."""
    return np.array([min(np.searchsorted(e, 0.0), len(e) - 1) for e in edges], dtype=np.int64)


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-margin))


@dataclass(frozen=True)
class Joint:
    """Groups of features whose bins are added up together, as one code of few values.

    Features that are never away from zero in the same row, such as the columns of one category, share the digits of a
    number; several such numbers make a code of up to ``JOINT`` values. A feature's own sums are marginal sums of its group's.
    """

    values: list[int]  # per group
    places: list[list[tuple[int, int, list[int]]]]  # per group and number: its place value, its digits, its features
    group: np.ndarray  # of each feature, -1 for constant ones
    codes: list[np.ndarray]  # per feature: what each bin adds to the group's code
    bins: list[np.ndarray]  # per feature: its bin for each of the group's codes

    @classmethod
    def of(cls, widths: Sequence[int], zeros: np.ndarray, together: np.ndarray, most: int) -> Joint:
        """``together`` counts rows in which two features are both away from zero."""
        numbers: list[list] = []  # digits, features
        for f in np.flatnonzero(np.asarray(widths) > 1).tolist():
            fit = next((x for x in numbers if x[0] + widths[f] - 1 <= most // 4 and not together[f, x[1]].any()), None)
            if fit is None:
                numbers.append([widths[f], [f]])
            else:
                fit[0] += widths[f] - 1
                fit[1].append(f)
        groups: list[list] = []  # values, numbers
        for digits, features in sorted(numbers, key=lambda x: -x[0]):
            fit = next((x for x in groups if x[0] * digits <= most), None)
            if fit is None:
                groups.append(fit := [1, []])
            fit[1].append((fit[0], digits, features))
            fit[0] *= digits
        group, codes = np.full(len(widths), -1), [np.zeros(w, np.int64) for w in widths]
        bins = [np.zeros(1, np.int64) for _ in widths]
        for g, (values, inside) in enumerate(groups):
            for place, digits, features in inside:
                digit, number = 1, np.arange(values) // place % digits
                for f in features:
                    group[f] = g
                    others = np.delete(np.arange(widths[f]), zeros[f])
                    codes[f][others] = (digit + np.arange(len(others))) * place
                    of_number = np.full(digits, zeros[f])
                    of_number[digit : digit + len(others)] = others
                    bins[f] = of_number[number]
                    digit += len(others)
        return cls([x[0] for x in groups], [x[1] for x in groups], group, codes, bins)

    def coded(self, bins: np.ndarray) -> np.ndarray:
        """(group, row): the codes of rows."""
        out = np.zeros((len(self.values), len(bins)), np.min_scalar_type(max(self.values, default=1) - 1))
        for f, g in enumerate(self.group):
            if g >= 0:
                out[g] += self.codes[f].astype(out.dtype)[bins[:, f]]
        return out

    def leaf_of(self, tree: Tree, groups: np.ndarray, node: np.ndarray | None = None, below: int | None = None) -> np.ndarray:
        """The leaf of each row, from a ``node`` on its way there; or the last node of its way with a number below ``below``."""
        n, most = groups.shape[1] if len(groups) else 0, max(self.values, default=1)
        feature, left, right = np.array(tree.feature), np.array(tree.left), np.array(tree.right)
        inner = (feature >= 0) & (right < (below or len(feature)))
        child = np.zeros((len(feature), most), np.min_scalar_type(len(feature)))
        for i in np.flatnonzero(inner):
            own = self.bins[feature[i]]
            child[i, : len(own)] = np.where(own <= tree.code[i], left[i], right[i])
        first, child, flat = np.where(inner, self.group[feature], 0) * n, child.ravel(), groups.ravel()
        node = np.zeros(n, np.int64) if node is None else node
        while len(rows := np.flatnonzero(inner[node])):
            if len(rows) == n:
                node = child[node * most + flat[first[node] + np.arange(n)]].astype(np.int64)
            else:
                at, node = node[rows], node.copy()
                node[rows] = child[at * most + flat[first[at] + rows]]
        return node

    def apart(self, sums: Sequence[np.ndarray], into: np.ndarray, offsets: np.ndarray) -> None:
        """Set the sums of the features' bins, but those of zeros, from the groups' (..., code)."""
        for own, values, inside in zip(sums, self.values, self.places, strict=True):
            for place, digits, features in inside:
                number = own.reshape(*own.shape[:-1], values // (place * digits), digits, place).sum(axis=(-3, -1))
                for f in features:
                    others = np.flatnonzero(self.codes[f])
                    into[..., offsets[f] + others] = number[..., self.codes[f][others] // place]


def _together(codes: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    away = (codes != zeros).astype(np.float32)
    return (away.T @ away).astype(np.float64)  # blocks have too few rows for rounding


def _chunks(blocks: Iterable[tuple], joint: Joint, start: float) -> Iterator[tuple]:
    """((joint codes, labels), margins) of a partition, in blocks of many rows."""
    def joined(held: list[tuple]) -> tuple:
        y = np.concatenate([b[-1] for b in held])
        short = y.astype(np.int8)
        return (np.hstack([joint.coded(b[0]) for b in held]), short if (short == y).all() else y), np.full(len(y), start)

    held: list[tuple] = []
    for block in blocks:
        held.append(block)
        if sum(len(b[-1]) for b in held) >= _CHUNK_ROWS:
            yield joined(held)
            held = []
    if held:
        yield joined(held)


def _sums(
    blocks: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], nodes: int, wanted: Sequence[int], joint: Joint,
    offsets: np.ndarray, zeros: np.ndarray,
) -> np.ndarray:
    """([gradient, Hessian, rows], wanted node, bin) of blocks of (joint codes, leaf, gradient, Hessian) of rows."""
    slot = np.full(nodes, -1)
    slot[list(wanted)] = np.arange(n := len(wanted))
    sums, of_node = [np.zeros((3, n * v)) for v in joint.values], np.zeros((3, n))
    for groups, leaf, *slopes in blocks:
        own = slot[leaf]
        held = np.flatnonzero(own >= 0)
        every = len(held) == len(own)
        own, weights = (own, (*slopes, None)) if every else (own[held], (*(w[held] for w in slopes), None))
        for k, w in enumerate(weights):
            of_node[k] += np.bincount(own, w, n)
        for total, values, code in zip(sums, joint.values, groups, strict=True):
            at = own * values + (code if every else code[held])
            for k, w in enumerate(weights):
                total[k] += np.bincount(at, w, n * values)
    out = np.zeros((3, n, int(offsets[-1])))
    joint.apart([x.reshape(3, n, -1) for x in sums], out, offsets)
    out[:, :, offsets[:-1] + zeros] = of_node[:, :, None] - np.add.reduceat(out, offsets[:-1], axis=2)
    return out


def _slopes(y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and Hessians."""
    p = _sigmoid(margin)
    return p - y, p * (1 - p)


class _Rows:
    """The blocks with their margins, and the sums over them."""

    def __init__(self, binned: Binned, start: float):
        self.offsets, self.zeros = binned.offsets, (zeros := _zeros(binned.edges))
        parsed = binned.blocks.rdd.map(lambda r: pickle.loads(r["block"]))
        together, rows = parsed.map(lambda b: (_together(b[0], zeros), len(b[-1]))).treeReduce(
            lambda a, b: (a[0] + b[0], a[1] + b[1]))
        self.joint = joint = Joint.of([len(e) for e in binned.edges], zeros, together, max(_LEAST_JOINT, min(JOINT, rows // 16)))
        self.kept = parsed.mapPartitions(lambda blocks: _chunks(blocks, joint, start)).persist(StorageLevel.MEMORY_AND_DISK)
        self.parts = self.kept.getNumPartitions()
        self.recent: list[Tree] = []

    def add(self, trees: Sequence[Tree]) -> None:
        self.recent = [*self.recent, *trees]
        if len(self.recent) >= KEEP_EVERY:
            recent, before, joint = self.recent, self.kept, self.joint
            of = before.id()
            self.kept = before.mapPartitions(lambda blocks: _caught_up(of, blocks, recent, joint)).persist(StorageLevel.MEMORY_AND_DISK)
            self.kept.count()
            before.unpersist()
            self.recent = []

    def histograms(self, tree: Tree, wanted: Sequence[int], sure: int) -> np.ndarray:
        """(node, bin, [gradient, Hessian, rows]) of the wanted nodes; one Spark job. The first ``sure`` nodes will stay."""
        recent, joint, offsets, zeros, of = self.recent, self.joint, self.offsets, self.zeros, self.kept.id()
        # A few partitions are added up by the driver, more of them by tasks first.
        depth = 1 if self.parts <= _FEW_PARTS else 2
        total = self.kept.mapPartitions(lambda blocks: [_sums((
            (groups, joint.leaf_of(tree, groups), *_slopes(y, margin)) for (groups, y), margin in _caught_up(of, blocks, recent, joint)
        ), len(tree.feature), wanted, joint, offsets, zeros)]).treeReduce(np.add, depth)
        return total.transpose(1, 2, 0)

    def grown_in_place(self, grower: Grower, rounds: int) -> list[Tree]:
        """The next trees, where all blocks are in one partition: no sums have to leave it between them."""
        joint, offsets, zeros = self.joint, self.offsets, self.zeros
        return self.kept.mapPartitions(lambda blocks: [_Here(list(blocks), joint, offsets, zeros).grown(grower, rounds)]).collect()[0]

    def done(self) -> None:
        self.kept.unpersist()


class _Here:
    """The blocks of a task, for trees that need no others."""

    def __init__(self, blocks: list[tuple], joint: Joint, offsets: np.ndarray, zeros: np.ndarray):
        self.blocks, self.joint, self.offsets, self.zeros = blocks, joint, offsets, zeros

    def histograms(self, tree: Tree, wanted: Sequence[int], sure: int) -> np.ndarray:
        # Rows go on from the node where they were left, among those that stay.
        leaf_of = self.joint.leaf_of
        self.node = [leaf_of(tree, b[0], at, sure) for (b, _), at in zip(self.blocks, self.node, strict=True)]
        leaves = [leaf_of(tree, b[0], at) for (b, _), at in zip(self.blocks, self.node, strict=True)]
        blocks = ((b[0], leaf, *s) for (b, _), leaf, s in zip(self.blocks, leaves, self.slopes, strict=True))
        return _sums(blocks, len(tree.feature), wanted, self.joint, self.offsets, self.zeros).transpose(1, 2, 0)

    def grown(self, grower: Grower, rounds: int) -> list[Tree]:
        trees = []
        for _ in range(rounds):
            self.node = [np.zeros(len(margin), np.int64) for _, margin in self.blocks]
            self.slopes = [_slopes(b[1], margin) for b, margin in self.blocks]
            trees.append(tree := grower.grow(self))
            value = np.array(tree.value)
            self.blocks = [
                (b, margin + value[self.joint.leaf_of(tree, b[0], at)]) for (b, margin), at in zip(self.blocks, self.node, strict=True)]
        return trees


def _margin(block: tuple, margin: np.ndarray, trees: Sequence[Tree], joint: Joint | None) -> np.ndarray:
    for tree in trees:
        margin = margin + np.array(tree.value)[joint.leaf_of(tree, block[0]) if joint else tree.leaf_of_codes(block[0])]
    return margin


# Per process: margins after some of the recent trees, by stored table, partition and block; what was used last comes last.
_MET: OrderedDict[tuple, tuple[int, np.ndarray]] = OrderedDict()


def _caught_up(of: int, blocks: Iterable[tuple], recent: Sequence[Tree], joint: Joint | None = None) -> Iterator[tuple]:
    """The blocks of a partition of table ``of``, their margins brought up to date with the recent trees.

    With ``joint`` blocks hold joint codes, else bins.
    """
    part = TaskContext.get().partitionId()
    for n, (block, margin) in enumerate(blocks):
        done, margin = _MET.pop((of, part, n), (0, margin))
        margin = _margin(block, margin, recent[done:], joint)
        if recent:
            _MET[of, part, n] = (len(recent), margin)
            while sum(m.nbytes for _, m in _MET.values()) > _REMEMBERED:
                _MET.popitem(last=False)
        yield block, margin


@dataclass(order=True)
class _Leaf:
    """A node that may be split; the queue's order is the largest gain, then the oldest node."""

    rank: tuple
    node: int = field(compare=False)
    depth: int = field(compare=False)
    sums: np.ndarray = field(compare=False)
    hist: np.ndarray = field(compare=False)
    split: tuple = field(compare=False)  # feature, code, gain, sums of the left child
    below: tuple | None = field(compare=False, default=None)  # histograms of the children


class Grower:
    """Trees on binned rows."""

    def __init__(self, edges: list[np.ndarray], offsets: np.ndarray, params: BoostParams):
        self.edges, self.offsets, self.params = edges, offsets, params
        nodes = params.leaves or 2**params.depth
        needed = 2 * nodes * int(offsets[-1]) * 24
        if needed > HISTOGRAM_BYTES:
            raise ValueError(f"histograms of {nodes} nodes need {needed} bytes: use fewer bins, features, levels or leaves")

    def best_split(self, hist: np.ndarray, sums: np.ndarray) -> tuple | None:
        """(feature, code, gain, sums of the left child), or None if no split is allowed to gain."""
        p, offsets = self.params, self.offsets
        running = np.cumsum(hist, axis=0)
        before = np.concatenate([np.zeros((1, 3)), running])[offsets[:-1]]
        left = running - np.repeat(before, np.diff(offsets), axis=0)
        right = sums - left

        def score(s: np.ndarray) -> np.ndarray:
            return s[..., 0] ** 2 / (s[..., 2] if p.first_order else s[..., 1] + p.ridge)

        with np.errstate(all="ignore"):
            gain = (score(left) + score(right) - score(sums)) / 2
        allowed = (np.minimum(left[:, 1], right[:, 1]) >= p.min_hessian) & (np.minimum(left[:, 2], right[:, 2]) >= p.min_rows)
        allowed[offsets[1:] - 1] = False  # all rows left
        gain = np.where(allowed & np.isfinite(gain), gain, -np.inf)
        most = gain.max() if len(gain) else -np.inf
        if not most > _SAME:
            return None
        code = int(np.argmax(gain >= most * (1 - _SAME)))
        return int(np.searchsorted(offsets, code, side="right")) - 1, code, float(gain[code]), left[code]

    def _leaf(self, node: int, depth: int, sums: np.ndarray, hist: np.ndarray) -> _Leaf | None:
        split = self.best_split(hist, sums) if depth < self.params.depth else None
        return _Leaf((-split[2], node), node, depth, sums, hist, split) if split else None

    def _apply(self, tree: Tree, leaf: _Leaf, node: int) -> tuple[int, int]:
        feature, code, gain, _ = leaf.split
        own = int(code - self.offsets[feature])
        return tree.split(node, feature, own, float(self.edges[feature][own]), gain)

    def _value(self, tree: Tree, node: int, sums: np.ndarray) -> None:
        tree.value[node] = float(-self.params.rate * sums[0] / (sums[1] + self.params.ridge)) if sums[2] else 0.0
        tree.rows[node] = round(sums[2])

    def _sum_below(self, rows: _Rows | _Here, tree: Tree, leaves: Sequence[_Leaf]) -> None:
        """The children's histograms of several leaves in one job, as if all of them were split."""
        trial, wanted = pickle.loads(pickle.dumps(tree)), []
        for leaf in leaves:
            children = self._apply(trial, leaf, leaf.node)
            wanted.append(children[int(leaf.split[3][2] * 2 > leaf.sums[2])])  # the smaller one
        # Level by level the tree takes these very splits, in this order.
        sure = len((trial if self.params.leaves is None else tree).feature)
        for leaf, node, hist in zip(leaves, wanted, rows.histograms(trial, wanted, sure), strict=True):
            other = leaf.hist - hist
            leaf.below = (hist, other) if node == trial.left[leaf.node] else (other, hist)

    def grow(self, rows: _Rows | _Here) -> Tree:
        """One tree for the margins of ``rows``."""
        p, tree = self.params, Tree()
        hist = rows.histograms(tree, [0], 1)[0]
        sums = hist[: self.offsets[1]].sum(axis=0)
        self._value(tree, 0, sums)
        root = self._leaf(0, 0, sums, hist)
        queue, leaves = [root] if root else [], 1
        most = p.leaves or 2**p.depth
        while queue and leaves < most:
            if p.leaves is None:  # the whole level
                chosen, queue = sorted(queue, key=lambda x: x.node), []
            else:
                chosen = [heapq.heappop(queue)]
            deeper = [x for x in (*chosen, *queue) if x.below is None and x.depth + 1 < p.depth]
            if any(x.below is None and x.depth + 1 < p.depth for x in chosen) and leaves + 1 < most:
                self._sum_below(rows, tree, deeper)
            for leaf in chosen:
                children = self._apply(tree, leaf, leaf.node)
                leaves += 1
                left = leaf.split[3]
                for node, own, hist in zip(children, (left, leaf.sums - left), leaf.below or (None, None), strict=True):
                    self._value(tree, node, own)
                    child = self._leaf(node, leaf.depth + 1, own, hist) if hist is not None else None
                    if child:
                        heapq.heappush(queue, child)
        return tree


class BoostedTrees:
    """A fitted sum of trees behind the common model interface."""

    def __init__(self, name: str, trees: Sequence[Tree], start: float, features: str = "features"):
        self.name, self.trees, self.start, self.features = name, list(trees), start, features

    def score(self, df: DataFrame) -> DataFrame:
        model = df.sparkSession.sparkContext.broadcast((self.trees, self.start))

        @F.pandas_udf("double")
        def margin(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            trees, start = model.value
            for vec in batches:
                x = np.stack(vec.to_numpy()) if len(vec) else np.zeros((0, 1))
                out = np.full(len(x), start)
                for tree in trees:
                    out += np.array(tree.value)[tree.leaf_of(x)]
                yield pd.Series(out)

        p = 1.0 / (1.0 + F.exp(-F.col("__margin")))
        scored = df.withColumn("__margin", margin(vector_to_array(self.features)))
        return scored.select(*df.columns, (F.col("__margin") > 0).cast("double").alias("prediction"), p.alias("probability"))

    def table(self, spark: SparkSession, first: int | None = None) -> DataFrame:
        """(tree, node, path, feature, threshold, left, right, gain, value, rows).

        The path is a letter, L or R, per step from the root; a leaf has feature -1.
        """
        rows = [
            (t, n, path, tree.feature[n], tree.threshold[n], tree.left[n], tree.right[n], tree.gain[n], tree.value[n], tree.rows[n])
            for t, tree in enumerate(self.trees[:first]) for n, path in enumerate(tree.paths())
        ]
        return spark.createDataFrame(rows, (
            "tree int, node int, path string, feature int, threshold double, `left` int, `right` int, "
            "gain double, value double, `rows` long"))

    def save(self, path: str, spark: SparkSession | None = None) -> None:
        spark = spark or SparkSession.active()
        self.table(spark).withColumn("start", F.lit(self.start)).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, name: str, path: str) -> BoostedTrees:
        trees: list[Tree] = []
        start = 0.0
        for r in spark.read.parquet(path).orderBy("tree", "node").collect():
            start = r["start"]
            if r["node"] == 0:
                trees.append(Tree([], [], [], [], [], [], [], []))
            for column in ("feature", "threshold", "left", "right", "gain", "value", "rows"):
                getattr(trees[-1], column).append(r[column])
            trees[-1].code.append(0)
        return cls(name, trees, start)


def fit_trees(
    train: DataFrame, name: str, params: BoostParams, features: str = "features", label: str = "label",
    binned: Binned | None = None,
) -> BoostedTrees:
    """Fit ``params.rounds`` trees; ``binned`` is a stored matrix to use instead of ``train``."""
    binned = binned or Binned.of(train, features, label, params.bins)
    grower, start = Grower(binned.edges, binned.offsets, params), 0.0
    if params.prior:
        n, positive = binned.blocks.rdd.map(lambda r: pickle.loads(r["block"])[-1]).map(
            lambda y: np.array([len(y), y.sum()])).treeReduce(np.add, 2) if binned.edges else (0, 0)
        start = float(np.log(positive / (n - positive))) if 0 < positive < n else 0.0
    trees: list[Tree] = []
    if binned.edges:
        rows = _Rows(binned, start)
        while len(trees) < params.rounds:
            left = min(KEEP_EVERY, params.rounds - len(trees))
            new = rows.grown_in_place(grower, left) if rows.parts == 1 else [grower.grow(rows)]
            rows.add(new)
            trees += new
        rows.done()
    return BoostedTrees(name, trees, start, features)

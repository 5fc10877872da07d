"""Random forests on binned rows, for 0/1 labels: bagged trees, Gini splits, some features at each node.

Features are binned once (``boosting.Binned``). A tree draws for each row how often it counts (Poisson with mean 1; one
tree alone takes every row once), and a node looks at ceil(sqrt(features)) of the features (one tree alone: all).
Trees grow in two phases:

1. While a node has more than ``SUBTREE_ROWS`` rows its histograms are summed over all partitions, one Spark job per
   level for a group of trees; only sums travel. The driver holds the sums of one level of the group, at most about
   ``LEVEL_BYTES``.
2. The rows of smaller nodes are shuffled by tree and node, as packed bins, and each node is grown to its end by the task that gets
   it: no task holds more than a few such nodes, whatever the table's size.

Both phases choose splits by the same function. What a node draws is hashed from tree and path, so a tree doesn't depend
on where the phases meet nor on partitions. (Jobs over blocks of arrays are RDD jobs, as in ``boosting``.)

A forest of n trees predicts the mean share of label 1 in the leaves; one half counts as 0.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.operators.boosting import PART_ROWS, Binned

SUBTREE_ROWS = 1 << 17
LEVEL_BYTES = 1 << 26
TREE_BYTES = 1 << 29  # of finished trees that come to the driver in one job
MAX_DEPTH = 30
_LEVEL_CELLS = 1 << 21  # cells of a level that are summed at once inside a task
_TASK_ROWS = 1 << 20  # bagged rows of a task in the second phase
_SAME = 1e-9
# How often a row counts, by a 16-bit number: the inverse of the Poisson distribution with mean 1.
_TIMES = np.searchsorted(
    np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)]), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


@dataclass(frozen=True)
class ForestParams:
    """``min_rows`` is the least number of bagged rows on both sides of a split."""

    trees: int = 200
    depth: int = 20
    min_rows: int = 5
    bins: int = 32
    seed: int = 42


@dataclass
class ForestTree:
    """Nodes as arrays. A leaf has feature -1; rows with a bin up to ``code`` go to ``left``, others to the node after it."""

    feature: np.ndarray
    code: np.ndarray
    left: np.ndarray
    value: np.ndarray
    rows: np.ndarray

    def leaf_of(self, codes: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """The leaf of each row; with ``rows`` only of these, the others stay at the root."""
        node = np.zeros(len(codes), dtype=np.int32)
        flat, width = np.ascontiguousarray(codes).ravel(), codes.shape[1]
        moving = np.arange(len(codes)) if rows is None else rows
        at = node[moving]
        while len(moving):
            feature = self.feature.take(at)
            inner = feature >= 0
            if not inner.all():
                moving, at, feature = moving[inner], at[inner], feature[inner]
            at = self.left.take(at) + (flat.take(moving * width + feature) > self.code.take(at))
            node[moving] = at
        return node

    @classmethod
    def of(cls, levels: Sequence[tuple]) -> ForestTree:
        """From the (feature, code, value, rows) of the nodes of each level; children follow in their parents' order."""
        feature, code, value, rows = (np.concatenate(x) for x in zip(*levels, strict=True))
        left = np.where(feature >= 0, 2 * np.cumsum(feature >= 0) - 1, 0)
        return cls(feature.astype(np.int16), code.astype(np.uint8), left.astype(np.int32), value, rows.astype(np.int32))

    def grafted(self, subtrees: Iterable[tuple[int, ForestTree]]) -> ForestTree:
        """The tree with subtrees in place of some of its leaves."""
        out = {k: [getattr(self, k).copy()] for k in ("feature", "code", "left", "value", "rows")}
        size = len(self.feature)
        for leaf, sub in subtrees:
            for k, parts in out.items():
                parts[0][leaf] = getattr(sub, k)[0]
                parts.append(getattr(sub, k)[1:])
            # The root takes the leaf's place, so all other nodes move up by one.
            out["left"][-1] = np.where(out["feature"][-1] >= 0, out["left"][-1] + size - 1, 0).astype(np.int32)
            if sub.feature[0] >= 0:
                out["left"][0][leaf] = sub.left[0] + size - 1
            size += len(sub.feature) - 1
        return ForestTree(**{k: np.concatenate(parts) for k, parts in out.items()})


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers, well mixed (the finaliser of splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sampler:
    """What trees draw: how often rows count, and the features that nodes look at."""

    def __init__(self, params: ForestParams, widths: np.ndarray):
        self.params, self.widths, self.alone = params, widths, params.trees == 1
        self.few = len(widths) if self.alone else min(len(widths), math.ceil(math.sqrt(len(widths))))

    def _key(self, tree: int) -> np.ndarray:
        return _mixed(np.array([(self.params.seed << 32) + tree], dtype=np.uint64))

    def times(self, tree: int, rows: np.ndarray) -> np.ndarray:
        """``rows`` are numbers that tell rows apart."""
        return np.ones(len(rows), np.uint8) if self.alone else _TIMES[_mixed(rows ^ self._key(tree)) >> np.uint64(48)]

    def features(self, trees: np.ndarray, paths: np.ndarray) -> np.ndarray:
        """(node, feature): those that nodes look at. A path is 1 at the root, then doubled, one more on the right."""
        if self.few == len(self.widths):
            return np.tile(np.arange(self.few), (len(paths), 1))
        keys = np.array([self._key(int(t))[0] for t in np.unique(trees)], dtype=np.uint64)[np.unique(trees, return_inverse=True)[1]]
        of_node = _mixed(_mixed(paths.astype(np.uint64)) ^ keys)
        drawn = _mixed(of_node[:, None] + np.arange(len(self.widths), dtype=np.uint64))
        return np.sort(np.argpartition(drawn, self.few - 1, axis=1)[:, : self.few], axis=1)


class Layout:
    """Where the bins of the nodes' features lie in a flat histogram."""

    def __init__(self, features: np.ndarray, widths: np.ndarray):
        self.features, self.width = features, widths[features]
        ends = np.cumsum(self.width.ravel())
        self.start, self.cells = (ends - self.width.ravel()).reshape(features.shape), int(ends[-1]) if len(ends) else 0

    def sums(self, codes: np.ndarray, rows: np.ndarray, slot: np.ndarray, times: np.ndarray, y: np.ndarray) -> np.ndarray:
        """(cell, [label 0, label 1]): bagged rows; ``slot`` is the node of each of the ``rows`` of ``codes``."""
        place = self.features.take(slot, axis=0)
        place += (rows * codes.shape[1])[:, None]
        at = (self.start * 2).take(slot, axis=0)
        at += codes.ravel().take(place) * np.int64(2)
        at += y[:, None]
        return np.bincount(at.ravel(), np.repeat(times.astype(np.float64), at.shape[1]), 2 * self.cells).reshape(-1, 2)

    def splits(self, hist: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
        """Per node: feature (-1: no split lowers the impurity), code, sums of the node and of its left child."""
        n, k = self.features.shape
        first, width = self.start.ravel(), self.width.ravel()
        run = np.cumsum(hist, axis=0)
        left = run - np.repeat(np.concatenate([np.zeros((1, 2)), run])[first], width, axis=0)
        whole = left[first[::k] + width[::k] - 1]
        total = np.repeat(whole, self.width.sum(axis=1), axis=0)
        right = total - left
        (l0, l1), (r0, r1), (t0, t1) = (np.ascontiguousarray(x.T) for x in (left, right, total))
        rows_left, rows_right = l0 + l1, r0 + r1
        with np.errstate(all="ignore"):
            gain = (l0**2 + l1**2) / rows_left + (r0**2 + r1**2) / rows_right - (t0**2 + t1**2) / (t0 + t1)
        gain = np.where((rows_left >= least) & (rows_right >= least) & (gain > _SAME), gain, 0.0)
        most = np.maximum.reduceat(gain, first[::k])
        found = np.flatnonzero((gain > 0) & (gain >= np.repeat(most, self.width.sum(axis=1)) * (1 - _SAME)))
        node = np.searchsorted(first[::k], found, side="right") - 1
        node, at = np.unique(node, return_index=True)  # the first of equal ones
        cell = found[at]
        segment = np.searchsorted(first, cell, side="right") - 1
        feature, code, below = np.full(n, -1), np.zeros(n, np.int64), np.zeros((n, 2))
        feature[node], code[node], below[node] = self.features.ravel()[segment], cell - first[segment], left[cell]
        return feature, code, whole, below


def _packed(codes: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Bins of a row as bytes, those of features with two bins as bits."""
    two = widths <= 2
    return np.hstack([codes[:, ~two], np.packbits(codes[:, two].astype(bool), axis=1)])


def _unpacked(packed: np.ndarray, widths: np.ndarray) -> np.ndarray:
    two = widths <= 2
    plain = int((~two).sum())
    codes = np.empty((len(packed), len(widths)), dtype=np.uint8)
    codes[:, ~two] = packed[:, :plain]
    codes[:, two] = np.unpackbits(packed[:, plain:], axis=1, count=int(two.sum()))
    return codes


def grown_here(
    codes: np.ndarray, times: np.ndarray, y: np.ndarray, tree: int, path: int, depth: int, sampler: Sampler
) -> ForestTree:
    """The subtree of the node at ``path`` with up to ``depth`` levels below it, from the node's rows."""
    p = sampler.params
    rows, slot = np.arange(len(y)), np.zeros(len(y), np.int64)
    paths, sums = np.array([path]), np.bincount(y, times, 2)[None, :]
    levels = []
    for below in range(depth, -1, -1):
        feature, code = np.full(len(paths), -1), np.zeros(len(paths), np.int64)
        lefts = np.zeros((len(paths), 2))
        # Rows lie in the order of their nodes, so a run of nodes is a run of rows.
        ends = np.searchsorted(slot, np.arange(len(paths) + 1))
        may = np.flatnonzero((sums.min(axis=1) > 0) & (sums.sum(axis=1) >= 2 * p.min_rows)) if below else np.zeros(0, int)
        step = max(1, _LEVEL_CELLS // max(1, int(sampler.widths.max()) * sampler.few))
        for a in range(0, len(may), step):
            nodes = may[a : a + step]
            layout = Layout(sampler.features(np.full(len(nodes), tree), paths[nodes]), sampler.widths)
            lo, hi = ends[nodes[0]], ends[nodes[-1] + 1]
            number = np.full(len(paths), -1)
            number[nodes] = np.arange(len(nodes))
            own = number[slot[lo:hi]]
            held = own >= 0
            here = rows[lo:hi][held]
            hist = layout.sums(codes, here, own[held], times[here], y[here])
            feature[nodes], code[nodes], _, lefts[nodes] = layout.splits(hist, p.min_rows)
        n = sums.sum(axis=1)
        levels.append((feature, code, sums[:, 1] / np.maximum(n, 1), n))
        inner = np.flatnonzero(feature >= 0)
        if not len(inner):
            break
        held = feature[slot] >= 0
        rows, slot = rows[held], slot[held]
        child = 2 * (np.cumsum(feature >= 0) - 1)[slot] + (codes[rows, feature[slot]] > code[slot])
        order = np.argsort(child, kind="stable")
        rows, slot = rows[order], child[order]
        paths = (2 * paths[inner][:, None] + np.arange(2)).ravel()
        sums = np.stack([lefts[inner], sums[inner] - lefts[inner]], axis=1).reshape(-1, 2)
    return ForestTree.of(levels)


class _Top:
    """The first phase of one tree: levels whose histograms are summed by Spark."""

    def __init__(self, number: int):
        self.number = number
        self.feature, self.code, self.left = [-1], [0], [0]
        self.value, self.rows, self.path = [0.0], [0], [1]
        self.open: list[int] = []  # nodes that the second phase grows

    def tree(self) -> ForestTree:
        kinds = (np.int16, np.uint8, np.int32, np.float64, np.int32)
        return ForestTree(*(np.array(x, kind) for x, kind in zip(
            (self.feature, self.code, self.left, self.value, self.rows), kinds, strict=True)))

    def split(self, node: int, feature: int, code: int, whole: np.ndarray, below: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Set a node; its children with their sums."""
        self._set(node, whole)
        if feature < 0:
            return []
        at = len(self.feature)
        self.feature[node], self.code[node], self.left[node] = int(feature), int(code), at
        for right, sums in enumerate((below, whole - below)):
            for name in ("feature", "code", "left", "value", "rows"):
                getattr(self, name).append(-1 if name == "feature" else 0)
            self.path.append(2 * self.path[node] + right)
            self._set(at + right, sums)
        return [(at, below), (at + 1, whole - below)]

    def _set(self, node: int, sums: np.ndarray) -> None:
        self.rows[node] = int(sums.sum())
        self.value[node] = float(sums[1] / max(sums.sum(), 1))


class _Part:
    """All blocks of a partition."""

    def __init__(self, blocks: Iterable[bytes]):
        made = [(zlib.crc32(b), pickle.loads(b)) for b in blocks]
        self.codes = np.vstack([b[0] for _, b in made]) if made else np.zeros((0, 0), np.uint8)
        self.y = np.concatenate([b[3] for _, b in made]) if made else np.zeros(0)
        if not np.isin(self.y, (0, 1)).all():
            raise ValueError("labels have to be 0 or 1")
        self.y = self.y.astype(np.int64)
        self.rows = np.concatenate([_mixed((np.uint64(c) << np.uint64(32)) + np.arange(len(b[3]), dtype=np.uint64)) for c, b in made]) if made else np.zeros(0, np.uint64)


def _level_sums(part: _Part, tops: Sequence[tuple[int, ForestTree, np.ndarray, Layout]], sampler: Sampler) -> np.ndarray:
    """The flat histograms of the wanted nodes of some trees, one after the other."""
    out = []
    for number, tree, wanted, layout in tops:
        slot = np.full(len(tree.feature), -1)
        slot[wanted] = np.arange(len(wanted))
        total = np.zeros((layout.cells, 2))
        for a in range(0, len(part.y), 1 << 15):
            codes, y = part.codes[a : a + (1 << 15)], part.y[a : a + (1 << 15)]
            times = sampler.times(number, part.rows[a : a + (1 << 15)])
            held = np.flatnonzero(times)
            own = slot[tree.leaf_of(codes, held)]
            held = held[own[held] >= 0]
            total += layout.sums(codes, held, own[held], times[held], y[held])
        out.append(total)
    return np.concatenate(out)


def _sent(part: _Part, tops: Sequence[tuple[int, ForestTree, np.ndarray]], sampler: Sampler) -> Iterator[tuple]:
    """((tree, node), (packed bins, times, labels)) of the rows in the open nodes."""
    packed = _packed(part.codes, sampler.widths) if len(part.y) else None
    for number, tree, wanted in tops if len(part.y) else ():
        is_open = np.zeros(len(tree.feature), bool)
        is_open[wanted] = True
        times = sampler.times(number, part.rows)
        rows = np.flatnonzero(times)
        leaf = tree.leaf_of(part.codes, rows)
        rows = rows[is_open[leaf[rows]]]
        rows = rows[np.argsort(leaf[rows], kind="stable")]
        nodes, first = np.unique(leaf[rows], return_index=True)
        for node, own in zip(nodes, np.split(rows, first[1:]), strict=True):
            yield (number, int(node)), (packed[own].tobytes(), times[own].tobytes(), part.y[own].astype(np.uint8).tobytes())


def _finished(chunks: Iterable[tuple], tree: int, path: int, sampler: Sampler) -> ForestTree:
    parts = [b"".join(x) for x in zip(*chunks, strict=True)]
    times, y = (np.frombuffer(x, np.uint8) for x in parts[1:])
    codes = _unpacked(np.frombuffer(parts[0], np.uint8).reshape(len(y), -1), sampler.widths)
    return grown_here(codes, times, y.astype(np.int64), tree, path, sampler.params.depth - path.bit_length() + 1, sampler)


class Forest:
    """Fitted trees behind the common model interface; ``edges`` are the upper bounds of the features' bins."""

    def __init__(self, name: str, trees: Sequence[ForestTree], edges: Sequence[np.ndarray], features: str = "features"):
        self.name, self.trees, self.edges, self.features = name, list(trees), list(edges), features

    def score(self, df: DataFrame) -> DataFrame:
        model = df.sparkSession.sparkContext.broadcast((self.trees, self.edges))

        @F.pandas_udf("double")
        def share(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            trees, edges = model.value
            for vec in batches:
                codes = binned(np.stack(vec.to_numpy()), edges) if len(vec) else np.zeros((0, len(edges)), np.uint8)
                out = np.zeros(len(vec))
                for tree in trees:
                    out += tree.value[tree.leaf_of(codes)]
                yield pd.Series(out / len(trees))

        p = F.col("__share")
        scored = df.withColumn("__share", share(vector_to_array(self.features)))
        return scored.select(*df.columns, (p > 0.5).cast("double").alias("prediction"), p.alias("probability"))

    def save(self, path: str, spark: SparkSession | None = None) -> None:
        """A row per tree, and one (tree -1) with the edges."""
        spark = spark or SparkSession.active()
        rows = [(-1, pickle.dumps(self.edges)), *((t, pickle.dumps(tree)) for t, tree in enumerate(self.trees))]
        stored = spark.sparkContext.parallelize(rows, max(1, len(rows) // 16))
        spark.createDataFrame(stored, "tree int, stored binary").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, name: str, path: str) -> Forest:
        edges, *trees = (pickle.loads(r["stored"]) for r in spark.read.parquet(path).orderBy("tree").collect())
        return cls(name, trees, edges)


def binned(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    codes = np.empty(x.shape, np.uint8)
    for f, e in enumerate(edges):
        codes[:, f] = np.minimum(np.searchsorted(e, x[:, f]), len(e) - 1)
    return codes


def fit_forest_trees(
    train: DataFrame, name: str, params: ForestParams, features: str = "features", label: str = "label",
) -> Forest:
    """Fit ``params.trees`` trees."""
    if not 0 <= params.depth <= MAX_DEPTH or params.trees < 1 or not 2 <= params.bins <= 256:
        raise ValueError(f"depth up to {MAX_DEPTH}, at least one tree and 2 to 256 bins, not {params}")
    stored = Binned.of(train, features, label, params.bins, deal=False)
    if not stored.edges:
        raise ValueError("no training rows")
    widths = np.array([len(e) for e in stored.edges])
    sampler = Sampler(params, widths)
    rows = stored.blocks.rdd.map(lambda r: len(pickle.loads(r["block"])[-1])).sum()
    parts = max(train.sparkSession.sparkContext.defaultParallelism, -(-rows // PART_ROWS))
    kept = stored.blocks.repartition(parts).rdd.mapPartitions(
        lambda dealt: [_Part(bytes(r["block"]) for r in dealt)]).persist(StorageLevel.MEMORY_AND_DISK)
    # What the sums of a level of a tree take, and its nodes.
    per_tree = 16 * sampler.few * max(1, 2 * rows // SUBTREE_ROWS) * float(widths.mean())
    nodes = 24 * min(2 ** (params.depth + 1), 2 * rows // params.min_rows + 1)
    group = int(max(1, min(params.trees, LEVEL_BYTES // per_tree, TREE_BYTES // nodes)))
    trees: list[ForestTree] = []
    for a in range(0, params.trees, group):
        tops = [_Top(t) for t in range(a, min(a + group, params.trees))]
        _grow_tops(kept, tops, rows, sampler, parts)
        trees += _grow_rest(kept, tops, sampler, parts)
    kept.unpersist()
    return Forest(name, trees, stored.edges, features)


def _grow_tops(kept, tops: Sequence[_Top], rows: int, sampler: Sampler, parts: int) -> None:
    """Levels of nodes with more than ``SUBTREE_ROWS`` rows, one job each."""
    p = sampler.params
    active = {top.number: [0] for top in tops}
    if rows <= SUBTREE_ROWS or not p.depth:
        for top in tops:
            top.open = [0]
        return
    for level in range(p.depth):
        asked = [
            (top.number, top.tree(), np.array(nodes), Layout(
                sampler.features(np.full(len(nodes), top.number), np.array([top.path[n] for n in nodes])), sampler.widths))
            for top in tops if (nodes := active[top.number])]
        if not asked:
            return
        depth = 1 if parts <= 16 else 2
        sums = kept.map(lambda part, asked=asked: _level_sums(part, asked, sampler)).treeReduce(np.add, depth)
        at, by_number = 0, {top.number: top for top in tops}
        for number, _, nodes, layout in asked:
            top, active[number] = by_number[number], []
            found = layout.splits(sums[at : at + layout.cells], p.min_rows)
            at += layout.cells
            for node, *split in zip(nodes, *found, strict=True):
                for child, own in top.split(int(node), *split):
                    if level + 1 < p.depth and own.min() > 0 and own.sum() >= 2 * p.min_rows:
                        (active[number] if own.sum() > SUBTREE_ROWS else top.open).append(child)


def _grow_rest(kept, tops: Sequence[_Top], sampler: Sampler, parts: int) -> list[ForestTree]:
    """The trees with their open nodes grown to the end."""
    asked = [(top.number, top.tree(), np.array(top.open)) for top in tops if top.open]
    subtrees: dict[int, list] = {top.number: [] for top in tops}
    if asked:
        paths = {(top.number, node): top.path[node] for top in tops for node in top.open}
        # A root that is open has not been counted: then the table is small.
        held = sum(top.rows[node] or SUBTREE_ROWS for top in tops for node in top.open)
        dealt = max(parts, -(-held // _TASK_ROWS))
        grown = kept.flatMap(lambda part: _sent(part, asked, sampler)).groupByKey(dealt).map(
            lambda kv: (kv[0], _finished(kv[1], kv[0][0], paths[kv[0]], sampler)))
        for (number, node), sub in grown.collect():
            subtrees[number].append((node, sub))
    return [top.tree().grafted(sorted(subtrees[top.number], key=lambda x: x[0])) for top in tops]

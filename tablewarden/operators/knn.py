"""Exact k nearest neighbours as a distributed block join in two rounds.

Training rows are put into the leaves of a tree of cells. A cell with more than ``cell_rows`` rows is split around
centres fitted to a bounded sample of its own rows, so the number of leaves grows with the rows, and every
cell knows the distance from its centre to its farthest row. In the first round a query meets the leaf it would
belong to (and, where that has too few rows, its neighbours below the same cell); the k-th distance found there is
a tight upper bound. In the second round it meets only the leaves that the bound reaches: those whose centre is
nearer than bound and radius together, found by walking down the tree. Cells are skipped only when the bounds prove
them empty of neighbours, so nothing is dropped.

In the second round neighbouring leaves travel together, in bundles: a query is sent once to each bundle with a leaf that
it reaches, with its bound, and picks the leaves there. So what is shuffled grows with queries times bundles, not leaves,
and what comes back are rows within the bound, at most k per query and block.

Leaves that cannot be split further (equal vectors) are cut into blocks of ``block_rows`` rows, and so are the
queries of a busy leaf, so no task sees more than one block of each side; blocks of the second round have up to ``WIDE``
times as many rows. The tree is the one thing that every task gets. ``TREE_BYTES`` bounds it: beyond that, leaves stay
larger.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.session import materialize

CELL_ROWS = 4_000
BLOCK_ROWS = 20_000
FAN = 32
SAMPLE_ROWS = 512  # expected rows of a cell's sample
TREE_BYTES = 128 << 20
WIDE = 4  # blocks of the second round, in blocks of the first
PAIRS = 100  # pairs of blocks that the second round should have at least, to keep all cores busy
_CHUNK = 4_000_000
_SLACK = 1e-9


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances from differences (no cancellation), for a small ``b``."""
    out = np.empty((len(a), len(b)))
    step = max(1, _CHUNK // max(1, b.size))
    for i in range(0, len(a), step):
        out[i : i + step] = np.sqrt(((a[i : i + step, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    return out


def _centres(rows: np.ndarray, fan: int) -> np.ndarray:
    """At most ``fan`` distinct centres of a sample: a few turns of k-means from spread rows."""
    rows = rows[np.lexsort(rows.T[::-1])]
    rows = rows[np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])]
    if len(rows) <= fan:
        return rows
    chosen, nearest = [0], _distances(rows, rows[:1])[:, 0]
    while len(chosen) < fan:  # farthest rows first, so that separate clusters get centres of their own
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(rows, rows[chosen[-1:]])[:, 0])
    centres = rows[chosen]
    for _ in range(5):
        own = _distances(rows, centres).argmin(axis=1)
        used = np.unique(own)
        centres = np.stack([rows[own == c].mean(axis=0) for c in used])
    return np.unique(centres, axis=0)


@dataclass
class CellTree:
    """Cells in the order of their making; the root is 0 and has no centre. Leaves have no children."""

    parent: np.ndarray
    first: np.ndarray  # first child
    children: np.ndarray  # number of children, which follow each other
    centre: np.ndarray
    radius: np.ndarray
    size: np.ndarray

    @classmethod
    def root(cls, total: int, d: int) -> CellTree:
        one = np.zeros(1, dtype=np.int64)
        return cls(one - 1, one.copy(), one.copy(), np.zeros((1, d)), np.full(1, np.inf), one + total)

    @property
    def leaves(self) -> np.ndarray:
        return np.flatnonzero(self.children == 0)

    def split(self, node: int, centres: np.ndarray) -> None:
        k = len(centres)
        self.first[node], self.children[node] = len(self.parent), k
        self.parent = np.append(self.parent, np.full(k, node))
        self.first, self.children = np.append(self.first, np.zeros(k, int)), np.append(self.children, np.zeros(k, int))
        self.centre = np.concatenate([self.centre, centres])
        self.radius, self.size = np.append(self.radius, np.zeros(k)), np.append(self.size, np.zeros(k, int))

    def _below(self, node: int) -> slice:
        return slice(self.first[node], self.first[node] + self.children[node])

    def path(self, q: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per level the cell of each row and its distance from that cell's centre; leaves repeat."""
        at, nodes, away = np.zeros(len(q), dtype=np.int64), [], []
        far = np.zeros(len(q))
        while (self.children[at] > 0).any():
            at = at.copy()
            far = far.copy()
            for node in np.unique(at[self.children[at] > 0]):
                rows = np.flatnonzero(at == node)
                d = _distances(q[rows], self.centre[self._below(node)])
                best = d.argmin(axis=1)
                at[rows], far[rows] = self.first[node] + best, d[np.arange(len(rows)), best]
            nodes.append(at)
            away.append(far)
        return nodes, away

    def leaf(self, q: np.ndarray) -> np.ndarray:
        nodes, _ = self.path(q)
        return nodes[-1] if nodes else np.zeros(len(q), dtype=np.int64)

    def under(self, node: int) -> np.ndarray:
        """The leaves below a cell that hold rows."""
        if not self.children[node]:
            return np.array([node])[self.size[[node]] > 0]
        return np.concatenate([self.under(c) for c in range(*self._below(node).indices(len(self.parent)))])

    def first_leaves(self, q: np.ndarray, reach: int) -> list[np.ndarray]:
        """The leaf of each row, or the leaves of the lowest cell above it with ``reach`` rows."""
        found: dict[int, np.ndarray] = {}
        out = []
        for leaf in self.leaf(q).tolist():
            if leaf not in found:
                node = leaf
                while self.size[node] < reach and self.parent[node] >= 0:
                    node = self.parent[node]
                found[leaf] = self.under(node)
            out.append(found[leaf])
        return out

    def reached(self, q: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of all leaves that can hold a row within ``bound`` of a query."""
        row, at, rows, leaves = np.arange(len(q)), np.zeros(len(q), dtype=np.int64), [], []
        limit = bound * (1 + _SLACK) + _SLACK
        while len(row):
            done = self.children[at] == 0
            rows.append(row[done])
            leaves.append(at[done])
            next_row, next_at = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for node in np.unique(at[~done]):
                own = row[at == node]
                below = self._below(node)
                gap = _distances(q[own], self.centre[below]) - self.radius[below][None, :]
                i, j = np.nonzero((gap <= limit[own][:, None]) & (self.size[below] > 0)[None, :])
                next_row.append(own[i])
                next_at.append(self.first[node] + j)
            row, at = np.concatenate(next_row), np.concatenate(next_at)
        return np.concatenate(rows), np.concatenate(leaves)


def _vectors(column: str, df: DataFrame) -> Column:
    """The vector column as an array of floats or doubles; floats stay floats, which halves what is shuffled."""
    return F.col(column) if dict(df.dtypes)[column] == "array<float>" else F.col(column).cast("array<double>")


def _smallest_copies(block: pd.DataFrame, k: int) -> pd.DataFrame:
    """The rows of a block by id; of equal vectors only the k smallest ids can be among the nearest."""
    block = block.sort_values("id", kind="stable")
    copies = block["vec"].map(lambda v: v.tobytes())
    return block[(block.groupby(copies).cumcount() < k).to_numpy()]


def _nearest_in_block(k: int):
    """Top-k rows of one block for each query of one group, ordered by (distance, id)."""

    def search(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(block):
            return pd.DataFrame({"qid": [], "dist": [], "id": [], "label": []})
        block = _smallest_copies(block, k)
        b, ids, labels = _matrix(block["vec"]), block["id"].to_numpy(), block["label"].to_numpy()
        bb = (b * b).sum(axis=1)
        q_all, qids = _matrix(queries["vec"]), queries["qid"].to_numpy()
        found: list[tuple[np.ndarray, ...]] = []
        step = max(1, _CHUNK // len(b))
        part = max(1, _CHUNK // b.shape[1])
        for start in range(0, len(q_all), step):
            q = q_all[start : start + step]
            qq = (q * q).sum(axis=1)[:, None]
            rough = qq + bb[None, :] - 2.0 * (q @ b.T)
            take = min(k, len(b))
            kth = np.partition(rough, take - 1, axis=1)[:, take - 1 : take]
            # The product form rounds; everything within its error is measured again.
            rows, cols = np.nonzero(rough <= kth + _SLACK * (qq + bb[None, :] + 1.0))
            exact = np.concatenate([
                np.sqrt(((q[rows[i : i + part]] - b[cols[i : i + part]]) ** 2).sum(axis=1))
                for i in range(0, len(rows), part)
            ])
            order = np.lexsort((cols, exact, rows))
            rows, cols, exact = rows[order], cols[order], exact[order]
            first = np.searchsorted(rows, rows, side="left")
            best = np.arange(len(rows)) - first < k
            found.append((qids[start + rows[best]], exact[best], ids[cols[best]], labels[cols[best]]))
        qid, dist, ident, label = (np.concatenate(part) for part in zip(*found, strict=True))
        return pd.DataFrame({"qid": qid, "dist": dist, "id": ident, "label": label})

    return search


def _first_of(k: int, rows: np.ndarray, exact: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Positions of the k smallest (distance, column) of each row, in that order."""
    order = np.lexsort((cols, exact, rows))
    rows = rows[order]
    return order[np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k]


def _within_bounds(k: int):
    """Top-k rows of one block within the bound of each query of one group, from leaves it has not met before."""

    def search(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(block):
            return pd.DataFrame({"qid": [], "dist": [], "id": [], "label": []})
        block = _smallest_copies(block, k)
        b, ids, labels = _matrix(block["vec"]), block["id"].to_numpy(), block["label"].to_numpy()
        q_all, qids = _matrix(queries["vec"]), queries["qid"].to_numpy()
        qq = (q_all * q_all).sum(axis=1)[:, None]
        # Squared distances less what their product form may be off by, as one product: qq + bb - 2 qb.
        one = np.ones((len(q_all), 1))
        q_side = np.hstack([-2.0 * q_all, one, qq * (1 - _SLACK) - _SLACK])
        limit = queries["bound"].to_numpy() * (1 + _SLACK) + _SLACK
        met = queries["cells"].to_numpy()
        met_row, met_leaf = np.repeat(np.arange(len(met)), [len(x) for x in met]), np.concatenate(met)
        leaf, part = block["cell"].to_numpy(), max(1, _CHUNK // b.shape[1])
        found = [(np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0, dtype=np.int64))]
        for cell in np.unique(leaf):
            own = np.flatnonzero(leaf == cell)
            inside = b[own]
            inside_sq, centre = (inside * inside).sum(axis=1)[:, None], inside.mean(axis=0)[None, :]
            b_side = np.hstack([inside, inside_sq * (1 - _SLACK), np.ones((len(inside), 1))]).T
            fresh = _distances(q_all, centre)[:, 0] - _distances(inside, centre).max() <= limit
            fresh[met_row[met_leaf == cell]] = False
            reached, step = np.flatnonzero(fresh), max(1, _CHUNK // len(inside))
            for start in range(0, len(reached), step):
                at = reached[start : start + step]
                q = q_all[at]
                # Everything within that error is measured again.
                rough = q_side[at] @ b_side
                near = rough <= (limit[at] ** 2)[:, None]
                if np.count_nonzero(near) > 4 * k * len(at):
                    take = min(k, len(inside)) - 1
                    kth = np.partition(rough, take, axis=1)[:, take : take + 1]
                    near &= rough <= kth + 2 * _SLACK * (qq[at] + inside_sq.max() + 1.0)
                rows, cols = np.nonzero(near)
                exact = np.concatenate([np.zeros(0), *(
                    np.sqrt(((q[rows[i : i + part]] - inside[cols[i : i + part]]) ** 2).sum(axis=1))
                    for i in range(0, len(rows), part))])
                best = _first_of(k, rows, exact, cols)
                rows, cols, exact = rows[best], cols[best], exact[best]
                # k rows of one leaf are a bound for the leaves that follow.
                last = np.flatnonzero(rows[k - 1 :] == rows[: max(0, len(rows) - k + 1)]) + k - 1
                limit[at[rows[last]]] = np.minimum(limit[at[rows[last]]], exact[last] * (1 + _SLACK) + _SLACK)
                found.append((at[rows], exact, own[cols]))
        rows, exact, cols = (np.concatenate(x) for x in zip(*found, strict=True))
        kept = exact <= limit[rows]
        rows, exact, cols = rows[kept], exact[kept], cols[kept]
        best = _first_of(k, rows, exact, cols)
        return pd.DataFrame({
            "qid": qids[rows[best]], "dist": exact[best], "id": ids[cols[best]], "label": labels[cols[best]]})

    return search


class KnnIndex:
    """Training rows (id, vec, label) in the leaves of a tree of cells."""

    def __init__(self, train: DataFrame, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS, fan: int = FAN):
        self.block_rows, self.least, self.spark = block_rows, min(block_rows, cell_rows), train.sparkSession
        train = train.select("id", _vectors("vec", train).alias("vec"), F.col("label").cast("double").alias("label"))
        self.id_type = dict(train.dtypes)["id"]
        self.tree = self._grown(train, cell_rows, fan)
        shared = self._shared()

        @F.pandas_udf("path array<long>, away array<double>")
        def place(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for vec in batches:
                nodes, away = shared.value.path(_matrix(vec))
                yield pd.DataFrame({
                    "path": list(np.stack(nodes, axis=1)) if nodes else [np.zeros(1, dtype=np.int64)] * len(vec),
                    "away": list(np.stack(away, axis=1)) if nodes else [np.zeros(1)] * len(vec)})

        placed = train.withColumn("__p", place("vec")).select(
            "id", "vec", "label", F.element_at("__p.path", -1).alias("cell"), "__p.path", "__p.away")
        placed = materialize(placed, "knn-train")
        self.rows = placed.select("id", "vec", "label", "cell")
        self.tree.size[:] = 0
        met = placed.select(F.explode(F.array_distinct(F.arrays_zip("path", "away"))).alias("z"))
        for r in met.groupBy("z.path").agg(F.max("z.away").alias("radius"), F.count("*").alias("n")).collect():
            self.tree.radius[r["path"]], self.tree.size[r["path"]] = r["radius"], r["n"]
        if len(self.tree.parent) > 1:
            self.tree.size[0] = self.tree.size[self.tree._below(0)].sum()

    def _shared(self, tree: CellTree | None = None):
        return self.spark.sparkContext.broadcast(tree or self.tree)

    def _leaf(self, tree: CellTree):
        shared = self._shared(tree)

        @F.pandas_udf("long")
        def leaf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for vec in batches:
                yield pd.Series(shared.value.leaf(_matrix(vec)))

        return leaf

    def _grown(self, train: DataFrame, cell_rows: int, fan: int) -> CellTree:
        """Split every cell above ``cell_rows`` rows until none is left, or the tree has its full size.

        Per level one pass counts rows by cell and one draws a sample of the cells to be split. What is collected
        has the size of the tree.
        """
        total = train.count()
        first = train.select("vec").first()
        d = len(first["vec"]) if first else 1
        most = max(fan, TREE_BYTES // (8 * d + 64))
        tree = CellTree.root(total, d)
        open_cells = [0] if total > cell_rows else []
        while open_cells:
            open_cells = open_cells[: max(0, (most - len(tree.parent)) // fan)]
            rates = self.spark.createDataFrame([(int(c), int(tree.size[c])) for c in open_cells], "cell long, n long")
            drawn = (
                train.select("vec", self._leaf(tree)("vec").alias("cell"), F.xxhash64(F.lit(len(tree.parent)), "id").alias("h"))
                .join(F.broadcast(rates), "cell").where(F.pmod("h", "n") < SAMPLE_ROWS)
            )

            def centres(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
                found = _centres(_matrix(rows["vec"]), fan)
                return pd.DataFrame({"cell": [key[0]] * len(found), "vec": list(found)})

            made: dict[int, list] = {}
            for r in drawn.groupBy("cell").applyInPandas(centres, "cell long, vec array<double>").collect():
                made.setdefault(r["cell"], []).append(r["vec"])
            new = []
            for cell, found in sorted(made.items()):
                if len(found) > 1:
                    tree.split(cell, np.array(found, dtype=np.float64))
                    new += range(*tree._below(cell).indices(len(tree.parent)))
            if not new:
                break
            for r in train.select(self._leaf(tree)("vec").alias("cell")).groupBy("cell").count().collect():
                tree.size[r["cell"]] = r["count"]
            open_cells = [c for c in new if cell_rows < tree.size[c] < tree.size[tree.parent[c]]]
        return tree

    def _bundles(self, most: int) -> np.ndarray:
        """Per cell the number of its bundle: neighbouring leaves of at most ``most`` rows together."""
        bundle, number, held = np.zeros(len(self.tree.parent), dtype=np.int64), 0, 0
        for leaf in self.tree.under(0):
            if held and held + self.tree.size[leaf] > most:
                number, held = number + 1, 0
            bundle[leaf], held = number, held + self.tree.size[leaf]
        return bundle

    def _met(self, asked: DataFrame, rows: DataFrame, size: Mapping[int, int], block_rows: int, search) -> DataFrame:
        """(qid, dist, id, label): what ``search`` finds for each asked row among the rows of its part, per block."""
        load = {r["part"]: r["count"] for r in asked.groupBy("part").count().collect()}
        parts = [(int(p), -(-int(size[p]) // block_rows) or 1, -(-load[p] // block_rows)) for p in load]
        table = F.broadcast(self.spark.createDataFrame(parts, "part long, blocks long, groups long"))

        def salted(df: DataFrame, ident: str, own: str, own_parts: str, other: str, other_parts: str) -> DataFrame:
            # Each row has its own block; it meets every block of the other side of its part.
            return df.join(table, "part").withColumn(own, F.pmod(F.xxhash64(F.lit(own), ident), own_parts)).withColumn(
                other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other_parts) - 1))).drop("blocks", "groups")

        left = salted(asked, "qid", "g", "groups", "b", "blocks")
        right = salted(rows, "id", "b", "blocks", "g", "groups")
        keys, qid_type = ["part", "b", "g"], dict(asked.dtypes)["qid"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
            search, f"qid {qid_type}, dist double, id {self.id_type}, label double")

    def search(self, queries: DataFrame, k: int, exclude_self: bool = False) -> tuple[DataFrame, DataFrame]:
        """((qid, dist, id, label) of the k nearest rows, (qid, cell) of the leaves that were searched)."""
        reach = k + 1 if exclude_self else k
        queries = queries.select("qid", _vectors("vec", queries).alias("vec"))
        shared = self._shared()

        @F.pandas_udf("array<long>")
        def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for vec in batches:
                yield pd.Series(shared.value.first_leaves(_matrix(vec), reach))

        def others(bundle: np.ndarray | None = None):
            """The further leaves that a query reaches, or the bundles they are in."""
            sent = self.spark.sparkContext.broadcast(bundle)

            @F.pandas_udf("array<long>")
            def reached(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
                for vec, bound, seen in batches:
                    row, leaf = shared.value.reached(_matrix(vec), bound.to_numpy())
                    order = np.lexsort((leaf, row))
                    cuts = np.searchsorted(row[order], np.arange(1, len(vec)))
                    more = [np.setdiff1d(x, y) for x, y in zip(np.split(leaf[order], cuts), seen, strict=True)]
                    yield pd.Series(more if sent.value is None else [np.unique(sent.value[x]) for x in more])

            return reached("vec", "bound", "cells")

        first = materialize(queries.withColumn("cells", nearest("vec")), "knn-first")
        sizes = dict(enumerate(self.tree.size.tolist()))
        near = materialize(self._met(
            first.select("qid", "vec", F.explode("cells").alias("part")),
            self.rows.withColumnRenamed("cell", "part"), sizes, self.block_rows, _nearest_in_block(reach)), "knn-near")
        best = F.slice(F.array_sort(F.collect_list("dist")), 1, reach)
        bounds = near.groupBy("qid").agg(best.alias("d")).select(
            "qid", F.when(F.size("d") == reach, F.element_at("d", -1)).otherwise(float("inf")).alias("bound"))
        # Blocks as large as may be, but enough pairs of them.
        held_rows = int(self.tree.size[self.tree.leaves].sum())
        wide = min(WIDE * self.block_rows, max(self.least, math.isqrt(held_rows * first.count() // PAIRS)))
        bundle = self._bundles(wide)
        bounded = materialize(first.join(bounds, "qid").withColumn("bundles", others(bundle)), "knn-bounded")
        leaves = self.tree.leaves
        placed = F.broadcast(self.spark.createDataFrame(
            [(int(c), int(bundle[c])) for c in leaves], "cell long, part long"))
        held = {int(p): int(n) for p, n in enumerate(np.bincount(bundle[leaves], self.tree.size[leaves]))}
        # At most k candidates per block with a leaf that is reached, none beyond the bound.
        partial = near.unionByName(self._met(
            bounded.select("qid", "vec", "bound", "cells", F.explode("bundles").alias("part")),
            self.rows.join(placed, "cell"), held, wide, _within_bounds(reach)))
        if exclude_self:
            partial = partial.where(F.col("qid") != F.col("id"))
        found = partial.groupBy("qid").agg(
            F.slice(F.array_sort(F.collect_list(F.struct("dist", "id", "label"))), 1, k).alias("near"))
        met = F.explode(F.concat("cells", others()))
        return found.select("qid", F.inline("near")), bounded.select("qid", met.alias("cell"))


def knn_join(
    train: DataFrame, queries: DataFrame, k: int, exclude_self: bool = False, block_rows: int = BLOCK_ROWS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(qid, dist, id, label): the k nearest training rows of every query.

    ``train`` has ``id, vec, label`` and ``queries`` has ``qid, vec``; vectors
    are arrays of numbers. Ties in distance go to the smaller id. With
    ``exclude_self`` a training row does not count as its own neighbour.
    """
    return KnnIndex(train, cell_rows, block_rows).search(queries, k, exclude_self)[0]


def knn_predict(
    train: DataFrame, queries: DataFrame, k: int, exclude_self: bool = False, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(qid, probability, prediction): uniform vote of the k nearest rows on a 0/1 label."""
    votes = knn_join(train, queries, k, exclude_self, block_rows).groupBy("qid").agg(F.avg("label").alias("probability"))
    return votes.withColumn("prediction", (F.col("probability") > 0.5).cast("double"))

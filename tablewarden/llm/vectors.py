"""Near-duplicate embeddings by sorted projection passes.

Equal vectors count as one with a number of copies. In each pass every vector gets a hash of concatenated
signs of random projections, vectors are put in the order of their hashes, and each is compared with the
``WINDOW`` vectors that follow it. Links are pairs with a cosine of 0.9 or more, in double precision; they
are united over all passes. The number of passes grows with the table so that a pair at the threshold
shares a window somewhere with probability 0.995, and closer pairs more surely.

A window bounds what is compared, not what is found. Where vectors are crowded, more of them agree in the hash bits
that an even spread would need than a window holds, and pairs would be missed. Vectors that are in such overfull
cells in a quarter of the passes or more are put into dense regions (cells that share enough of them are one region), and
a region is compared completely, block against block. So are components of three vectors or more, without
what their regions have compared, so that link counts are whole. This work grows with the square of the vectors that
are in one region or component, not of the table. A pair is counted where it is first seen, which its two positions in all
passes and its regions tell; pairs themselves never leave a task.

Null, empty and zero vectors and those with null or non-finite components have no links and are their own
component; vectors of different lengths are never linked. Rows with equal vectors are links of each
other, repeated rows as well. A null id has a null component and is kept. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.llm.common import col, join_groups, numbered
from tablewarden.llm.graph import components
from tablewarden.session import materialize

THRESHOLD = 0.9
WINDOW = 128
BLOCK = 512
REGION_BLOCK = 2048
OVERFULL = 4  # windows that a cell holds
MISSED = 0.005
_BITS = 63


def passes_for(n: int, threshold: float = THRESHOLD, window: int = WINDOW, missed: float = MISSED) -> int:
    """Passes after which a pair at the threshold was never in a window with probability ``missed``.

    A pair shares a window if its hashes agree up to where a window's worth of vectors is left.
    """
    same = (1 - math.acos(threshold) / math.pi) ** math.log2(max(n / window, 1.0))
    return max(2, math.ceil(math.log(missed) / math.log1p(-min(same, 0.9))))


def _clean(df: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id, dim, node (a digest of the vector; null if it can't be compared) and vector as doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1).cast(pa.list_(pa.float64()))
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(size)
            nodes, dims = [None] * len(size), np.zeros(len(size), dtype=np.int32)
            for i, (end, k) in enumerate(zip(ends.tolist(), size.tolist(), strict=True)):
                own = values[end - k : end]
                if k and np.isfinite(own).all() and own.any():
                    nodes[i], dims[i] = hashlib.md5(own.tobytes()).hexdigest(), k
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(dims), pa.array(nodes, pa.string()), lists], names=["vec_id", "dim", "node", "vec"])

    return df.select(col(key).cast("long"), col(vector).cast("array<double>")).mapInArrow(
        run, "vec_id long, dim int, node string, vec array<double>")


def _units(column: pd.Series) -> np.ndarray:
    x = np.stack(column.to_numpy()).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _keys(nodes: DataFrame, passes: int, seed: int) -> DataFrame:
    """(pass, dim, key, node) for every vector and pass."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, rows in batch.groupby("dim"):
                x = _units(rows["vec"])
                for p in range(passes):
                    planes = np.random.default_rng((seed, p, dim)).standard_normal((dim, _BITS))
                    signs = (x @ planes >= 0).astype(np.int64)
                    yield pd.DataFrame({
                        "pass": np.int32(p), "dim": np.int32(dim), "key": signs @ (1 << np.arange(_BITS - 1, -1, -1)),
                        "node": rows["node"].to_numpy(),
                    })

    return nodes.select("dim", "vec", "node").mapInPandas(run, "pass int, dim int, key long, node string")


_FOUND = T.StructType([
    T.StructField("node", T.StringType()), T.StructField("links", T.LongType()), T.StructField("other", T.StringType())])


def _summed(rows: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Links of pairs (a, b) of row numbers as one row per linked vector: how many, and a vector it hangs on."""
    n = len(rows)
    copies = rows["copies"].to_numpy()
    links = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    linked = np.flatnonzero(links)
    nodes = rows["node"].to_numpy()
    return pd.DataFrame({"node": nodes[linked], "links": links[linked].astype(np.int64), "other": nodes[root[linked]]})


def _near(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(x @ y.T >= threshold)


def dense_regions(ordered: DataFrame, passes: int, window: int, n: int) -> DataFrame:
    """(node, region) of the vectors that are in overfull cells in a quarter of the passes or more.

    ``ordered`` is a stored (pass, node, cell). Cells that share a window's worth of such vectors are one region.
    """
    sizes = ordered.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
    over = materialize(sizes.where(F.col("size") > OVERFULL * window), "vector-cells")
    crowded = join_groups(ordered, over, ["cell"], "size", n, "inner").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("pass", "cell"))).alias("c")).where(F.size("c") >= max(1, -(-passes // 4)))
    dense = materialize(crowded.select("node", F.col("c.cell").alias("cells")), "vector-dense")
    steps = F.zip_with(F.slice("cells", 1, F.greatest(F.size("cells") - 1, F.lit(0))), F.slice("cells", 2, F.size("cells")),
                       lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    links = dense.select(F.explode(steps).alias("s")).groupBy("s.a", "s.b").agg(F.count(F.lit(1)).alias("n"))
    labels = materialize(components(links.where(F.col("n") >= window)).join(
        over.select(F.col("cell").alias("node"), "size"), "node", "right").select(
            F.col("node").alias("cell"), F.coalesce("component", "node").alias("region"), "size"), "vector-regions")
    of_cells = materialize(dense.select("node", F.explode("cells").alias("cell")), "vector-dense-cells")
    return join_groups(of_cells, labels, ["cell"], "size", n, "inner").groupBy("node").agg(
        F.mode("region", True).alias("region"))


def _compared(members: DataFrame, threshold: float, window: int, whole: bool) -> DataFrame:
    """Links between (component, node, dim, copies, vec, spots, region) of one component that no window held.

    Block against block; where not ``whole``, without pairs of one region. Small components share a block.
    """
    members = materialize(members, "vector-members")
    total = members.count()
    kind = F.lit("") if whole else F.coalesce("region", F.lit(""))
    sized = members.withColumn("kind", kind)
    blocks = F.ceil(F.col("size") / REGION_BLOCK).cast("int")
    by_kind = sized.groupBy("component", "kind").agg(F.count(F.lit(1)).alias("size")).withColumn("own", blocks)
    order = Window.partitionBy("component").orderBy("kind")
    every = Window.partitionBy("component")
    by_kind = materialize(by_kind.select(
        "component", "kind", "size", "own", (F.sum("own").over(order) - F.col("own")).cast("int").alias("start"),
        F.sum("own").over(every).cast("int").alias("blocks"), F.sum("size").over(every).alias("members")), "vector-blocks")
    placed = join_groups(sized, by_kind.where("members > 2" if not whole else "members > 1"), ["component", "kind"], "size", total, "inner")
    # Components of one block go together, about a block's worth of them in a group.
    alone = F.col("members") <= REGION_BLOCK
    bundles = max(1, total // REGION_BLOCK)
    placed = placed.withColumn("block", F.when(alone, 0).otherwise(F.col("start") + F.pmod(F.xxhash64("node"), F.col("own"))).cast("int"))
    bundle = F.when(alone, F.concat(F.lit("+"), F.pmod(F.xxhash64("component"), F.lit(bundles)))).otherwise(F.col("component"))
    others = F.when(alone, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    if not whole:  # the blocks of its own region are done
        in_region = ~alone & (F.col("kind") != "")
        others = F.when(in_region, F.filter(others, lambda j: (j < F.col("start")) | (j >= F.col("start") + F.col("own")))).otherwise(others)
    meets = F.transform(others, lambda j: F.struct(F.least(F.col("block"), j).alias("i"), F.greatest(F.col("block"), j).alias("j")))
    met = placed.withColumn("bundle", bundle).withColumn("meet", F.explode(meets)).select(
        "bundle", "meet.i", "meet.j", "block", "component", "node", "dim", "copies", "vec", "spots", "kind")

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["component", "node"], ignore_index=True)
        block, spots = group["block"].to_numpy(), np.stack(group["spots"].to_numpy())
        component, kinds = pd.factorize(group["component"])[0], pd.factorize(group["kind"])[0]
        regional = (group["kind"] != "").to_numpy()
        pairs = []
        cuts = np.flatnonzero(np.diff(component, prepend=-1, append=-1)) if key[1] == key[2] == 0 else [0, len(group)]
        for first, last in zip(cuts[:-1], cuts[1:], strict=True):
            x = _units(group["vec"].iloc[first:last])  # vectors of one component have one length
            left = first + np.flatnonzero(block[first:last] == key[1])
            right = first + np.flatnonzero(block[first:last] == key[2])
            for at in range(0, len(left), BLOCK):
                rows = left[at : at + BLOCK]
                a, b = _near(x[rows - first], x[right - first], threshold)
                a, b = rows[a], right[b]
                new = a < b if key[1] == key[2] else np.ones(len(a), dtype=bool)
                new &= ~(regional[a] & (kinds[a] == kinds[b]))
                a, b = a[new], b[new]
                seen = np.zeros(len(a), dtype=bool)
                for p in range(spots.shape[1]):
                    seen |= np.abs(spots[a, p] - spots[b, p]) <= window
                pairs.append((a[~seen], b[~seen]))
        a, b = (np.concatenate(z) if pairs else np.zeros(0, dtype=np.int64) for z in (zip(*pairs, strict=True) if pairs else ((), ())))
        return _summed(group, a, b)

    return met.groupBy("bundle", "i", "j").applyInPandas(compare, _FOUND)


def near_vectors(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, window: int = WINDOW,
    seed: int = 5,
) -> DataFrame:
    """Per row: vec_id, n_links, component_id and kept."""
    rows = materialize(_clean(df, key, vector), "vectors")
    known = rows.where("node is not null")
    nodes = materialize(
        known.groupBy("node").agg(
            F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"), F.first("dim").alias("dim"), F.first("vec").alias("vec")),
        "vector-nodes",
    )
    n = nodes.count()
    passes = passes_for(n, threshold, window)
    ordered = numbered(
        _keys(nodes, passes, seed).select(F.struct("pass", "dim", "key", "node").alias("place")), "place", "at")
    bits = math.floor(math.log2(max(n / window, 1.0)))
    ordered = materialize(ordered.select(
        "place.pass", "place.node", (F.col("at") - F.col("place.pass") * n).alias("at"),
        F.concat_ws(":", "place.pass", "place.dim", F.shiftright("place.key", _BITS - bits)).alias("cell")), "vector-order")
    regions = dense_regions(ordered, passes, window, n)
    spots = ordered.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("pass", "at"))).alias("s")).select(
        "node", F.col("s.at").alias("spots"))
    placed = materialize(
        nodes.select("node", "dim", "copies", "vec").join(spots, "node").join(regions, "node", "left"), "vector-places")

    # A group holds a block of positions and the window after it.
    own = F.floor(F.col("at") / BLOCK)
    in_pass = placed.select("*", F.posexplode("spots").alias("pass", "at"))
    visits = F.when((F.col("at") % BLOCK < window) & (F.col("at") >= BLOCK), F.array(own, own - 1)).otherwise(F.array(own))
    grouped = in_pass.withColumn("part", F.explode(visits))

    def windows(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        turn, part = int(key[0]), int(key[1])
        group = group.sort_values("at", ignore_index=True)
        at = group["at"].to_numpy()
        spots = np.stack(group["spots"].to_numpy())
        pairs = []
        dims = group["dim"].to_numpy()
        for dim in np.unique(dims):
            which = np.flatnonzero(dims == dim)
            x = _units(group["vec"].iloc[which])
            a, b = (which[k] for k in _near(x, x, threshold))
            gap = at[b] - at[a]
            seen = (gap > 0) & (gap <= window) & (at[a] < (part + 1) * BLOCK)
            a, b = a[seen], b[seen]
            earlier = (np.abs(spots[a, :turn] - spots[b, :turn]) <= window).any(axis=1)
            pairs.append((a[~earlier], b[~earlier]))
        return _summed(group, *(np.concatenate(x) for x in zip(*pairs, strict=True)))

    found = materialize(grouped.groupBy("pass", "part").applyInPandas(windows, _FOUND), "vector-links")
    inside = _compared(placed.where("region is not null").withColumn("component", F.col("region")), threshold, window, True)
    found = materialize(found.unionByName(inside), "vector-links")
    labels = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    more = _compared(labels.join(placed, "node"), threshold, window, False)
    links = found.unionByName(more).groupBy("node").agg(F.sum("links").alias("links"))
    grown = materialize(nodes.select("node", "copies", "least").join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")).join(links, "node", "left"), "vector-grown")
    least = materialize(grown.groupBy("component").agg(
        F.min("least").alias("component_id"), F.count(F.lit(1)).alias("size")), "vector-least")
    table = join_groups(grown, least, ["component"], "size", n, "inner").select(
        "node", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "copies")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return join_groups(rows, materialize(table, "vector-table"), ["node"], "copies", rows.count()).select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))

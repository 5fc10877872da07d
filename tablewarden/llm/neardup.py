"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A document is its bag of five-word shingles. A shingle weighs its count times an inverse document
frequency, which is counted over all documents in hashed cells (the usual hashing trick) and clipped to
[1/2, 1] of log(1/RARE): shingles in less than one fiftieth of the documents have full weight, those that
very many documents share have half of it. A large group of copies or near copies counts about as one
document in this: a first round bands plain min-hashes, and a document in a band with a thousandth of all
rows or more counts for one over the size of its largest band. Weighted samples are drawn consistently (Ioffe 2010): two
documents draw the same sample with a probability equal to their weighted Jaccard similarity. Samples are
banded; documents that share a band are candidates, and a pair is a link if its weighted Jaccard
similarity, computed from the whole texts, is 0.8 or more. Groups are the connected components.

Bands do not produce all pairs of their members. Every member is compared with a central one, the member
that meets most others over all bands. In bands whose members are still in different components, long
sketches are compared in blocks inside tasks, and only pairs that agree enough and join two components
leave: first the best partner of each member, in the end every such pair. So no pair of a band that
could join two components is left out.

Equal texts are one group whatever they hold; null and empty texts are equal texts. A text of one to four
words is one shingle. Rows with equal texts share a group, repeated rows too. A null id is the last choice
for a group's representative. Other columns do not matter, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.llm import words
from tablewarden.llm.common import col
from tablewarden.llm.graph import components
from tablewarden.session import materialize

THRESHOLD = 0.8
BANDS, ROWS = 10, 3
SAMPLES = BANDS * ROWS
# Of a pair at the threshold, about 25.5 of 30 two-bit codes agree; fewer than this do in one of 3,000.
LEAST_AGREEING = 18
# Long sketches: of 1,024 codes about 870 agree at the threshold, fewer than this in one of 30,000 pairs.
LONG, LEAST_LONG = 1024, 825
TURNS, BLOCK = 1, 512
CELLS = 1 << 18
RARE, FLOOR = 0.02, 0.5
HOT = 0.001  # of all rows; smaller groups cannot make a shingle frequent
_HALF = 0x5555555555555555


def _cell(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(46)).astype(np.int64)


def plain_bands(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Band keys (text x band) of min-hashes over distinct shingles, all of one weight; texts without shingles have zeros."""
    out = np.zeros((len(first) - 1, BANDS), dtype=np.uint64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        keys = np.random.default_rng(8).integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for k, key in enumerate(keys):
            h = (values ^ key) * np.uint64(0x9FB21C651E98DF25)
            h ^= h >> np.uint64(32)
            least = np.minimum.reduceat(h * key, first[full])
            out[full, k // ROWS] = words.mix(out[full, k // ROWS] * np.uint64(0x9E3779B97F4A7C15) + least + np.uint64(k))
    return out


def hot_bands(df: DataFrame, text: str = "text") -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each band the buckets with at least ``HOT`` of all rows, at most 1,000, and their numbers of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in words.blocks(batch.column(0)):
                values, _, first = words.distinct(*words.text_shingles(data, offsets))
                found = plain_bands(values, first).view(np.int64)
                for k in range(BANDS):
                    buckets, n = np.unique(found[:, k], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(buckets), k, np.int32)), pa.array(buckets), pa.array(n.astype(np.int64))],
                        names=["band", "bucket", "n"])

    least = max(2, int(HOT * df.count()))
    rows = (
        df.select(col(text)).mapInArrow(run, "band int, bucket long, n long").groupBy("band", "bucket").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least).orderBy("band", "bucket").toArrow())
    band, bucket, n = (rows[c].to_numpy() for c in ("band", "bucket", "n"))
    return [(bucket[band == k], n[band == k].astype(np.float64)) for k in range(BANDS)]


def _parts(found: np.ndarray, hot: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For how much of a document each text counts."""
    size = np.ones(len(found))
    for k, (buckets, n) in enumerate(hot):
        if len(buckets):
            own = np.ascontiguousarray(found[:, k]).view(np.int64)
            at = np.minimum(np.searchsorted(buckets, own), len(buckets) - 1)
            size = np.maximum(size, np.where(buckets[at] == own, n[at], 1.0))
    return 1.0 / size


def cell_weights(df: DataFrame, text: str = "text") -> np.ndarray:
    """The clipped inverse document frequency of every cell, from all documents. Its size is fixed."""
    shared = df.sparkSession.sparkContext.broadcast(hot_bands(df, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(CELLS), 0.0
        for batch in batches:
            for _, _, data, offsets in words.blocks(batch.column(0)):
                values, _, first = words.distinct(*words.text_shingles(data, offsets))
                part = _parts(plain_bands(values, first), shared.value)
                n += part.sum()
                counts += np.bincount(_cell(values), np.repeat(part, np.diff(first)), CELLS)
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(cells, -1)), pa.array(np.append(counts[cells], n))], names=["cell", "n"])

    summed = df.select(col(text)).mapInArrow(run, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells, counts = np.array(summed["cell"], dtype=np.int64), np.array(summed["n"], dtype=np.float64)
    total = counts[cells == -1].sum()
    out = np.ones(CELLS, dtype=np.float64)
    seen = cells >= 0
    # A shingle is in one document at least. Sums of parts depend on their order; rounding takes that away.
    often = np.round(np.maximum(total, 1.0) / np.maximum(counts[seen], 1.0), 6)
    out[cells[seen]] = np.round(np.clip(np.log(np.maximum(often, 1.0)) / np.log(1 / RARE), FLOOR, 1.0), 6)
    return out


class Sampler:
    """Tables of the random variables of consistent weighted sampling; the same on every machine."""

    def __init__(self, weights: np.ndarray, samples: int = SAMPLES, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.weights = weights
        self.scale = rng.gamma(2.0, 1.0, 1 << 16).astype(np.float32)
        self.level = np.log(rng.gamma(2.0, 1.0, 1 << 16)).astype(np.float32)
        self.keys = rng.integers(0, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def bag(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct shingles of each text, their weights, and each text's first index."""
        values, counts, first = words.distinct(*words.text_shingles(data, offsets))
        return values, counts * self.weights[_cell(values)], first

    def draw(self, values: np.ndarray, weights: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Sample codes (text x sample); texts without shingles have zeros."""
        full = np.flatnonzero(np.diff(first))
        out = np.zeros((len(first) - 1, len(self.keys)), dtype=np.uint64)
        if not len(full):
            return out
        start, size = first[full], np.diff(first)[full]
        log_weight = np.log(weights).astype(np.float32)
        owner = np.repeat(np.arange(len(full)), size)
        for k, key in enumerate(self.keys):
            h = values ^ key
            h *= np.uint64(0x9FB21C651E98DF25)
            h ^= h >> np.uint64(32)
            h *= key
            h ^= h >> np.uint64(29)
            lanes = h.view(np.uint16).reshape(-1, 4)
            r = self.scale[lanes[:, 1]]
            beta = lanes[:, 3].astype(np.float32) * np.float32(1 / 65536)
            t = np.floor(log_weight / r + beta)
            a = self.level[lanes[:, 2]] - r * (t - beta + 1)
            least = np.minimum.reduceat(a, start)
            hit = np.flatnonzero(a == least[owner])
            of = owner[hit]
            hit = hit[np.concatenate([[True], of[1:] != of[:-1]])]
            code = values[hit] + t[hit].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)
            out[full, k] = words.mix(code)
        return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags (distinct values, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = float(np.minimum(a[1][i], b[1][j]).sum())
    high = float(a[1].sum() + b[1].sum()) - low
    return low / high if high else 1.0


def signatures(df: DataFrame, sampler: Sampler, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, node (a digest of the text), two-bit codes of all samples, and band keys (null: no words)."""
    shared = df.sparkSession.sparkContext.broadcast(sampler)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        for batch in batches:
            for i, j, data, offsets in words.blocks(batch.column(1)):
                values, weights, first = s.bag(data, offsets)
                codes = s.draw(values, weights, first)
                bits = np.zeros(len(codes), dtype=np.uint64)
                for k in range(SAMPLES):
                    bits |= (codes[:, k] & np.uint64(3)) << np.uint64(2 * k)
                bands = np.zeros((len(codes), BANDS), dtype=np.uint64)
                for r in range(ROWS):
                    bands = bands * np.uint64(0x9E3779B97F4A7C15) + codes[:, r::ROWS]
                bands = words.mix(bands).view(np.int64)
                worded = np.diff(first) > 0
                nodes = [hashlib.md5(data[a:b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                ends = np.concatenate([[0], np.cumsum(np.where(worded, BANDS, 0))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(nodes, pa.string()), pa.array(bits.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bands[worded].ravel()))],
                    names=["doc_id", "node", "bits", "bands"],
                )

    return df.select(col(key).cast("long"), col(text)).mapInArrow(run, "doc_id long, node string, bits long, bands array<long>")


def _differ(a: Column, b: Column) -> Column:
    """How many two-bit codes of two longs differ."""
    x = a.bitwiseXOR(b)
    return F.bit_count(x.bitwiseOR(F.shiftright(x, 1)).bitwiseAND(F.lit(_HALF)))


def _agree(a: Column, b: Column) -> Column:
    """Whether enough two-bit codes are equal."""
    return _differ(a, b) <= SAMPLES - LEAST_AGREEING


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many codes of long sketches agree, of every row of ``a`` with every row of ``b``."""
    out = np.empty((len(a), len(b)), dtype=np.int32)
    for k in range(0, len(a), 32):
        x = a[k : k + 32, None, :] ^ b[None, :, :]
        x |= x >> np.uint64(1)
        x &= np.uint64(_HALF)
        out[k : k + 32] = LONG - np.bitwise_count(x).sum(axis=2, dtype=np.int32)
    return out


def _candidates(open_: DataFrame, every: bool) -> DataFrame:
    """Pairs (a, b) of different components in open bands whose long sketches agree enough.

    ``every`` gives all of them, else only the best partner of each member in each block. Bands are met in
    blocks of bounded size; small bands share a task's call.
    """
    rows = open_.count()
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least(F.col("block"), other).alias("i"), F.greatest(F.col("block"), other).alias("j")))
    shared = F.concat(F.lit("small "), F.pmod(F.xxhash64("band", "bucket"), F.lit(rows // 2000 + 1)))
    group = F.when(F.col("blocks") == 1, shared).otherwise(F.concat_ws(" ", "band", "bucket", "meet.i", "meet.j"))
    met = open_.withColumn("blocks", blocks).withColumn("block", own).withColumn("meet", F.explode(meets)).select(
        group.alias("group"), "band", "bucket", F.col("meet.i").alias("i"), F.col("meet.j").alias("j"), "block", "node", "label", "bands", "long")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        for (band, _), part in frame.groupby(["band", "bucket"]):
            node, label, block = part["node"].to_numpy(), part["label"].to_numpy(), part["block"].to_numpy()
            sketch = np.stack(part["long"].to_numpy()).astype(np.int64).view(np.uint64)
            i, j = part["i"].iloc[0], part["j"].iloc[0]
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            agree = _agreement(sketch[left], sketch[right])
            agree[label[left][:, None] == label[right][None, :]] = -1
            if every:
                x, y = np.nonzero(agree >= LEAST_LONG)
            else:
                x = np.concatenate([np.arange(len(left)), agree.argmax(axis=0)]) if agree.size else np.zeros(0, int)
                y = np.concatenate([agree.argmax(axis=1), np.arange(len(right))]) if agree.size else np.zeros(0, int)
                good = agree[x, y] >= LEAST_LONG if agree.size else np.zeros(0, bool)
                x, y = x[good], y[good]
            # A pair leaves from the first band that it shares.
            bands = np.stack(part["bands"].to_numpy())
            once = (bands[left[x]] == bands[right[y]]).argmax(axis=1) == band
            x, y = x[once], y[once]
            a.append(node[left[x]])
            b.append(node[right[y]])
        a, b = np.concatenate(a).astype(str), np.concatenate(b).astype(str)
        return pd.DataFrame({"a": np.where(a > b, a, b), "b": np.where(a > b, b, a)}).drop_duplicates()

    return met.groupBy("group").applyInPandas(run, "a string, b string").distinct()


def _long_sketches(texts: DataFrame, weights: np.ndarray) -> DataFrame:
    """(node, long): two-bit codes of ``LONG`` samples, 32 in a number."""
    shared = texts.sparkSession.sparkContext.broadcast(Sampler(weights, LONG, seed=4))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        for batch in batches:
            for i, j, data, offsets in words.blocks(batch.column(1)):
                codes = s.draw(*s.bag(data, offsets)) & np.uint64(3)
                packed = np.zeros((len(codes), LONG // 32), dtype=np.uint64)
                for k in range(32):
                    packed |= codes[:, k::32] << np.uint64(2 * k)
                ends = np.arange(len(codes) + 1, dtype=np.int32) * (LONG // 32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(ends), pa.array(packed.view(np.int64).ravel()))],
                    names=["node", "long"],
                )

    # Few rows of much work: spread by number of tasks, not by bytes.
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return texts.select("node", "text").repartition(tasks, "node").mapInArrow(run, "node string, long array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, sampler: Sampler, threshold: float) -> DataFrame:
    """Pairs (a, b) whose weighted Jaccard similarity, from whole texts, reaches the threshold."""
    shared = pairs.sparkSession.sparkContext.broadcast(sampler)
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        last, bag = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = np.zeros(len(a), dtype=bool)
            for i, j, data, offsets in words.blocks(batch.column(2)):
                values, weights, first = s.bag(data, offsets)
                for k in range(i, j):
                    if b[k] != last:  # rows of one partner come in turn
                        last, one = b[k], words.flat(batch.column(3).slice(k, 1))
                        bag = s.bag(*one)[:2]
                    own = slice(first[k - i], first[k - i + 1])
                    keep[k] = similarity((values[own], weights[own]), bag) >= threshold
            yield batch.select([0, 1]).filter(pa.array(keep))

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a string, b string")


def _with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.select(F.col("node").alias("__node"), "component")
    return rows.join(known, F.col("node") == F.col("__node"), "left").withColumn(
        "label", F.coalesce("component", "node")).drop("__node", "component")


def _open(rows: DataFrame) -> DataFrame:
    """Members of bands that hold more than one component, with the number of members."""
    split = rows.groupBy("band", "bucket", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("band", "bucket").agg(
        F.sum("n").alias("size"), F.count(F.lit(1)).alias("labels")).where("labels > 1 and size > 2")
    return rows.join(split.drop("labels"), ["band", "bucket"])


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, node, class_id (smallest id of its group), class_node, copies (rows with its text) and kept."""
    weights = cell_weights(df, text)
    sampler = Sampler(weights)
    signed = materialize(signatures(df, sampler, key, text), "signatures")
    nodes = materialize(
        signed.groupBy("node").agg(
            F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"), F.first("bits").alias("bits"), F.first("bands").alias("bands")),
        "texts",
    )
    members = nodes.select("node", "bits", F.posexplode("bands").alias("band", "bucket"))
    sizes = members.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    placed = materialize(
        members.join(sizes, ["band", "bucket"])
        .withColumn("met", F.sum("size").over(Window.partitionBy("node")))
        .select("band", "bucket", "node", "bits", "met"),
        "bands",
    )
    # The texts that pairs may ask for, one row each: those of nodes in shared bands.
    wanted = placed.select("node").distinct().join(nodes.select("node", "least"), "node")
    body = F.coalesce(col(text), F.lit(""))
    bodies = df.select(F.md5(body.cast("binary")).alias("node"), col(key).cast("long").alias("__id"), body.alias("text"))
    texts = materialize(
        bodies.join(wanted.withColumnRenamed("node", "__node"), (F.col("node") == F.col("__node")) & F.col("__id").eqNullSafe(F.col("least")))
        .groupBy("node").agg(F.first("text").alias("text")),
        "bodies",
    )
    # A star in every band: everybody against the central member.
    centres = placed.groupBy("band", "bucket").agg(F.max(F.struct("met", "node", "bits")).alias("centre"))
    stars = placed.join(centres, ["band", "bucket"]).where(
        (F.col("node") != F.col("centre.node")) & _agree(F.col("bits"), F.col("centre.bits")))
    tried = materialize(
        stars.select(F.greatest("node", "centre.node").alias("a"), F.least("node", "centre.node").alias("b")).distinct(), "stars")
    linked = materialize(_verified(tried, texts, sampler, threshold), "links")
    labels = components(linked)

    # Bands that are still open: best partners first, which joins most, then all that is left.
    open_ = materialize(_open(_with_labels(placed.drop("met", "bits"), labels)), "open")
    sketched = materialize(_long_sketches(texts.join(open_.select("node").distinct(), "node"), weights), "sketches")
    rest = materialize(open_.join(sketched, "node").join(nodes.select("node", "bands"), "node"), "open")
    for turn in range(TURNS + 1):
        if turn:
            rest = materialize(_open(_with_labels(rest.drop("label", "size"), labels)), "open")
        pairs = _candidates(rest, every=turn == TURNS)
        pairs = materialize(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = tried.unionByName(pairs)
        found = materialize(_verified(pairs, texts, sampler, threshold), "links")
        if not found.isEmpty():
            linked = linked.unionByName(found)
            labels = components(linked)

    grown = _with_labels(nodes.select("node", "copies", "least"), labels)
    best = grown.groupBy("label").agg(F.min(F.struct(F.col("least").isNull(), "least", "node")).alias("best"))
    table = grown.join(best, "label").select(
        "node", "copies", F.col("best.least").alias("class_id"), F.col("best.node").alias("class_node"))
    return signed.select("doc_id", "node").join(table, "node").select(
        "doc_id", "node", "class_id", "class_node", "copies",
        ((F.col("node") == F.col("class_node")) & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"))


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row of each group, with all columns: the one with the smallest id; of repeated rows any one."""
    kept = groups(df, key, text, threshold).where("kept").select(
        F.col("doc_id").alias("__id"), F.col("node").alias("__node")).distinct()
    node = F.md5(F.coalesce(col(text), F.lit("")).cast("binary"))
    rows = df.withColumn("__text_node", node).join(
        kept, (F.col("__text_node") == F.col("__node")) & col(key).cast("long").eqNullSafe(F.col("__id")))
    return rows.dropDuplicates(["__text_node"]).select(*(col(c) for c in df.columns))

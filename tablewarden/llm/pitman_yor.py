"""Language-model scores by a hierarchical Pitman-Yor model of words and their predecessors.

Every context (the word before, or the start of a text) is a restaurant whose customers are the words that
follow it in the training texts; all contexts share one parent, a restaurant whose customers are the
tables of the contexts, over a uniform base. Seating is sampled by Gibbs: turn by turn all customers of a
dish rise and are seated again one after the other, given the tables of the other dishes; a Metropolis
step corrects for the order. Table counts are averaged over the turns after the first ones, and with them
the predictive probability

    P(w | u) = (c_uw - d t_uw) / (theta + c_u) + (theta + d t_u) / (theta + c_u) P(w),

which sums to one over the vocabulary and the unknown word. Contexts are seated given the parent's
probabilities from the counts of all words, then the parent is seated given all their tables.

In a turn the dishes of a restaurant are seated at the same time, given its tables after the turn before;
a context that is dealt over several owners takes its own tables times their number for all of them.

Texts are lower-cased (A-Z), cut into words, and closed by one end token. Null and empty texts are one end
token. Rows whose key is null are training rows. Without training rows every token is unknown. Repeated
rows count as often as they occur. Other columns do not matter, whatever their names.

Nothing is broadcast but the words with at least a millionth of all tokens (a million at most). Texts
become chunks of word numbers with their own small vocabularies. A chunk asks the owner of each of its
words and pairs once, however often they occur in it, and gets back what it needs for its texts. The
counts of words that are not broadcast travel with their pairs. Owners
are chosen by hash; contexts with many words are dealt over several owners. Steps are tables in the
shared folder, so lost executors cost a repetition of the step. In pairs, words are known by 40 bits of
their hash; counts for the base score use all 64.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.llm import words
from tablewarden.llm.common import col
from tablewarden.llm.toxicity import held_out
from tablewarden.session import scratch_path

CHUNK_TOKENS = 2_000_000
OWNER_PAIRS = 1_500_000
COMMON = 1e-6
DISCOUNT, STRENGTH = 0.8, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.6, 1.0
BURN_IN, KEPT = 2, 4
_SLICE = 250_000  # tokens that are scored at once
_FEW = 64  # so many dishes are seated one by one, since array calls would cost more
_STEP = 64  # customers seated step by step; later ones from one that may open a table to the next

_END, _START = np.uint64(1), np.uint64(2)
_LOW = np.uint64((1 << 40) - 1)

_CHUNK = "chunk string, doc_id array<long>, held array<boolean>, size array<int>, ids binary, vocabulary binary, counts binary"
_MAIL = "kind int, target int, chunk string, a binary, b binary, total double"
_COUNTED = "kind int, word long, n long, chunk string, target int, counts binary"
_WORDS = "chunk string, target int, counts binary, root binary, back binary"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _stored(df: DataFrame, name: str, *by: str) -> tuple[DataFrame, str]:
    """A step's table and its path; shuffle files of finished steps are released."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    schema = df.schema
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path), path


def _removed(spark: SparkSession, path: str) -> None:
    """Remove a table of this run that no later step reads."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _numbers(row: dict) -> np.ndarray:
    """The word numbers of a chunk."""
    return np.frombuffer(pa.decompress(row["ids"], decompressed_size=4 * int(np.sum(row["size"])), codec="zstd", asbytes=True), "<i4")


def _z(x: np.ndarray, kind: str) -> bytes:
    """Numbers of a kind, compressed: mail and chunks are written, shuffled and read several times."""
    plain = np.ascontiguousarray(x.astype(kind)).tobytes()
    return len(plain).to_bytes(8, "little") + pa.compress(plain, codec="zstd", asbytes=True)


def _unz(b: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(b[:8], "little")
    return np.frombuffer(pa.decompress(b[8:], decompressed_size=size, codec="zstd", asbytes=True), kind)


def _z_rising(x: np.ndarray) -> bytes:
    """Rising unsigned numbers as their differences."""
    return _z(np.diff(x.astype("<u8"), prepend=np.uint64(0)), "<u8")


def _unz_rising(b: bytes) -> np.ndarray:
    return np.cumsum(_unz(b, "<u8"), dtype=np.uint64)


def _joined(*parts: bytes) -> bytes:
    return b"".join(len(x).to_bytes(8, "little") + x for x in parts)


def _parted(b: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(b):
        end = at + 8 + int.from_bytes(b[at : at + 8], "little")
        out.append(b[at + 8 : end])
        at = end
    return out


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of a rising array, and where each one begins (with the end)."""
    first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, dtype=np.int64)
    return x[first], np.append(first, len(x))


def _pack40(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpack40(x: bytes) -> np.ndarray:
    out = np.zeros((len(x) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(x, dtype=np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def _spread(h: np.ndarray) -> np.ndarray:
    return words.mix(h * np.uint64(0x9E3779B97F4A7C15))


def _home(h40: np.ndarray, owners: int) -> np.ndarray:
    """The owner of a word."""
    return (_spread(h40) % np.uint64(owners)).astype(np.int64)


def chunks(df: DataFrame, key: str, text: str, folds: int) -> DataFrame:
    """Texts as word numbers, with the chunk's distinct words and their counts in training texts."""

    def packed(name: str, rows: list[tuple]) -> pa.RecordBatch:
        ids, held, sizes, hashes = zip(*rows, strict=True)
        size = np.concatenate(sizes)
        held = np.concatenate(held)
        vocabulary, local = np.unique(np.concatenate(hashes), return_inverse=True)
        train = np.repeat(~held, size)
        counts = np.bincount(local[train], minlength=len(vocabulary))
        # The start is a word that each training text has once; it is not a token.
        at = int(np.searchsorted(vocabulary, _START))
        vocabulary = np.insert(vocabulary, at, _START)
        counts = np.insert(counts, at, (~held).sum())
        local = local + (local >= at)
        one = lambda x, kind: pa.array([x], kind)
        return pa.RecordBatch.from_arrays(
            [one(name, pa.string()), one([i for x in ids for i in x], pa.list_(pa.int64())), one(held.tolist(), pa.list_(pa.bool_())),
             one(size.tolist(), pa.list_(pa.int32())), one(pa.compress(local.astype("<i4").tobytes(), codec="zstd", asbytes=True), pa.binary()),
             one(_z_rising(vocabulary), pa.binary()), one(_z(counts, "<u8"), pa.binary())],
            names=["chunk", "doc_id", "held", "size", "ids", "vocabulary", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, rows, tokens = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for i, j, data, offsets in words.blocks(batch.column(2)):
                h, first = words.word_hashes(words.lower(data), offsets)
                h = np.insert(h | np.uint64(4), first[1:], _END)  # words are never END or START
                size = np.diff(first) + 1
                held = batch.column(1).slice(i, j - i).to_numpy(zero_copy_only=False).astype(bool)
                rows.append((batch.column(0).slice(i, j - i).to_pylist(), held, size, h))
                tokens += len(h)
                if tokens >= CHUNK_TOKENS:
                    yield packed(f"{part}-{number}", rows)
                    number, rows, tokens = number + 1, [], 0
        if rows:
            yield packed(f"{part}-{number}", rows)

    return df.select(col(key).cast("long"), held_out(col(key), folds).alias("held"), col(text)).mapInArrow(run, _CHUNK)


def _requests(table: DataFrame, owners: int) -> DataFrame:
    """Each chunk's words by owner: their hashes (a) and training counts (b), in the order of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, v, c in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                v, c = _unz_rising(v), _unz(c, "<u8")
                home = _home(v & _LOW, owners)
                order = np.argsort(home, kind="stable")
                which, cuts = _runs(home[order])
                parts = [order[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
                n = len(which)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([3] * n, pa.int32()), pa.array(which, pa.int32()), pa.array([chunk] * n, pa.string()),
                     pa.array([_z_rising(v[p]) for p in parts], pa.binary()), pa.array([_z(c[p], "<u8") for p in parts], pa.binary()),
                     pa.array([0.0] * n)],
                    names=["kind", "target", "chunk", "a", "b", "total"],
                )

    return table.select("chunk", "vocabulary", "counts").mapInArrow(run, _MAIL)


def _tally(group: pd.DataFrame) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Requests of one owner: per request where its words are among the distinct ones; these, and their counts."""
    asked = [_unz_rising(x) for x in group["a"]]
    counts = [_unz(x, "<u8") for x in group["b"]]
    distinct = np.unique(np.concatenate(asked))
    places = [np.searchsorted(distinct, x) for x in asked]
    total = np.zeros(len(distinct), dtype=np.int64)
    for at, c in zip(places, counts, strict=True):
        total[at] += c.astype(np.int64)  # the words of a request are distinct
    return places, distinct, total


def _pairs(ids: np.ndarray, size: np.ndarray, held: np.ndarray, start: int, n: int):
    """Distinct (predecessor, word) pairs of a chunk as one number each, their training counts, and each token's pair."""
    key = _before(ids, size, start).astype(np.int64) * n + ids
    order = np.argsort(key).astype(np.int32)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=bool)
    distinct, inverse = key[new], np.empty(len(key), dtype=np.int32)
    inverse[order] = np.cumsum(new, dtype=np.int32) - 1
    del key, order, new
    return distinct, np.bincount(inverse[np.repeat(~held, size)], minlength=len(distinct)), inverse


def _before(ids: np.ndarray, size: np.ndarray, start: int) -> np.ndarray:
    """The word before each token; ``start`` at the start of a text."""
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    out[np.cumsum(size) - size] = start
    return out


def _owner_of(u: np.ndarray, w: np.ndarray, owners: int, hot: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """The owner of a pair: by context, and for contexts with many words by word as well."""
    base = _spread(u ^ np.uint64(0x5BD1E995))
    if len(hot):
        at = np.minimum(np.searchsorted(hot, u), len(hot) - 1)
        share = np.where(hot[at] == u, parts[at], 1).astype(np.uint64)
        base = base + _spread(w) % share
    return (base % np.uint64(owners)).astype(np.int64)


def _deal(row: dict, owners: int, hot: np.ndarray, parts: np.ndarray):
    """A chunk's pairs in the order in which they are sent: context, word, count, owner, number of the word; each token's place."""
    v = _unz_rising(row["vocabulary"])
    ids, size, held = _numbers(row), np.array(row["size"]), np.array(row["held"], dtype=bool)
    start = int(np.searchsorted(v, _START))
    distinct, counts, inverse = _pairs(ids, size, held, start, len(v))
    u, w = v[distinct // len(v)] & _LOW, v[distinct % len(v)] & _LOW
    owner = _owner_of(u, w, owners, hot, parts)
    order = np.lexsort((w, u, owner))
    place = np.empty(len(order), dtype=np.int32)
    place[order] = np.arange(len(order))
    return u[order], w[order], counts[order], owner[order], (distinct % len(v))[order], place[inverse]


def _told(v: np.ndarray, owners: int, told: pd.Series, kind: str) -> np.ndarray:
    """What the owners of a chunk's words ``v`` say, in the order of the vocabulary; ``told`` is in the order of owners."""
    out = np.empty(len(v), dtype=kind)
    out[np.argsort(_home(v & _LOW, owners), kind="stable")] = np.concatenate([_unz(x, kind) for x in told])
    return out


def _pair_mail(table: DataFrame, counted: DataFrame, owners: int, common) -> DataFrame:
    """Each chunk's pairs by owner, with the training counts of their words where these are not broadcast (else 0)."""

    def run(key: tuple, own: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        known, _, hot, parts, _ = common.value
        row, out = own.iloc[0].to_dict(), []
        v = _unz_rising(row["vocabulary"])
        of_words = _told(v, owners, told.sort_values("target")["counts"], "<u8")
        of_words[np.isin(v & _LOW, known)] = 0
        u, w, counts, owner, word, _ = _deal(row, owners, hot, parts)
        which, cuts = _runs(owner)
        for k, first, last in zip(which.tolist(), cuts[:-1], cuts[1:], strict=True):
            own = slice(first, last)
            contexts, at = _runs(u[own])
            a = _joined(_z_rising(contexts), _z(np.diff(at), "<u4"))
            b = _joined(_pack40(w[own]), _z(counts[own], "<u4"), _z(of_words[word[own]], "<u8"))  # a chunk has fewer tokens than 2^32
            out.append((0, k, row["chunk"], a, b, 0.0))
        return pd.DataFrame(out, columns=["kind", "target", "chunk", "a", "b", "total"])

    return table.drop("doc_id", "counts").groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInPandas(run, _MAIL)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Up to a constant, for x of 12 or more."""
    return (x - 0.5) * np.log(x) - x + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)


def _seat_one(c: float, n: float, t: float, others: float, base: float, d: float, theta: float, rng) -> tuple[float, float]:
    """The same for one dish, which has ``n`` customers at ``t`` tables: its tables, and what its log weight grows by."""
    weight, u, k = 0.0, [], 0
    while n < c:
        if k >= len(u):
            u, k = (1 - rng.random(4096)).tolist(), 0
        opening = (theta + d * (others + t)) * base
        rest = opening - d * t
        total = rest + n
        at = min(n + math.log(u[k]) // math.log1p(-max(opening / total, 1e-300)), c)
        stops = at < c
        weight -= math.lgamma(total)
        n = at + stops
        weight += math.lgamma(rest + n)
        if stops and u[k + 1] * (rest + at) < total:
            t += 1
        k += 2
    return t, weight


def seat(c: np.ndarray, others: np.ndarray, base: np.ndarray, d: float, theta: float, rng) -> tuple[np.ndarray, np.ndarray]:
    """Seat ``c`` customers of each dish one after the other: tables, and the log of the step weights.

    ``others`` are the tables of other dishes, ``base`` the dish's probability in the parent.
    """
    tables, weight = np.ones(len(c)), np.zeros(len(c))
    active, n = np.flatnonzero(c > 1), 1
    while len(active) and n < _STEP:
        t = tables[active]
        opening = (theta + d * (others[active] + t)) * base[active]
        total = opening + n - d * t
        tables[active] += rng.random(len(active)) < opening / total
        weight[active] += np.log(total)
        n += 1
        active = active[c[active] > n]
    # While no table opens, the chance of one only falls: go to the next customer that would open one at the
    # present chance, and let it do so at the ratio of its own chance to that. This is the same law.
    seated = np.full(len(active), float(n))
    while len(active) > _FEW:
        t = tables[active]
        opening = (theta + d * (others[active] + t)) * base[active]
        rest = opening - d * t
        total = rest + seated
        skipped = np.floor(np.log(1 - rng.random(len(active))) / np.log1p(-np.maximum(opening / total, 1e-300)))
        at = np.minimum(seated + skipped, c[active])
        stops = at < c[active]
        tables[active] += stops & (rng.random(len(active)) * (rest + at) < total)
        seated = at + stops
        weight[active] += _log_gamma(rest + seated) - _log_gamma(total)
        left = seated < c[active]
        active, seated = active[left], seated[left]
    for k, n in zip(active.tolist(), seated.tolist(), strict=True):
        tables[k], more = _seat_one(float(c[k]), n, float(tables[k]), float(others[k]), float(base[k]), d, theta, rng)
        weight[k] += more
    return tables, weight


def gibbs(c: np.ndarray, restaurant: np.ndarray, base: np.ndarray, d: float, theta: float, rng, scale=1.0) -> np.ndarray:
    """Average table counts of dishes with ``c`` customers in their restaurants (0, 1, ...).

    ``scale`` is by how much a restaurant is larger than what is seen of it here.
    """
    tables = np.minimum(c, 1).astype(float)
    several = np.flatnonzero(c > 1)
    if not len(several):
        return tables
    weight, mean = np.full(len(several), -np.inf), np.zeros(len(several))
    n = int(restaurant.max()) + 1
    for turn in range(BURN_IN + KEPT):
        total = np.bincount(restaurant, tables, n)[restaurant[several]] * (scale if np.isscalar(scale) else scale[several])
        new, new_weight = seat(c[several], np.maximum(total - tables[several], 0), base[several], d, theta, rng)
        accept = np.log(rng.random(len(several))) < new_weight - weight
        tables[several] = np.where(accept, new, tables[several])
        weight = np.where(accept, new_weight, weight)
        if turn >= BURN_IN:
            mean += tables[several] / KEPT
    tables[several] = mean
    return tables


def _owner_step(owners: int, common):
    """One owner's pairs of all chunks: seats them, answers the chunks, and reports tables of words and contexts."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        known, share, hot, parts, train = common.value
        us, ws, cs, rare, from_ = [], [], [], [], []
        for a, b in zip(group["a"], group["b"], strict=True):
            contexts, runs = _parted(a)
            of_pairs, counts, of_words = _parted(b)
            us.append(np.repeat(_unz_rising(contexts), _unz(runs, "<u4")))
            m = len(us[-1])
            ws.append(_unpack40(of_pairs))
            cs.append(_unz(counts, "<u4"))
            rare.append(_unz(of_words, "<u8").astype("<f4"))  # a probability's numerator
            from_.append(m)
        u, w, own = np.concatenate(us), np.concatenate(ws), np.concatenate(cs).astype(np.int64)
        order = np.lexsort((w, u))
        su, sw = u[order], w[order]
        new = np.concatenate([[True], (su[1:] != su[:-1]) | (sw[1:] != sw[:-1])])
        pair = np.empty(len(u), dtype=np.int64)
        pair[order] = np.cumsum(new) - 1
        at = order[new]
        pu, pw = u[at], w[at]
        c = np.bincount(pair, own, len(at)).astype(np.int64)
        restaurant = np.cumsum(np.concatenate([[0], pu[1:] != pu[:-1]])).astype(np.int64)

        def looked_up(keys, values, x, default):
            if not len(keys):
                return np.full(len(x), default)
            k = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
            return np.where(keys[k] == x, values[k], default)

        sent = np.concatenate(rare)[at]
        base = np.where(sent > 0, sent / max(1, train), looked_up(known, share, pw, 0.0))
        tables = gibbs(
            c, restaurant, base, DISCOUNT, STRENGTH,
            np.random.default_rng((17, int(key[0]))), looked_up(hot, parts.astype(float), pu, 1.0))
        value = (c - DISCOUNT * tables).astype("<f4")
        out = []
        ends = np.cumsum(from_)
        for i, chunk in enumerate(group["chunk"]):
            mine = slice(ends[i] - from_[i], ends[i])
            told = np.flatnonzero((c[pair[mine]] != own[mine]) | (c[pair[mine]] > 1))
            out.append((0, int(key[0]), chunk, _z_rising(told), _z(value[pair[mine][told]], "<f4"), 0.0))
        for kind, names in ((1, pw), (2, pu)):
            some = c > 0
            distinct, inverse = np.unique(names[some], return_inverse=True)
            sums = np.bincount(inverse, tables[some], len(distinct))
            home = _home(distinct, owners)
            order = np.argsort(home, kind="stable")
            which, cuts = _runs(home[order])
            for k, first, last in zip(which.tolist(), cuts[:-1], cuts[1:], strict=True):
                part = order[first:last]
                out.append((kind, k, "", _z_rising(distinct[part]), _z(sums[part], "<f4"), float(sums[part].sum())))
        return pd.DataFrame(out, columns=["kind", "target", "chunk", "a", "b", "total"])

    return run


def _sums(group: pd.DataFrame, kind: int, ids: np.ndarray) -> np.ndarray:
    """What mail of a kind says about the words ``ids`` (40 bits, rising; several may be equal)."""
    out = np.zeros(len(ids))
    for a, b in group.loc[group["kind"] == kind, ["a", "b"]].itertuples(index=False):
        x = _unz_rising(a)
        at = np.minimum(np.searchsorted(ids, x), len(ids) - 1)
        hit = ids[at] == x
        np.add.at(out, at[hit], _unz(b, "<f4")[hit])
    return out


def _root_seats(customers: np.ndarray, target: int, vocabulary: int, totals: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Tables of the parent for words with so many customers, after as many turns as there are ``totals``: at present, and on average.

    ``totals`` are the parent's tables, of all words, before each turn.
    """
    c = np.rint(customers).astype(np.int64)
    c[(customers > 0) & (c == 0)] = 1
    several = np.flatnonzero(c > 1)
    tables = np.minimum(c, 1).astype(float)
    average = tables.copy()
    rng = np.random.default_rng((19, target))
    base = np.full(len(several), 1.0 / (vocabulary + 1))
    weight, mean = np.full(len(several), -np.inf), np.zeros(len(several))
    for turn, total in enumerate(totals):
        others = np.maximum(total - tables[several], 0)
        new, new_weight = seat(c[several], others, base, ROOT_DISCOUNT, ROOT_STRENGTH, rng)
        accept = np.log(rng.random(len(several))) < new_weight - weight
        tables[several] = np.where(accept, new, tables[several])
        weight = np.where(accept, new_weight, weight)
        if turn >= BURN_IN:
            mean += tables[several] / KEPT
    average[several] = mean
    return tables, average


def score(df: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 10) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10)."""
    spark: SparkSession = df.sparkSession
    table, _ = _stored(chunks(df, key, text, folds), "lm-chunks")
    size = table.agg(
        F.sum(F.aggregate("size", F.lit(0).cast("long"), lambda a, b: a + b)).alias("tokens")).first()
    owners = max(4, math.ceil((size["tokens"] or 0) / OWNER_PAIRS))

    def count(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        places, v, c = _tally(group)
        token = v != _START
        n = int(c[token].sum())
        common = c >= max(2, COMMON * n)  # more than enough: n is this owner's share only
        rows = [(-1, n), (-2, int((c[token] > 0).sum())), (-3, int(c[~token].sum()))]
        rows += [(int(a), int(b)) for a, b in zip((v[common] & _LOW).tolist(), c[common].tolist(), strict=True)]
        out = [(0, a, b, "", 0, b"") for a, b in rows]
        # What pairs know of their words: one count for all words that share 40 bits.
        _, to = np.unique(v & _LOW, return_inverse=True)
        shared = np.zeros(int(to.max()) + 1, dtype=np.int64)
        np.add.at(shared, to, c)
        of_pairs = shared[to]
        out += [(1, 0, 0, chunk, int(key[0]), _z(of_pairs[at], "<u8")) for chunk, at in zip(group["chunk"], places, strict=True)]
        return pd.DataFrame(out, columns=["kind", "word", "n", "chunk", "target", "counts"])

    told, of_words = _stored(_requests(table, owners).groupBy("target").applyInPandas(count, _COUNTED), "lm-words", "kind")
    counted = told.where("kind = 0")
    totals = {r["word"]: r["n"] for r in counted.where("word < 0").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    train, vocabulary, texts = (totals.get(k, 0) for k in (-1, -2, -3))
    frequent = counted.where((F.col("word") >= 0) & (F.col("n") >= max(2.0, COMMON * train))).orderBy("word").toArrow()
    known = np.array(frequent["word"], dtype=np.uint64)
    counts = np.array(frequent["n"], dtype=np.float64)
    start = known == _START & _LOW
    crowded = counts >= max(1, train) / (4 * owners)
    hot, parts = known[crowded], np.minimum(owners, np.ceil(4 * owners * counts[crowded] / max(1, train)))
    share = np.where(start, 0.0, counts / max(1, train))
    common = spark.sparkContext.broadcast((known, share, hot, parts, train))

    counts_of_words = told.where("kind = 1").select("chunk", "target", "counts")
    mail, of_mail = _stored(
        _pair_mail(table, counts_of_words, owners, common).groupBy("target").applyInPandas(_owner_step(owners, common), _MAIL), "lm-mail", "kind")
    mail = mail.select("kind", "target", "chunk", "a", "b", "total")
    _removed(spark, of_words)

    def root(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        ids = np.unique(np.concatenate([_unz_rising(x) for x in group["a"]]))
        return pd.DataFrame([(int(key[0]), _sums(group, 1, ids).tobytes())], columns=["target", "customers"])

    about_words = mail.where("kind = 1")
    customers = about_words.agg(F.sum("total")).first()[0] or 0.0
    parent, of_parent = _stored(about_words.groupBy("target").applyInPandas(root, "target int, customers binary"), "lm-parent")

    def parent_tables(totals: list[float], average: bool) -> float:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield pd.DataFrame({"tables": [
                    float(_root_seats(np.frombuffer(x), target, vocabulary, totals)[average].sum())
                    for target, x in zip(batch["target"].tolist(), batch["customers"], strict=True)]})

        return parent.mapInPandas(run, "tables double").agg(F.sum("tables")).first()[0] or 0.0

    turns: list[float] = []
    for _ in range(BURN_IN + KEPT):
        turns.append(parent_tables(turns, False))
    root_tables = parent_tables(turns, True)
    _removed(spark, of_parent)
    rest = (ROOT_STRENGTH + ROOT_DISCOUNT * root_tables) / (ROOT_STRENGTH + customers)
    unknown = rest / (vocabulary + 1)

    def answer(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        asked = group[group["kind"] == 3]
        if not len(asked):
            return pd.DataFrame({c: [] for c in ("chunk", "target", "counts", "root", "back")})
        places, distinct, c = _tally(asked)
        ids, to = np.unique(distinct & _LOW, return_inverse=True)
        n = _sums(group, 1, ids)
        tables = _root_seats(n, int(key[0]), vocabulary, turns)[1]
        p = (n - ROOT_DISCOUNT * tables) / (ROOT_STRENGTH + customers) + unknown
        used = np.where(distinct == _END, 0, c)
        back = (STRENGTH + DISCOUNT * _sums(group, 2, ids)[to]) / (STRENGTH + used)
        out = [
            (chunk, int(key[0]), _z(c[i], "<u8"), _z(p[to][i], "<f4"), _z(back[i], "<f4"))
            for chunk, i in zip(asked["chunk"], places, strict=True)]
        return pd.DataFrame(out, columns=["chunk", "target", "counts", "root", "back"])

    asked = _requests(table, owners).unionByName(mail.where("kind in (1, 2)"))
    answers, _ = _stored(asked.groupBy("target").applyInPandas(answer, _WORDS), "lm-answers")
    for kind in (1, 2):
        _removed(spark, f"{of_mail}/kind={kind}")

    def scores(key: tuple, own: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        row = own[own["vocabulary"].notna()].iloc[0].to_dict()
        v = _unz_rising(row["vocabulary"])
        told = told.sort_values("target")
        c, p, back = (
            _told(v, owners, told[column], kind).astype(to)
            for column, kind, to in (("counts", "<u8", np.int64), ("root", "<f4", float), ("back", "<f4", float)))
        _, _, counts, owner, _, place = _deal(row, owners, hot, parts)
        value = np.where(counts == 1, 1 - DISCOUNT, 0.0)
        for target, a, b in own.loc[own["kind"] == 0, ["target", "a", "b"]].itertuples(index=False):
            value[np.searchsorted(owner, int(target)) + _unz_rising(a).astype(np.int64)] = _unz(b, "<f4")
        ids, sizes = _numbers(row), np.array(row["size"], dtype=np.int64)
        before = _before(ids, sizes, int(np.searchsorted(v, _START)))
        first = np.cumsum(sizes) - sizes
        known, base_score, score_of = (np.empty(len(sizes)) for _ in range(3))
        at = 0
        while at < len(sizes):  # some texts at a time, so that few long arrays exist at once
            last = max(at + 1, int(np.searchsorted(first, first[at] + _SLICE, side="right")) - 1) if at + 1 < len(sizes) else at + 1
            part = slice(first[at], first[last] if last < len(sizes) else len(ids))
            word, context, own = ids[part], before[part], first[at:last] - first[at]
            chance = value[place[part]] / (STRENGTH + c[context]) + back[context] * p[word]
            known[at:last] = np.add.reduceat((c[word] > 0).astype(np.int64), own)
            base_score[at:last] = np.add.reduceat(np.log10((c[word] + 0.1) / (train + 0.1 * (vocabulary + 1))), own)
            score_of[at:last] = np.add.reduceat(np.log10(chance), own)
            at = last
        pa.default_memory_pool().release_unused()
        return pd.DataFrame({
            "doc_id": list(row["doc_id"]), "held_out": list(row["held"]), "n_tokens": sizes,
            "n_known": known.astype(np.int64), "base_score": base_score, "score": score_of,
        }).astype({"doc_id": "Int64"})

    texts_and_pairs = table.drop("counts").unionByName(
        mail.where("kind = 0").select("kind", "target", "chunk", "a", "b"), allowMissingColumns=True)
    return (
        texts_and_pairs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(scores, _SCORES)
        .withColumn("train_tokens", F.lit(train).cast("long"))
    )

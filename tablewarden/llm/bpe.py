"""Byte-level BPE encoding and decoding by vectorised pre-tokenisation and cached pair merging.

A block of texts is one byte array. Each code point has a class, each class is a transition function
between the states of the splitting pattern, and composing the functions is associative: states of all
positions come from a two-level scan over the composition table, without a regular expression. State
and class changes give the slices. Each distinct slice of a block is merged once, all slices together,
and its ids are copied to every place where it occurs. The byte offset of every id is retained, so
decoding can be checked piece by piece.

The pattern is the common one of byte-level BPE: contractions, an optional blank before letters, digits
or other marks, and white space of which the last character before a word stands alone.

Null texts count as empty: no ids. Texts of any length are encoded whole. Rows are handled one by one,
so repeated rows give repeated results, and other columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablewarden.llm import words

_CLASSES = ("letter", "digit", "blank", "space", "other", "quote", "s", "r", "v", "l", "e")
_STATES = ("start", "letter", "digit", "other", "quote", "qr", "qv", "ql", "done", "blank", "space")
_CLASS = {c: i for i, c in enumerate(_CLASSES)}
_STATE = {s: i for i, s in enumerate(_STATES)}
# The characters with the White_Space property.
_WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_ROW = 32
_NONE = np.int32(2**31 - 1)
_LONG = 256


def _step(state: str, cls: str) -> str:
    """The state after a character of class ``cls``.

    ``quote`` is an apostrophe that opens a slice, ``qr qv ql`` a contraction of two letters after its
    first, ``done`` the end of a contraction.
    """
    if cls in ("digit", "blank", "space", "other"):
        return cls
    if cls == "quote":
        return "other" if state in ("blank", "other", "quote") else "quote"
    if state == "quote" and cls in ("s", "r", "v", "l"):
        return "done" if cls == "s" else f"q{cls}"
    if (state, cls) in (("qr", "e"), ("qv", "e"), ("ql", "l")):
        return "done"
    return "letter"


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Generators by (first in text, class), the composition table, and each function's values."""
    size = len(_STATES)
    gens = [tuple(_STATE[_step(s, c)] for s in _STATES) for c in _CLASSES]
    gens += [(g[0],) * size for g in gens]
    known = {tuple(range(size)): 0}
    todo = [tuple(range(size))]
    while todo:
        f = todo.pop()
        for g in gens:
            h = tuple(g[x] for x in f)
            if h not in known:
                known[h] = len(known)
                todo.append(h)
    functions = np.array(list(known), dtype=np.uint8)
    table = np.empty((len(known), len(known)), dtype=np.uint16)
    for f, i in known.items():
        for g, j in known.items():
            table[i, j] = known[tuple(g[x] for x in f)]
    generators = np.array([known[g] for g in gens], dtype=np.uint16).reshape(2, len(_CLASSES))
    return generators, table.ravel(), functions


def _edges() -> np.ndarray:
    """Whether a slice starts between two states; white space runs and open contractions come later."""
    edge = np.zeros((len(_STATES), len(_STATES)), dtype=bool)
    white, open_ = ("blank", "space"), ("qr", "qv", "ql")
    for p in _STATES:
        for s in _STATES:
            if s in white:
                yes = p not in white
            elif p in white:
                yes = p == "space"
            elif s == "letter":
                yes = p not in ("letter", *open_)
            elif s == "digit":
                yes = p != "digit"
            elif s == "other":
                yes = p not in ("other", "quote")
            else:
                yes = s == "quote"
            edge[_STATE[p], _STATE[s]] = yes
    return edge


_GENERATORS, _COMPOSE, _FUNCTIONS = _monoid()
_EDGE = _edges()
_COUNT = len(_FUNCTIONS)


def code_point_classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, _CLASS["other"], dtype=np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = _CLASS["letter"]
        elif kind == "N":
            out[c] = _CLASS["digit"]
    out[list(_WHITE)] = _CLASS["space"]
    out[0x20] = _CLASS["blank"]
    out[ord("'")] = _CLASS["quote"]
    out[[ord(c) for c in "stmd"]] = _CLASS["s"]
    for c in "rvle":
        out[ord(c)] = _CLASS[c]
    return out


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions start[i], start[i] + 1, ... (size[i] of them), for all i in turn."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


_COMPARED = 1 << 18


def same_bytes(
    a: np.ndarray, a_start: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_start: np.ndarray, b_end: np.ndarray,
) -> np.ndarray:
    """Whether a[a_start[i]:a_end[i]] equals b[b_start[i]:b_end[i]], for all i."""
    size = a_end - a_start
    same = size == b_end - b_start
    some = np.flatnonzero(same & (size > 0))
    ends, at = np.cumsum(size[some]), 0
    while at < len(some):  # a bounded number of bytes at a time
        last = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _COMPARED, side="right")))
        part = some[at:last]
        n = size[part]
        equal = a[ragged(a_start[part], n)] == b[ragged(b_start[part], n)]
        same[part] = np.logical_and.reduceat(equal, np.cumsum(n) - n)
        at = last
    return same


def _scan(f: np.ndarray) -> np.ndarray:
    """Inclusive prefix compositions of function ids, by rows of ``_ROW`` and then over the row totals."""
    n = len(f)
    if n <= 1:
        return f
    rows = -(-n // _ROW)
    grid = np.zeros(rows * _ROW, dtype=np.uint16)
    grid[:n] = f
    grid = np.ascontiguousarray(grid.reshape(rows, _ROW).T)
    for j in range(1, _ROW):
        grid[j] = _COMPOSE[grid[j - 1].astype(np.int32) * _COUNT + grid[j]]
    if rows > 1:
        before = np.zeros(rows, dtype=np.int32)
        before[1:] = _scan(grid[-1].copy())[:-1]
        before *= _COUNT
        for j in range(_ROW):
            grid[j] = _COMPOSE[before + grid[j]]
    return grid.T.ravel()[:n]


def split(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The byte positions at which slices start, over a block of texts."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    code = data[lead].astype(np.int32)
    wide = np.flatnonzero(code >= 0x80)
    if len(wide):
        padded = np.concatenate([data, np.zeros(3, dtype=np.uint8)])
        first, at = code[wide], lead[wide]
        follow = [padded[at + k].astype(np.int32) & 0x3F for k in (1, 2, 3)]
        two = ((first & 0x1F) << 6) | follow[0]
        three = ((first & 0x0F) << 12) | (follow[0] << 6) | follow[1]
        four = ((first & 0x07) << 18) | (follow[0] << 12) | (follow[1] << 6) | follow[2]
        code[wide] = np.where(first < 0xE0, two, np.where(first < 0xF0, three, np.minimum(four, 0x10FFFF)))
    cls = classes[code]
    opens = np.zeros(len(lead) + 1, dtype=bool)
    opens[np.searchsorted(lead, offsets)] = True  # the first characters of texts, and the end
    state = _FUNCTIONS[_scan(_GENERATORS[opens[:-1].astype(np.uint8), cls]), 0]

    before = np.concatenate([[0], state[:-1]]).astype(np.uint8)
    after = np.concatenate([state[1:], [0]]).astype(np.uint8)
    start = _EDGE[before, state]
    white = state >= _STATE["blank"]
    # Inside a run of white space only the last character before a word stands apart.
    next_word = np.zeros(len(lead), dtype=bool)
    next_word[:-1] = ~white[1:]
    start |= white & (before >= _STATE["blank"]) & next_word & ~opens[1:]
    # An open contraction that is not completed leaves its apostrophe alone.
    pending = (state >= _STATE["qr"]) & (state <= _STATE["ql"])
    start |= pending & ((after != _STATE["done"]) | opens[1:])
    start |= opens[:-1]
    return lead[start]


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of byte strings from lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in (x.split() for x in lines if x.strip())}


class Vocabulary:
    """Look-up tables of a rank file; their size is set by the file, so they are broadcast."""

    def __init__(self, ranks: dict[bytes, int]):
        if len(ranks) > 1 << 16 or max(ranks.values()) >= 1 << 16:
            raise ValueError("ranks must be below 65,536")
        self.classes = code_point_classes()
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = {}
        for word, rank in ranks.items():
            for cut in range(1, len(word)):
                left, right = ranks.get(word[:cut]), ranks.get(word[cut:])
                if left is not None and right is not None:
                    pairs[(left << 16) | right] = rank
        self.pair_keys = np.array(sorted(pairs), dtype=np.uint32)
        self.pair_ranks = np.array([pairs[int(k)] for k in self.pair_keys], dtype=np.int32)
        by_id = sorted(ranks, key=ranks.get)
        ids = np.array([ranks[w] for w in by_id])
        self.size = np.zeros(int(ids[-1]) + 1, dtype=np.int64)
        self.size[ids] = [len(w) for w in by_id]
        self.offset = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(by_id), dtype=np.uint8)
        start = self.offset[ids]
        keys = words.hashes(self.bytes, start, start + self.size[ids])
        order = np.argsort(keys)
        self.word_keys, self.word_ids = keys[order], ids[order].astype(np.int32)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.uint32) << np.uint32(16)) | b.astype(np.uint32)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NONE)

    def merge_one(self, piece: np.ndarray) -> np.ndarray:
        """Pair merging of one long slice with a heap of pairs, in n log n steps."""
        ids = [int(x) for x in self.byte_ids[piece]]
        n = len(ids)
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        table = dict(zip(self.pair_keys.tolist(), self.pair_ranks.tolist(), strict=True))
        heap = []

        def push(i: int) -> None:
            j = following[i]
            if j < n and (rank := table.get((ids[i] << 16) | ids[j])) is not None:
                heapq.heappush(heap, (rank, i, ids[i], j, ids[j]))

        for i in range(n - 1):
            push(i)
        while heap:
            rank, i, left, j, right = heapq.heappop(heap)
            if not alive[i] or following[i] != j or ids[i] != left or not alive[j] or ids[j] != right:
                continue
            ids[i], alive[j] = rank, False
            following[i] = following[j]
            if following[j] < n:
                previous[following[j]] = i
            push(i)
            if previous[i] >= 0:
                push(previous[i])
        return np.array([x for x, keep in zip(ids, alive, strict=True) if keep], dtype=np.int32)

    def merge(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray):
        """Ids of every slice: (all ids, first index of each slice, number of each slice)."""
        n = len(start)
        count = np.zeros(n, dtype=np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        at = np.minimum(np.searchsorted(self.word_keys, keys), len(self.word_keys) - 1)
        hit = np.flatnonzero(self.word_keys[at] == keys)
        ids = self.word_ids[at[hit]]
        begin = self.offset[ids]
        equal = same_bytes(data, start[hit], end[hit], self.bytes, begin, begin + self.size[ids])
        whole = np.zeros(n, dtype=bool)
        whole[hit[equal]] = True
        count[whole] = 1
        parts.append((hit[equal], ids[equal]))
        size = end - start
        for i in np.flatnonzero(~whole & (size > _LONG)):
            ids = self.merge_one(data[start[i] : end[i]])
            count[i] = len(ids)
            parts.append((np.array([i]), ids))

        word = np.flatnonzero(~whole & (size <= _LONG))
        lens = size[word]
        sym = self.byte_ids[data[ragged(start[word], lens)]]
        ranks = np.full(len(sym), _NONE, dtype=np.int32)
        if len(sym):
            ranks[:-1] = self.pair(sym[:-1], sym[1:])
            ranks[np.cumsum(lens) - 1] = _NONE
        while len(word):
            first = np.cumsum(lens) - lens
            least = np.minimum.reduceat(ranks, first)
            ended = least == _NONE
            if ended.any():
                of_ended = np.repeat(ended, lens)
                count[word[ended]] = lens[ended]
                parts.append((word[ended], sym[of_ended]))
                sym, ranks = sym[~of_ended], ranks[~of_ended]
                word, lens, least = word[~ended], lens[~ended], least[~ended]
                if not len(word):
                    break
                first = np.cumsum(lens) - lens
            own = np.repeat(np.arange(len(word)), lens)
            hit = np.flatnonzero(ranks == least[own])
            of = own[hit]
            hit = hit[np.concatenate([[True], of[1:] != of[:-1]])]  # the leftmost of each slice
            sym[hit] = least
            keep = np.ones(len(sym), dtype=bool)
            keep[hit + 1] = False
            sym, ranks = sym[keep], ranks[keep]
            lens = lens - 1
            hit = hit - np.arange(len(hit))
            first = np.cumsum(lens) - lens
            ranks[hit] = _NONE
            more = hit < first + lens - 1
            at_left = hit[more]
            ranks[at_left] = self.pair(sym[at_left], sym[at_left + 1])
            at_left = hit[hit > first] - 1
            ranks[at_left] = self.pair(sym[at_left], sym[at_left + 1])
        offset = np.cumsum(count) - count
        out = np.empty(int(count.sum()), dtype=np.int32)
        for which, ids in parts:
            out[ragged(offset[which], count[which])] = ids
        return out, offset, count

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a block of texts, and the index of each text's first id."""
        start = split(data, offsets, self.classes)
        end = np.append(start[1:], len(data)).astype(np.int64)
        keys = words.hashes(data, start, end)
        _, sample, inverse = np.unique(keys, return_index=True, return_inverse=True)
        # Slices share ids only where their bytes are equal; those that share a hash alone stand for themselves.
        odd = np.flatnonzero(~same_bytes(data, start, end, data, start[sample[inverse]], end[sample[inverse]]))
        inverse[odd] = len(sample) + np.arange(len(odd))
        sample = np.concatenate([sample, odd])
        ids, offset, count = self.merge(data, start[sample], end[sample], keys[sample])
        each = count[inverse]
        out = ids[ragged(offset[inverse], each)]
        before = np.concatenate([[0], np.cumsum(each)])
        return out, before[np.searchsorted(start, offsets)]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of a run of ids, and the byte offset of each id (with the end)."""
        size = self.size[ids]
        return self.bytes[ragged(self.offset[ids], size)], np.concatenate([[0], np.cumsum(size)])


def _run(df: DataFrame, vocabulary: Vocabulary, text: str, keep: tuple[str, ...], fields: list, rows) -> DataFrame:
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in words.blocks(batch.column("__text")):
                kept = [batch.column(k).slice(i, j - i) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, *rows(shared.value, data, offsets)], names=names)

    return df.selectExpr(*(f"`{c}`" for c in keep), f"`{text}` as __text").mapInArrow(run, schema)


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: the kept columns, ``ids`` and ``offsets`` (first byte of each id in the text)."""

    def rows(v, data, offsets):
        ids, first = v.encode(data, offsets)
        _, at = v.decode(ids)
        at = at[:-1] - np.repeat(at[first[:-1]], np.diff(first))
        return [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x, pa.int32())) for x in (ids, at)]

    ints = T.ArrayType(T.IntegerType())
    return _run(df, vocabulary, text, keep, [T.StructField("ids", ints), T.StructField("offsets", ints)], rows)


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: the kept columns and ``text``; null ids give an empty text."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("text", T.StringType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for row in batch.column("__ids"):
                data, _ = shared.value.decode(np.array(row.as_py() or [], dtype=np.int64))
                texts.append(data.tobytes().decode("utf-8", errors="replace"))
            kept = [batch.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=names)

    return df.selectExpr(*(f"`{c}`" for c in keep), f"`{ids}` as __ids").mapInArrow(run, schema)


def digests(df: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: the kept columns, the number of ids, and SHA-256 of the ids and of the bytes they decode to."""

    def rows(v, data, offsets):
        ids, first = v.encode(data, offsets)
        decoded, at = v.decode(ids)
        packed, plain = memoryview(ids.astype("<u4").tobytes()), memoryview(decoded.tobytes())
        cut = at[first]
        of_ids = [hashlib.sha256(packed[4 * a : 4 * b]).hexdigest() for a, b in zip(first[:-1], first[1:], strict=True)]
        of_text = [hashlib.sha256(plain[a:b]).hexdigest() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return [pa.array(np.diff(first), pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]

    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    return _run(df, vocabulary, text, keep, fields, rows)

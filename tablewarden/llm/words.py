"""Vectorised word splitting, hashing and shingling of text batches inside tasks.

Texts come as Arrow string arrays. A block of texts is one byte array with offsets, and words, hashes
and shingles of the whole block are computed with a few array operations. Words are maximal runs of
bytes other than the ASCII white space 0x20 and 0x09 to 0x0D. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
BLOCK_BYTES = 4 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_MULTIPLIERS = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(64)], dtype=np.uint64)

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, BLOCK_BYTES + 1), base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, in place."""
    for shift, factor in ((32, _MIX[0]), (29, _MIX[1])):
        h ^= h >> np.uint64(shift)
        h *= factor
    h ^= h >> np.uint64(32)
    return h


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offsets of each text in them; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into blocks of whole texts: (first, past the last, bytes, offsets).

    A block has at most ``limit`` bytes, or a single text if that is longer.
    """
    data, offsets = flat(texts)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased; other bytes as they are."""
    return _LOWER[data]


def spans(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the index of its first word (n + 1 entries)."""
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    space = separator[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    cut[1:n] |= space[: n - 1]
    start = np.flatnonzero(cut[:n] & ~space)
    cut[:n] |= space
    end = np.flatnonzero(cut[1:] & ~space) + 1
    return start, end, np.searchsorted(start, offsets)


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every byte span, from one prefix sum over the block."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for each text the index of its first one."""
    start, end, first = spans(data, offsets)
    return hashes(data, start, end), first


def shingles(h: np.ndarray, first: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, and for each text the index of its first one.

    A text of one to k-1 words has one shingle, made of all its words; a text without words has none.
    """
    words = np.diff(first)
    left = np.repeat(first[1:], words) - np.arange(len(h))
    full = np.flatnonzero(left >= k)
    short = np.flatnonzero((words > 0) & (words < k))
    out = np.zeros(len(full) + len(short), dtype=np.uint64)
    at = np.concatenate([full, first[short]])
    order = np.argsort(at, kind="stable")
    at = at[order]
    size = np.minimum(left[at], k)
    for j in range(k):
        inside = size > j
        if inside.all():
            out += h[at + j] * _MULTIPLIERS[j]
        else:
            out[inside] += h[at[inside] + j] * _MULTIPLIERS[j]
    out += size.astype(np.uint64)
    return mix(out), np.searchsorted(at, first)


def text_shingles(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    return shingles(*word_hashes(data, offsets), k)


def distinct(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each text in rising order, how often each occurs, and the text's first index."""
    n = len(first) - 1
    values, counts, ends = [], [], np.zeros(n + 1, dtype=np.int64)
    for i in range(n):
        own = np.sort(h[first[i] : first[i + 1]])
        if len(own) > 1:
            new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            counts.append(np.diff(np.append(new, len(own))))
            own = own[new]
        else:
            counts.append(np.ones(len(own), dtype=np.int64))
        values.append(own)
        ends[i + 1] = ends[i] + len(own)
    if not n:
        return h[:0], np.zeros(0, dtype=np.int64), ends
    return np.concatenate(values), np.concatenate(counts), ends

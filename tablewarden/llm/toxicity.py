"""Toxicity by maximum-scoring segments of token log-odds, calibrated as extreme values.

Tokens are runs of letters, A-Z lower-cased. A token's score is the log-odds that a text with it is toxic
rather than clean, with a Dirichlet prior whose mean is the log-odds of all tokens that start alike; the
priors form a chain from starts of three, five and seven code points to the whole token. A small drift is
taken off every token, so that ordinary text scores below zero. A linear scan over all tokens finds all maximal
segments of positive score. How high the best segment of a clean text of n tokens comes follows an extreme-value
law: with the positive root of sum q exp(lambda s) = 1 and K from the median clean text, lambda S - ln(K n) measures
every segment by its chance, and the significant ones are the toxic passages, repeated ones as often as they occur.

For the score of the whole text repeats say nothing new: there a segment counts the scores of the tokens that come for the
first time in the text. A text's statistic is the sum over the segments that are significant by that count, or the
best such count if none is, and a logistic curve makes it the probability of label 1.

Null texts and texts without letters have no segments and get the score of an empty text, a low one. Rows
whose key is null are scored like others. Repeated rows are scored alike. Without labels of both kinds
nothing can be learned and every score is 0. Other columns do not matter, whatever their names.

The model is fitted on at most about ``sample_rows`` labelled rows, chosen by a hash of the key; that
bounds the token table, which is broadcast. Scoring is a map over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.llm import words
from tablewarden.llm.common import col

SAMPLE_ROWS = 40_000
STARTS = (3, 5, 7)  # code points
PRIOR = 12.0  # texts that the prior counts for, at each level
DRIFT = 0.25
LEAST_COUNT = 3  # texts; starts and tokens in fewer take the score of a shorter start
_EULER = 0.5772156649015329

_SEPARATOR = np.ones(256, dtype=bool)
_SEPARATOR[65:91] = _SEPARATOR[97:123] = _SEPARATOR[128:] = False


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes of the starts of all tokens and of the tokens, which ones are new in their text, first indexes."""
    data = words.lower(data)
    start, end, first = words.spans(data, offsets, _SEPARATOR)
    lead = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    at = np.searchsorted(lead, start)
    stops = [np.minimum(lead[np.minimum(at + k, len(lead) - 1)], end) for k in STARTS]
    levels = [words.hashes(data, start, stop) for stop in (*stops, end)]
    # The level is part of the key: a token of three letters differs from a start of three letters.
    levels = [(h & ~np.uint64(3)) | np.uint64(k) for k, h in enumerate(levels)]
    own = levels[-1] * np.uint64(0x9E3779B97F4A7C15) + np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), np.diff(first))
    new = np.zeros(len(start), dtype=bool)
    new[np.unique(own, return_index=True)[1]] = True
    return levels, new, first


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, past the last, score) of a sequence, in one pass."""
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[tuple[int, int, float, float]] = []
    for i in positive.tolist():
        begin, left, right = i, sums[i], sums[i + 1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j -= 1
            if j < 0 or found[j][3] >= right:
                break
            begin, left = found[j][0], found[j][2]
            del found[j:]
        found.append((begin, i + 1, left, right))
    return [(a, b, float(r - l)) for a, b, l, r in found]


@dataclass
class ToxicModel:
    keys: np.ndarray
    scores: np.ndarray
    rate: float = 1.0  # lambda
    log_k: float = 0.0
    slope: float = 0.0
    intercept: float = -np.inf

    def token_scores(self, levels: list[np.ndarray]) -> np.ndarray:
        """The score of the longest known start of every token, else the drift."""
        out = np.full(len(levels[0]), -DRIFT)
        rest = np.arange(len(out))
        for h in reversed(levels) if len(self.keys) else ():
            of = h[rest]
            at = np.minimum(np.searchsorted(self.keys, of), len(self.keys) - 1)
            hit = self.keys[at] == of
            out[rest[hit]] = self.scores[at[hit]]
            rest = rest[~hit]
        return out

    def excess(self, score: float, n: int) -> float:
        """How far a segment is above what chance gives in n clean tokens."""
        return self.rate * score - self.log_k - np.log(max(n, 1))

    def assess(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, list, float]]:
        """Per text of a block: number of tokens, segments, statistic."""
        levels, new, first = tokens(data, offsets)
        scores = self.token_scores(levels)
        fresh = np.concatenate([[0.0], np.cumsum(np.where(new, scores, 0.0))])
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            found = segments(scores[a:b])
            each = [self.excess(fresh[a + y] - fresh[a + x], b - a) for x, y, _ in found] or [self.excess(0.0, b - a)]
            yield b - a, found, sum(x for x in each if x > 0) or max(each)

    def probability(self, statistic: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(statistic))
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * statistic + self.intercept, -500, 500)))


def held_out(key: Column, folds: int) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % folds == 0, F.lit(False))


def _logit(p):
    return np.log(p) - np.log1p(-p)


def _count(rows: DataFrame) -> tuple[np.ndarray, ...]:
    """Labelled texts with each start and token: (level, key, key one level up, toxic, clean)."""
    schema = "level int, key long, up long, toxic long, clean long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for i, j, data, offsets in words.blocks(batch.column(0)):
                levels, new, first = tokens(data, offsets)
                toxic = np.repeat(label[i:j], np.diff(first))[new]
                for level, keys in enumerate(levels):
                    values, at, inverse = np.unique(keys[new], return_index=True, return_inverse=True)
                    bad = np.bincount(inverse, toxic, len(values)).astype(np.int64)
                    every = np.bincount(inverse, minlength=len(values))
                    up = levels[max(level - 1, 0)][new][at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(values), level, np.int32)), pa.array(values.view(np.int64)),
                         pa.array(up.view(np.int64)), pa.array(bad), pa.array(every - bad)],
                        names=["level", "key", "up", "toxic", "clean"],
                    )

    counted = (
        rows.select("text", "toxic").mapInArrow(run, schema)
        .groupBy("level", "key").agg(F.first("up").alias("up"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") + F.col("clean") >= LEAST_COUNT)
    ).toArrow()
    return tuple(counted.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("level", "key", "up", "toxic", "clean"))


def _summaries(rows: DataFrame, model: ToxicModel) -> tuple[np.ndarray, ...]:
    """Per labelled row: number of tokens, best segment, statistic, label. At most the sample's rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in words.blocks(batch.column(0)):
                of = [(n, max((s for *_, s in found), default=0.0), statistic) for n, found, statistic in shared.value.assess(data, offsets)]
                n, best, statistic = zip(*of, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(n, pa.int64()), pa.array(best, pa.float64()), pa.array(statistic, pa.float64()), batch.column(1).slice(i, j - i)],
                    names=["n", "best", "statistic", "toxic"],
                )

    out = rows.select("text", "toxic").mapInArrow(run, "n long, best double, statistic double, toxic int").toArrow()
    return tuple(out[c].to_numpy() for c in ("n", "best", "statistic", "toxic"))


def _root(scores: np.ndarray, weight: np.ndarray) -> float:
    """The positive root of sum weight exp(x score) = 1; weights sum to 1 and the mean score is negative."""
    low, high = 0.0, 1.0
    value = lambda x: float(np.sum(weight * np.exp(np.minimum(x * scores, 500)))) - 1.0
    while value(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return high


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton's method, with a weak pull to 0."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    beta, pull = np.zeros(2), np.diag([1e-2, 1e-4]) * len(x) / 100
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - pull @ beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + pull + 1e-9 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 5,
    sample_rows: int = SAMPLE_ROWS,
) -> ToxicModel:
    """Learn from labelled rows outside the held-out fold."""
    known = (
        labels.select(col(key).alias("__key"), col(label).cast("int").alias("toxic"))
        .where(col("__key").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(col("__key"), folds))
        .groupBy("__key").agg(F.max("toxic").alias("toxic"))
    )
    n = known.count()
    if n > sample_rows:
        known = known.where(F.pmod(F.xxhash64("__key"), F.lit(1_000_000)) < int(1_000_000 * sample_rows / n))
    rows = df.select(col(key).alias("__key"), col(text).alias("text")).join(F.broadcast(known), "__key")
    level, keys, up, toxic, clean = _count(rows)
    keys, up = keys.view(np.uint64), up.view(np.uint64)
    n_toxic, n_clean = toxic[level == 0].sum(), clean[level == 0].sum()
    if not n_toxic or not n_clean:
        return ToxicModel(np.zeros(0, dtype=np.uint64), np.zeros(0))
    base = n_toxic / (n_toxic + n_clean)
    order = np.argsort(keys)
    level, keys, up, toxic, clean = (x[order] for x in (level, keys, up, toxic, clean))
    share, weight = np.full(len(keys), base), clean.astype(float)
    for k in range(len(STARTS) + 1):
        own = np.flatnonzero(level == k)
        prior = np.full(len(own), base)
        if k:  # what is counted here is counted one level up as well
            above = np.searchsorted(keys, up[own])
            prior = share[above]
            np.subtract.at(weight, above, clean[own])
        share[own] = (toxic[own] + PRIOR * prior) / (toxic[own] + clean[own] + PRIOR)
    model = ToxicModel(keys, _logit(share) - _logit(base) - DRIFT)

    # How clean tokens score: each by its longest listed start, the rest by the drift.
    weight = np.append(np.maximum(weight, 0), max(0.0, n_clean - clean[level == 0].sum()))
    model.rate = _root(np.append(model.scores, -DRIFT), weight / weight.sum())
    n, best, _, y = _summaries(rows, model)
    plain = (y == 0) & (n > 0)
    if plain.any():  # the median of the law is ln(K n) - ln(ln 2); a few odd texts don't move it
        model.log_k = float(np.median(model.rate * best[plain] - np.log(n[plain])) + np.log(np.log(2)))
    _, _, statistic, y = _summaries(rows, model)
    model.slope, model.intercept = _logistic(statistic, y.astype(float))
    return model


def score(df: DataFrame, model: ToxicModel, key: str = "doc_id", text: str = "text", folds: int = 5) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, and the significant passages as runs of tokens."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    passage = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("excess", pa.float64())])
    schema = T.StructType([
        T.StructField("doc_id", df.schema[key].dataType), T.StructField("held_out", T.BooleanType()),
        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
        T.StructField("passages", T.ArrayType(T.StructType([
            T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()),
            T.StructField("excess", T.DoubleType())]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for i, j, data, offsets in words.blocks(batch.column(2)):
                statistic, passages = [], []
                for n, found, own in m.assess(data, offsets):
                    statistic.append(own)
                    passages.append([
                        {"first": x, "last": y - 1, "excess": e} for x, y, s in found if (e := float(m.excess(s, n))) > 0])
                p = m.probability(np.array(statistic))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(p, pa.float64()),
                     pa.array((p >= 0.5).astype(np.int32)), pa.array(passages, pa.list_(passage))],
                    names=schema.names,
                )

    return df.select(col(key), held_out(col(key), folds).alias("__held"), col(text)).mapInArrow(run, schema)


def reject(df: DataFrame, model: ToxicModel, text: str = "text") -> DataFrame:
    """The rows whose text is not predicted toxic, with all columns."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema, names = df.schema, df.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            keep = []
            for _, _, data, offsets in words.blocks(batch.column(at)):
                statistic = np.array([own for *_, own in m.assess(data, offsets)])
                keep.append(m.probability(statistic) < 0.5)
            yield batch.filter(pa.array(np.concatenate(keep) if keep else np.zeros(0, bool)))

    return df.mapInArrow(run, schema)

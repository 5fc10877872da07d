"""Whitening against a dense eigendecomposition, its rank-one steps on hard spectra, odd rows."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from tablewarden.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n int, x string, whitened int"


def dense(x):
    centred = x - x.mean(axis=0)
    return np.linalg.eigh(centred.T @ centred / len(x))


@settings(deadline=None, max_examples=150)
@given(st.integers(0, 10**6), st.integers(1, 12), st.sampled_from(["plain", "equal", "zeros", "steep", "close", "chain", "inside"]))
def test_rank_one_on_hard_spectra(seed, d, kind):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    values = rng.uniform(0, 10, d)
    x = rng.normal(size=d) * 10 ** rng.uniform(-3, 3)
    if kind == "equal":
        values = np.round(values / 4)
    elif kind == "zeros":
        values, x = values * (rng.random(d) < 0.5), x * (rng.random(d) < 0.5)
    elif kind == "steep":
        values = 10.0 ** rng.uniform(-12, 12, d)
    elif kind == "close":
        values = 1 + rng.integers(0, 3, d) * 1e-13
    elif kind == "chain":
        values = 1 + rng.integers(0, 3 * d, d) * 1e-15
        x /= np.linalg.norm(x)
    elif kind == "inside":
        x = q[:, 0] * 3
    whole = (q * values) @ q.T + np.outer(x, x)
    got, vectors = whitening.rank_one(values, q, x)
    scale = np.abs(whole).max() + 1e-300
    assert np.abs(vectors.T @ vectors - np.eye(d)).max() < 1e-13 * d
    assert np.abs((vectors * got) @ vectors.T - whole).max() < 1e-13 * scale * d * 4


def test_spectra_in_parts_equal_the_whole():
    rng = np.random.default_rng(13)
    x = np.floor(256 * rng.normal(size=(300, 10)) @ rng.normal(size=(10, 10))).astype(np.int64)
    x[:, 9] = x[:, 0] - x[:, 1]  # one direction without variance
    parts = [whitening.Spectrum.empty(10) for _ in range(5)]
    for k, part in enumerate(parts[:4]):  # the last stays empty
        part.add(x[k * 75 : (k + 1) * 75])
    for other in parts[1:]:
        parts[0].merge(other)
    whole = parts[0]
    values, _ = dense(x)
    assert whole.n == 300 and list(whole.sums) == list(x.sum(axis=0))
    assert np.allclose(np.sort(whole.values)[-9:] / 300, values[-9:], rtol=1e-12)
    centred = x - x.mean(axis=0)
    assert np.abs((whole.vectors * whole.values) @ whole.vectors.T - centred.T @ centred).max() < 1e-12 * whole.values.max()


def check(got, rows, components=4):
    """``rows``: (vec_id, vector) of usable rows."""
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for _, v in rows])
    fit = np.unique(x, axis=0)
    values, vectors = dense(fit)
    n, sums, top = len(fit), fit.sum(axis=0), slice(None, -components - 1, -1)
    whitened = (x - fit.mean(axis=0)) @ vectors[:, top] / np.sqrt(values[top])
    assert len(got) == len(rows) * components and set(got.n) == {n}
    by_row = got.sort_values(["vec_id", "component"])
    want = whitened[np.argsort([k for k, _ in rows], kind="stable")]
    found = by_row.whitened.to_numpy().reshape(-1, components)
    signs = np.sign((found * want).sum(axis=0))
    assert np.allclose(found * signs, want, rtol=1e-8, atol=1e-9)
    deviation = {k: int(sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums, strict=True))) for (k, _), v in zip(rows, x, strict=True)}
    assert all(deviation[r.vec_id] == r.deviation for r in got.itertuples())
    for c in range(components):
        assert math.isclose(got[got.component == c + 1].explained.iloc[0], values[-1 - c] / values.sum(), rel_tol=1e-10)
    assert got.identity_error.nunique() == 1 and 0 <= got.identity_error.iloc[0] < 1e-10


def test_query_equals_dense_eigenvectors(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(entry.queries()["op13_whitening"](spark, sf_dir).toPandas(), rows)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS_PER_TASK", 20)  # a tree of several levels
    rng = np.random.default_rng(5)
    rows = [(k, (rng.normal(size=6) * [9, 5, 3, 2, 1, 1]).tolist()) for k in range(600)]
    rows += [(600 + k, rows[0][1]) for k in range(300)]  # a third are one vector
    bad = [(1000, None), (1001, []), (1002, [None] * 6), (1003, [float("nan")] * 6), (1004, [float("inf")] * 6), (1005, [1.0, 2.0])]
    df = spark.createDataFrame([(k, v, 0, "", 1) for k, v in rows + bad], SCHEMA)
    check(whitening.whiten(df).toPandas(), rows)


@pytest.mark.parametrize(("vectors", "components"), [
    ([], 0), ([[1.0, 2.0]], 0), ([[1.0, 2.0]] * 5, 0), ([[1.0, 2.0], [2.0, 4.0]], 1), ([[float(k), 0.0] for k in range(9)], 1),
    ([[1.0, 0.0], [0.0, 1.0], [-1.0, 0.0], [0.0, -1.0]], 2),
])
def test_few_directions(spark, vectors, components):
    got = whitening.whiten(spark.createDataFrame([(k, v, 0, "", 1) for k, v in enumerate(vectors)], SCHEMA)).toPandas()
    assert len(got) == components * len(vectors)
    if components:
        y = got.sort_values(["vec_id", "component"]).whitened.to_numpy().reshape(-1, components)
        assert np.allclose(y.T @ y / len(vectors), np.eye(components)) and got.identity_error.max() < 1e-12


def test_deviations_beyond_a_long(spark):
    rows = [(0, [1e9, 0.0]), (1, [0.0, 0.0]), (2, [0.0, 1.0])]
    got = whitening.whiten(spark.createDataFrame([(k, v, 0, "", 1) for k, v in rows], SCHEMA)).where("component = 1").collect()
    assert {r.vec_id: r.deviation for r in got}[0] is None

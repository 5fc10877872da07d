"""Near vectors in crowded regions against brute force: links, components and who stays."""

import numpy as np
import pytest

from tablewarden.llm import vectors


def cone(rng, n, d=64, share=1 / 3, mutual=0.8, planted=400):
    """Evenly spread vectors, a third of them in a cone, and pairs planted in it at a cosine of 0.92."""
    x = rng.normal(size=(n, d))
    axis, m = rng.normal(size=d), int(n * share)
    axis /= np.linalg.norm(axis)
    side = x[:m] - np.outer(x[:m] @ axis, axis)
    x[:m] = np.sqrt(mutual) * axis + np.sqrt(1 - mutual) * side / np.linalg.norm(side, axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.normal(size=(planted, d))
    base = x[rng.choice(m, planted, replace=False)]
    away -= (away * base).sum(axis=1, keepdims=True) * base
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    return np.concatenate([x, 0.92 * base + np.sqrt(1 - 0.92**2) * away])


def links_of(x, threshold=0.9):
    out = []
    for at in range(0, len(x), 2000):
        a, b = np.nonzero(x[at : at + 2000] @ x.T >= threshold)
        out.append(np.stack([a + at, b], axis=1)[a + at < b])
    return np.concatenate(out)


def least_reachable(n, links):
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[links[:, 0]], root[links[:, 1]])
        np.minimum.at(root, links[:, 0], low)
        np.minimum.at(root, links[:, 1], low)
        root = root[root]
        if (root == before).all():
            return root


@pytest.mark.parametrize(("n", "mutual"), [(20_000, 0.8), (6_000, 0.91)])
def test_links_in_a_cone(spark, n, mutual):
    x = cone(np.random.default_rng(6), n, mutual=mutual).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = vectors.near_vectors(df).toPandas().set_index("vec_id").sort_index()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = links_of(unit)
    want = np.bincount(links.ravel(), minlength=len(x))
    assert (got.n_links <= want).all() and got.n_links.sum() > 0.99 * want.sum()
    if got.n_links.sum() == want.sum():
        root = least_reachable(len(x), links)
        assert (got.component_id == root).all() and (got.kept == (root == np.arange(len(x)))).all()


def test_components_of_every_size_are_compared_whole(spark, monkeypatch):
    """Chains and clusters in windows of two: links that no window held are counted too."""
    monkeypatch.setattr(vectors, "passes_for", lambda *a, **k: 3)
    rng = np.random.default_rng(1)
    centres = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    x = np.repeat(centres, 12, axis=0) + 0.02 * rng.normal(size=(480, 40))
    angle = np.arange(60) * np.arccos(0.93)
    x = np.concatenate([x, np.outer(np.cos(angle), centres[0] * 0) + np.stack([np.cos(angle), np.sin(angle), *np.zeros((38, 60))], axis=1)])
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = vectors.near_vectors(df, window=2).toPandas().set_index("vec_id").sort_index()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = links_of(unit)
    root = got.component_id.to_numpy()
    inside = links[root[links[:, 0]] == root[links[:, 1]]]
    assert len(inside) > 0.9 * len(links)
    assert (got.n_links.to_numpy() == np.bincount(inside.ravel(), minlength=len(x))).all()


def test_odd_ids(spark):
    v, w = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, v), (1, v), (None, v), (2, [1.0, 0.1, 0.0]), (3, w), (None, None), (4, None), (4, [0.0] * 3), (5, v[:2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as region", "'x' as cell", "2 as size")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in vectors.near_vectors(df).collect())
    assert got == sorted([
        ("1", 3, "1", True), ("1", 3, "1", True), ("None", 3, "None", True), ("2", 3, "1", False), ("3", 0, "3", True),
        ("None", 0, "None", True), ("4", 0, "4", True), ("4", 0, "4", True), ("5", 0, "5", True)])
    assert vectors.near_vectors(df.limit(0)).count() == 0

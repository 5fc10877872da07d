"""Second-order boosting against a plain version that looks at every split of every node."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tablewarden.operators import boosting
from tablewarden.operators.boosting import BoostedTrees, BoostParams, fit_trees
from tablewarden.operators.evaluate import roc_auc


def plain_trees(x, y, p, start):
    """Per tree a list of [feature, threshold, gain, value, rows] in the order in which nodes are made."""
    margin, trees = np.full(len(y), start), []
    for _ in range(p.rounds):
        prob = 1 / (1 + np.exp(-margin))
        g, h = prob - y, prob * (1 - prob)

        def score(rows, g=g, h=h):
            return g[rows].sum() ** 2 / (len(rows) if p.first_order else h[rows].sum() + p.ridge)

        def best(rows, g=g, h=h):
            found = []
            for f in range(x.shape[1]):
                for cut in np.unique(x[:, f])[:-1]:
                    left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                    if min(len(left), len(right)) < p.min_rows or min(h[left].sum(), h[right].sum()) < p.min_hessian:
                        continue
                    if len(left) and len(right):
                        found.append(((score(left) + score(right) - score(rows)) / 2, f, cut, left, right))
            most = max((s[0] for s in found), default=0)
            return next((s for s in found if s[0] >= most * (1 - 1e-9)), None) if most > 1e-9 else None

        def leaf(rows, g=g, h=h):
            return [-1, 0.0, 0.0, -p.rate * g[rows].sum() / (h[rows].sum() + p.ridge), len(rows)]

        nodes, members = [leaf(np.arange(len(y)))], {0: (np.arange(len(y)), 0)}
        waiting = {0: best(members[0][0])}
        most = p.leaves or 2**p.depth
        while len(members) < most and any(waiting.values()):
            if p.leaves is None:
                chosen = sorted(n for n, s in waiting.items() if s)
            else:
                chosen = [max((n for n, s in waiting.items() if s), key=lambda n: (waiting[n][0], -n))]
            for node in chosen:
                gain, f, cut, left, right = waiting.pop(node)
                _, depth = members.pop(node)
                nodes[node][:3] = [f, cut, gain]
                for rows in (left, right):
                    nodes.append(leaf(rows))
                    members[len(nodes) - 1] = (rows, depth + 1)
                    waiting[len(nodes) - 1] = best(rows) if depth + 1 < p.depth else None
        for node, (rows, _) in members.items():
            margin[rows] += nodes[node][3]
        trees.append(nodes)
    return trees, margin


def sample(seed=4, n=240):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 9, n), rng.integers(0, 2, n), rng.normal(size=n).round(1), rng.integers(0, 2, n) * 1.0, np.zeros(n)])
    x[:, 3] = 1 - x[:, 1]  # the same splits as feature 1
    y = (x[:, 0] + 3 * x[:, 1] * x[:, 2] + rng.normal(size=n) > 4).astype(float)
    return x, y


def frame(spark, x, y):
    df = spark.createDataFrame([(i, v.tolist(), float(t)) for i, (v, t) in enumerate(zip(x, y, strict=True))], "id long, x array<double>, label double")
    return df.repartition(5).select("id", array_to_vector("x").alias("features"), "label")


@pytest.mark.parametrize("params", [
    BoostParams(rounds=11, rate=0.3, depth=3),
    BoostParams(rounds=3, rate=0.3, depth=5, leaves=6, ridge=0.0, min_hessian=1e-3, min_rows=8, prior=True),
    BoostParams(rounds=2, rate=0.5, depth=4, leaves=31, min_rows=1, min_hessian=0.0),
    BoostParams(rounds=2, rate=0.5, depth=3, ridge=0.0, min_hessian=1e-9, prior=True, first_order=True),
], ids=["levels", "leaves", "all leaves", "first order"])
@pytest.mark.parametrize("part_rows", [40, 1 << 16])
def test_trees_equal_plain_version(spark, monkeypatch, params, part_rows):
    monkeypatch.setattr(boosting, "PART_ROWS", part_rows)
    x, y = sample()
    model = fit_trees(frame(spark, x, y), "m", params)
    start = np.log(y.sum() / (len(y) - y.sum())) if params.prior else 0.0
    want, margin = plain_trees(x, y, params, start)
    assert len(model.trees) == params.rounds
    for got, nodes in zip(model.trees, want, strict=True):
        assert got.feature == [n[0] for n in nodes] and got.rows == [n[4] for n in nodes]
        for k, name in ((1, "threshold"), (2, "gain"), (3, "value")):
            assert np.allclose(getattr(got, name), [n[k] for n in nodes], rtol=1e-9, atol=1e-12)
    scored = {r.id: r.probability for r in model.score(frame(spark, x, y)).collect()}
    assert np.allclose([scored[i] for i in range(len(y))], 1 / (1 + np.exp(-margin)), rtol=1e-9)


def test_many_values_are_binned(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 2))
    x[:5, 0] = np.nan
    df = frame(spark, x, (x[:, 1] > 0.3).astype(float))
    binned = boosting.Binned.of(df, "features", "label", 16)
    assert [len(e) for e in binned.edges] == [16, 16] and binned.edges[1][-1] == x[:, 1].max()
    model = fit_trees(df, "m", BoostParams(rounds=30, depth=3, bins=64))
    assert roc_auc(model.score(df), "label", "probability").first()["auc"] > 0.99


def test_odd_tables(spark, tmp_path):
    x, y = sample(n=30)
    one_class = fit_trees(frame(spark, x, np.ones(30)), "m", BoostParams(rounds=2, prior=True))
    assert one_class.start == 0.0 and one_class.score(frame(spark, x, y)).where("probability > 0.5").count() == 30
    empty = fit_trees(frame(spark, x, y).limit(0), "m", BoostParams(rounds=2))
    assert empty.score(frame(spark, x, y)).where("probability = 0.5 and prediction = 0").count() == 30
    model = fit_trees(frame(spark, x, y), "m", BoostParams(rounds=3, depth=2))
    model.save(str(tmp_path / "trees"))
    again = BoostedTrees.load(spark, "m", str(tmp_path / "trees"))
    pairs = model.score(frame(spark, x, y)).select("id", F.col("probability").alias("p")).join(again.score(frame(spark, x, y)), "id")
    assert pairs.where("p = probability").count() == 30
    with pytest.raises(ValueError, match="fewer"):
        boosting.Grower([np.zeros(10**6)], np.array([0, 10**6]), BoostParams(depth=12))


def test_zeros_are_not_added_up(spark, monkeypatch):
    """Blocks list only cells away from zero, and a tree's margins are computed once by a worker that remembers them."""
    x, y = sample()
    binned = boosting.Binned.of(frame(spark, x, y), "features", "label", 256)
    blocks = [boosting.pickle.loads(r["block"]) for r in binned.blocks.collect()]
    assert sum(len(cells) for _, cells, _, _ in blocks) == np.count_nonzero(x)
    assert {codes.dtype for codes, *_ in blocks} == {np.dtype("uint8")}
    tree = boosting.Tree(value=[0.5])
    monkeypatch.setattr(boosting, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda s: 0})())}))
    own = [(b, np.zeros(len(b[-1]))) for b in blocks]
    for n in (1, 2, 2):
        assert all((m == n * 0.5).all() for _, m in boosting._caught_up(-1, own, [tree] * n))
    assert {boosting._MET[-1, 0, k][0] for k in range(len(own))} == {2}


def test_tables_beyond_a_part_use_all_cores(spark, monkeypatch):
    monkeypatch.setattr(boosting, "PART_ROWS", 100)
    monkeypatch.setattr(boosting, "_LEAST_ROWS", 20)
    x, y = sample()
    binned = boosting.Binned.of(frame(spark, x, y), "features", "label", 16)
    assert binned.blocks.rdd.getNumPartitions() == min(spark.sparkContext.defaultParallelism, 12)


def test_features_of_few_bins_are_added_up_together(spark):
    """A code joins the columns of a category and several such numbers, and the features' own sums come apart exactly (F1, F2, F6)."""
    rng = np.random.default_rng(9)
    n = 4000
    country, colour = rng.integers(0, 6, n), rng.integers(0, 4, n)
    bins = np.column_stack([
        *[country == c for c in range(6)], *[colour == c for c in range(3)], rng.integers(0, 7, n), np.ones(n), rng.integers(0, 90, n)]).astype(np.uint8)
    bins[:, 10] = 0  # constant
    widths, zeros = [2] * 9 + [7, 1, 90], np.array([0] * 9 + [3, 0, 40])
    joint = boosting.Joint.of(widths, zeros, boosting._together(bins, zeros), 256)
    codes = joint.coded(bins)
    assert len(codes) < 4 and codes.shape[1] == n and joint.group[10] == -1
    for f, g in enumerate(joint.group):
        assert g < 0 or (joint.bins[f][codes[g]] == bins[:, f]).all()
    tree = boosting.Tree()
    tree.split(0, 1, 0, 0.0, 1.0)
    tree.split(1, 11, 30, 0.0, 1.0)
    tree.split(2, 9, 2, 0.0, 1.0)
    leaf = joint.leaf_of(tree, codes)
    assert (leaf == tree.leaf_of_codes(bins)).all() and len(np.unique(leaf)) == 4
    part_way = joint.leaf_of(tree, codes, below=3)
    assert set(part_way) == {1, 2} and (joint.leaf_of(tree, codes, part_way) == leaf).all()
    offsets, slopes = np.concatenate([[0], np.cumsum(widths)]), (rng.normal(size=n), rng.random(n))
    got = boosting._sums([(codes[:, :1500], leaf[:1500], *(s[:1500] for s in slopes)), (codes[:, 1500:], leaf[1500:], *(s[1500:] for s in slopes))],
                         len(tree.feature), [3, 6], joint, offsets, zeros)
    for k, w in enumerate((*slopes, np.ones(n))):
        for i, node in enumerate((3, 6)):
            here = leaf == node
            want = np.concatenate([np.bincount(bins[here, f], w[here], widths[f]) for f in range(len(widths))])
            assert np.allclose(got[k, i], want, atol=1e-9)


def test_edges_of_features(spark):
    """Features with few values list them all, others have quantiles; NaN and negative zeros add none."""
    x = np.column_stack([np.arange(500) % 7, np.arange(500), np.full(500, np.nan), np.where(np.arange(500) % 2, 0.0, -0.0)]).astype(float)
    x[::50, 0] = np.nan
    df = frame(spark, x, np.zeros(500)).select(boosting.vector_to_array("features").alias("features"))
    few, many, none, zero = boosting.bin_edges(df, 4, 20)
    assert few.tolist() == list(range(7)) and len(many) == 20 and many[-1] == 499 and none.tolist() == [0.0] and zero.tolist() == [0.0]
    assert boosting.bin_edges(df.limit(0), 0, 20) == []

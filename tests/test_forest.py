"""The forest against a plain tree that looks at every split, and against itself where its two phases meet elsewhere."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tablewarden import session
from tablewarden.operators import forest, models
from tablewarden.operators.forest import Forest, ForestParams, fit_forest_trees
from tablewarden.operators.models import load_model, save_model
from tablewarden.plans.training import metrics_of


def sample(n=600, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 9, n), rng.integers(0, 2, n), rng.integers(0, 30, n), rng.integers(0, 2, n), rng.integers(0, 5, n)]).astype(float)
    y = ((x[:, 0] + 3 * x[:, 1] + rng.normal(0, 2, n)) > 6).astype(float)
    return x, y


@pytest.fixture(scope="module")
def rows(spark):
    x, y = sample()
    table = spark.createDataFrame([(i, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], "id long, x array<double>, label double")
    return table.select("id", array_to_vector("x").alias("features"), "label").repartition(3, "id").cache()


def plain_tree(x, y, depth, least):
    """{path: (feature or -1, threshold, share, rows)}."""
    out = {}

    def impurity(rows):
        return len(rows) - ((y[rows] == 1).sum() ** 2 + (y[rows] == 0).sum() ** 2) / len(rows)

    def grow(path, rows, left):
        best = (1e-9, -1, 0.0, None)
        for f in range(x.shape[1]) if left else ():
            for cut in np.unique(x[rows, f])[:-1]:
                low, high = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if min(len(low), len(high)) >= least:
                    gain = impurity(rows) - impurity(low) - impurity(high)
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, f, cut, (low, high))
        out[path] = (best[1], best[2], y[rows].mean(), len(rows))
        if best[3]:
            grow(2 * path, best[3][0], left - 1)
            grow(2 * path + 1, best[3][1], left - 1)

    grow(1, np.arange(len(y)), depth)
    return out


def nodes(model, tree):
    out, queue = {}, [(1, 0)]
    while queue:
        path, n = queue.pop()
        f = int(tree.feature[n])
        out[path] = (f, model.edges[f][tree.code[n]] if f >= 0 else 0.0, tree.value[n], int(tree.rows[n]))
        if f >= 0:
            queue += [(2 * path, int(tree.left[n])), (2 * path + 1, int(tree.left[n]) + 1)]
    return out


@pytest.mark.parametrize("subtree_rows", [40, 10_000])
def test_one_tree_is_the_plain_tree(spark, rows, monkeypatch, subtree_rows):
    monkeypatch.setattr(forest, "SUBTREE_ROWS", subtree_rows)
    model = fit_forest_trees(rows, "one", ForestParams(trees=1, depth=6, min_rows=4))
    x, y = sample()
    got, want = nodes(model, model.trees[0]), plain_tree(x, y, 6, 4)
    assert got.keys() == want.keys() and len(got) > 20
    for path, node in want.items():
        assert got[path] == pytest.approx(node)


def test_trees_do_not_depend_on_where_the_phases_meet(spark, rows, monkeypatch):
    """Nodes of many rows are summed by Spark, and only smaller ones are grown inside a task."""
    params = ForestParams(trees=12, depth=9, min_rows=2)
    whole = fit_forest_trees(rows, "a", params)
    monkeypatch.setattr(forest, "SUBTREE_ROWS", 50)
    monkeypatch.setattr(forest, "LEVEL_BYTES", 1 << 12)
    parts = fit_forest_trees(rows, "b", params)
    assert [nodes(whole, t) for t in whole.trees] == [nodes(parts, t) for t in parts.trees]
    for tree in parts.trees:
        inner = tree.feature >= 0
        assert tree.rows[1:].min() >= 2 and inner.any()
        assert (tree.rows[tree.left[inner]] + tree.rows[tree.left[inner] + 1] == tree.rows[inner]).all()
    assert len({len(t.feature) for t in parts.trees}) > 3


def test_model_scores_and_is_stored(spark, rows, tmp_path):
    model = models.fit_forest(rows, trees=20, depth=5, min_split=2)
    assert type(model) is Forest
    scored = {r["id"]: r for r in model.score(rows).collect()}
    assert scored.keys() == set(range(600))
    x, y = sample()
    codes = forest.binned(x, model.edges)
    share = np.mean([t.value[t.leaf_of(codes)] for t in model.trees], axis=0)
    assert all(scored[i]["probability"] == pytest.approx(s) and scored[i]["prediction"] == (s > 0.5) for i, s in enumerate(share))
    assert np.mean((share > 0.5) == y) > 0.8
    save_model(model, str(tmp_path / "m"), spark)
    again = load_model(spark, str(tmp_path / "m"))
    assert type(again) is Forest and sorted(again.score(rows).collect()) == sorted(model.score(rows).collect())


def test_limits_are_errors(spark, rows):
    with pytest.raises(ValueError):
        models.fit_forest(rows, depth=99)
    with pytest.raises(Exception, match="0 or 1"):
        models.fit_forest(rows.withColumn("label", F.lit(2.0)), trees=2, depth=2)


def test_pure_labels_and_packing(spark, rows):
    model = models.fit_forest(rows.withColumn("label", F.lit(0.0)), trees=3, depth=4)
    assert [len(t.feature) for t in model.trees] == [1, 1, 1]
    assert {r["probability"] for r in model.score(rows).collect()} == {0.0}
    widths = np.array([2, 9, 1, 2, 30, 2])
    codes = np.random.default_rng(1).integers(0, widths, (50, 6)).astype(np.uint8)
    assert (forest._unpacked(forest._packed(codes, widths), widths) == codes).all()


def test_scores_are_computed_once(spark, rows, tmp_path):
    """Five metrics read the scores several times; a search over all rows must not run again for each."""
    met = spark.sparkContext.accumulator(0)

    class Constant:
        def score(self, df):
            seen = F.udf(lambda i: met.add(1) or 0.5, "double").asNondeterministic()
            return df.withColumn("probability", seen("id")).withColumn("prediction", F.lit(1.0))

    found = metrics_of(Constant(), rows)
    assert met.value == 600 and found["auc"] == 0.5 and found["recall"] == 1.0


def test_parts_of_stored_vectors_are_bounded(spark, rows, monkeypatch):
    """Their number grows with the rows, not only with the shuffle partitions."""
    monkeypatch.setattr(session, "SPREAD_ROWS", 20)
    counts = session.materialize(rows, "spread", spread_by="id", rows=600).groupBy(F.input_file_name()).count().collect()
    assert len(counts) >= 25 and max(r["count"] for r in counts) < 60 and sum(r["count"] for r in counts) == 600


def test_bagging_is_poisson():
    drawn = np.bincount(forest.Sampler(ForestParams(), np.full(82, 2)).times(7, forest._mixed(np.arange(200_000, dtype=np.uint64))), minlength=4) / 200_000
    assert drawn[:4] == pytest.approx([0.3679, 0.3679, 0.1839, 0.0613], abs=0.005)


def test_rows_that_do_not_count_are_not_walked(rows):
    """Only bagged rows go down a tree (F3), and nodes up to a part's share of rows are grown inside a task."""
    model = fit_forest_trees(rows, "one", ForestParams(trees=1, depth=6, min_rows=4))
    x, _ = sample()
    codes, some = forest.binned(x, model.edges), np.arange(0, 600, 7)
    whole, part = model.trees[0].leaf_of(codes), model.trees[0].leaf_of(codes, some)
    assert (part[some] == whole[some]).all() and len(np.unique(whole)) > 10
    assert not np.delete(part, some).any()
    assert forest.SUBTREE_ROWS >= 1 << 17  # fewer levels that need a job each

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tablewarden.operators import knn, models
from tablewarden.operators.evaluate import roc_auc
from tablewarden.operators.models import Candidate
from tablewarden.session import materialize
from tablewarden.plans.training import cross_validate, cv_summary, train_suite


def brute(train, queries, k):
    out = {}
    for q, v in queries:
        d = sorted((np.sqrt(((np.array(v) - np.array(t)) ** 2).sum()), i) for i, t, _ in train)
        out[q] = [i for _, i in d[:k]]
    return out


@pytest.mark.parametrize(("block_rows", "cell_rows"), [(17, 20000), (20000, 4), (7, 12), (20000, 20000)])
@pytest.mark.parametrize("kind", ["normal", "copies", "grid"])
def test_knn_equals_brute_force(spark, kind, block_rows, cell_rows):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(150, 3))
    if kind == "copies":
        points[:60] = points[0]  # a large group of equal vectors
    if kind == "grid":
        points = np.round(points)  # many ties
    train = [(i, [float(x) for x in p], float(i % 2)) for i, p in enumerate(points)]
    queries = [(1000 + i, v) for i, (_, v, _) in enumerate(train[::3])] + [(2000, [9.0, 9.0, 9.0])]
    got = knn.knn_join(
        spark.createDataFrame(train, "id long, vec array<double>, label double"),
        spark.createDataFrame(queries, "qid long, vec array<double>"), 5, block_rows=block_rows, cell_rows=cell_rows)
    found = {}
    for r in got.orderBy("qid", "dist", "id").collect():
        found.setdefault(r["qid"], []).append(r["id"])
    assert found == brute(train, queries, 5)


def test_knn_searches_few_cells_of_clusters(spark, monkeypatch):
    """Forty clusters in 16 dimensions, cells of 40 rows: a query searches its own cluster's cells."""
    monkeypatch.setattr(knn, "SAMPLE_ROWS", 300)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16)) * 10
    x = centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16))
    df = spark.createDataFrame([(i, v.tolist(), 0.0) for i, v in enumerate(x)], "id long, vec array<double>, label double")
    index = knn.KnnIndex(df, cell_rows=40, fan=16)
    asked = df.where("id % 10 = 0").select(F.col("id").alias("qid"), "vec")
    found, visits = index.search(asked, 3, exclude_self=True)
    held = int((index.tree.size[index.tree.leaves] > 0).sum())
    assert held > 100 and visits.count() < 0.1 * 400 * held  # every query and every cell: 400 * held
    got = {}
    for r in found.orderBy("qid", "dist", "id").collect():
        got.setdefault(r["qid"], []).append(r["id"])
    apart = np.linalg.norm(x[::10][:, None] - x[None], axis=2)
    apart[np.arange(400), np.arange(400) * 10] = np.inf
    assert all(got[10 * i] == np.lexsort((np.arange(4000), apart[i]))[:3].tolist() for i in range(400))


def test_knn_sends_queries_to_bundles_of_leaves(spark, monkeypatch):
    """Vectors spread evenly reach nearly all leaves; a query travels once to a bundle, and only rows within bounds return."""
    monkeypatch.setattr(knn, "PAIRS", 9)
    sent = []
    met = knn.KnnIndex._met

    def counted(self, asked, *rest):
        found = materialize(met(self, asked, *rest), "met")
        sent.append((asked.count(), found.count()))
        return found

    monkeypatch.setattr(knn.KnnIndex, "_met", counted)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1200, 24)).astype(np.float32)
    x[1100:] = x[:100]  # ties between copies
    df = spark.createDataFrame([(i, v.tolist(), float(i % 2)) for i, v in enumerate(x)], "id long, vec array<float>, label double")
    index = knn.KnnIndex(df, cell_rows=30, fan=8)
    asked = df.select(F.col("id").alias("qid"), "vec")
    found, visits = index.search(asked, 5, exclude_self=True)
    leaves = int((index.tree.size[index.tree.leaves] > 0).sum())
    assert leaves > 40 and visits.count() > 0.8 * 1200 * leaves  # a query reaches nearly all leaves
    bundles, back = sent[1]
    assert bundles <= 1200 * 4 and back < 1200 * 4 * 6
    got = {}
    for r in found.orderBy("qid", "dist", "id").collect():
        got.setdefault(r["qid"], []).append(r["id"])
    wide = x.astype(float)
    for i in range(1200):
        apart = np.sqrt(((wide - wide[i]) ** 2).sum(axis=1))
        apart[i] = np.inf
        assert got[i] == np.lexsort((np.arange(1200), apart))[:5].tolist()


def test_knn_tree_within_its_bound(spark, monkeypatch):
    monkeypatch.setattr(knn, "TREE_BYTES", 4000)
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist(), 0.0) for i in range(1000)], "id long, vec array<double>, label double")
    index = knn.KnnIndex(df, cell_rows=5, fan=8)
    assert len(index.tree.parent) <= 4000 // (8 * 4 + 64) + 1
    found, _ = index.search(df.select(F.col("id").alias("qid"), "vec"), 1)
    assert found.where("qid = id and dist = 0").count() == 1000


def test_knn_with_fewer_rows_than_k(spark):
    train = spark.createDataFrame([(1, [0.0], 1.0), (2, [1.0], 0.0)], "id long, vec array<double>, label double")
    got = knn.knn_predict(train, spark.createDataFrame([(7, [0.2])], "qid long, vec array<double>"), 5).first()
    assert got["probability"] == 0.5 and got["prediction"] == 0.0


@pytest.fixture(scope="module")
def rings(spark):
    """Two rings: no line separates them."""
    df = spark.range(600).select(
        F.col("id"), (F.rand(1) * 6.283).alias("a"), (F.col("id") % 2).cast("double").alias("label"))
    radius = F.lit(1.0) + F.col("label") + F.rand(2) * 0.3
    df = df.select("id", "label", (radius * F.cos("a")).alias("x"), (radius * F.sin("a")).alias("y"))
    df = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)
    return materialize(df.select("id", "features", "label"), "rings")


def auc(model, df):
    return roc_auc(model.score(df), "label", "probability").first()["auc"]


def test_kernel_svm_beats_a_line(rings):
    assert auc(models.fit_svm(rings, width=64, max_iter=20, folds=3), rings) > 0.99
    assert auc(models.fit_logistic(rings, max_iter=20), rings) < 0.7


def test_suite_reports_failures_and_saves(spark, rings, tmp_path):
    suite = (Candidate("knn", models.fit_neighbours, {"k": 5}), Candidate("bad", models.fit_forest, {"depth": 99}),
             Candidate("line", models.fit_logistic, {"max_iter": 5}))
    found = train_suite(rings, rings, rings, suite, cv=0, log_path=str(tmp_path / "runs"), model_path=str(tmp_path / "m"))
    rows = found.table(spark).collect()
    assert [r["model"] for r in rows] == ["knn", "line", "bad"]
    assert rows[2]["error"] and rows[0]["test_auc"] > 0.99
    assert found.best(spark)[0] == "knn"
    again = models.load_model(spark, str(tmp_path / "m/line"))
    assert auc(again, rings) == pytest.approx(rows[1]["test_auc"])
    near = models.load_model(spark, str(tmp_path / "m/knn"))
    assert near.k == 5 and type(again) is models.SparkModel


def test_margins_are_held_out(spark, rings):
    """Every row's margin comes from a machine fitted on the other folds."""
    lift = models.RandomFourierFeatures(inputCol="features", outputCol="lifted", gamma=1.0, width=16)
    lifted = materialize(lift.transform(rings), "lifted")
    svc = models.LinearSVC(featuresCol="lifted", maxIter=5, regParam=0.01, rawPredictionCol="margin")
    got = {r["id"]: (r["fold"], r["margin"][1]) for r in models.cross_margins(lifted, svc, 3).collect()}
    folds = {r["id"]: r["fold"] for r in models.cv_folds(lifted, "label", "id", 3).select("id", "fold").collect()}
    assert {i: f for i, (f, _) in got.items()} == folds and len(got) == 600
    outside = [i for i, f in folds.items() if f != 1]
    machine = svc.fit(lifted.where(F.col("id").isin(outside)))
    for r in machine.transform(lifted.where(~F.col("id").isin(outside))).select("id", "margin").collect():
        assert got[r["id"]][1] == pytest.approx(r["margin"][1], abs=1e-6)


def test_svm_stores_no_lifted_rows(rings, monkeypatch):
    """Only narrow tables are stored: 256 numbers a row, twice, filled the disk."""
    stored, plain = [], models.materialize
    monkeypatch.setattr(models, "materialize", lambda df, name, **more: stored.append((name, df.columns)) or plain(df, name, **more))
    models.fit_svm(rings, width=16, max_iter=3, folds=3)
    assert stored == [("svm-folds", ["id", "features", "label", "fold"]), ("svm-margins", ["id", "label", "fold", "margin"])]


def test_cross_validation(rings):
    row = cv_summary(cross_validate(Candidate("line", models.fit_logistic, {"max_iter": 5}), rings, 3)).first()
    assert row["folds"] == 3 and 0.2 < row["cv_auc_mean"] < 0.8

"""Classifiers behind one interface: ``fit(train) -> model``, ``model.score(df)``.

Scored tables gain ``prediction`` and ``probability`` (of class 1). Input
tables have an id, a feature vector and a 0/1 label.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.operators.boosting import BoostedTrees, BoostParams, fit_trees
from tablewarden.operators.forest import Forest, ForestParams, fit_forest_trees
from tablewarden.operators.kernels import RandomFourierFeatures, scale_gamma
from tablewarden.operators.knn import knn_predict
from tablewarden.operators.split import cv_folds
from tablewarden.session import materialize

ID, FEATURES, LABEL = "id", "features", "label"


def assemble(
    prepared: DataFrame, names: Sequence[str], target: str | None, id_col: str,
    fill: Mapping[str, float] | None = None, carry: Sequence[str] = (),
) -> DataFrame:
    """(id, features, label) of a prepared table.

    ``names`` fixes the order. Absent features are 0; nulls of derived numeric
    features take their training mean from ``fill``. Columns in ``carry`` pass
    through.
    """
    known = set(prepared.columns)
    columns = []
    for c in names:
        value = F.col(f"`{c}`") if c in known else F.lit(0.0)
        if fill and c in fill:
            value = F.coalesce(value, F.lit(fill[c]))
        columns.append(value.cast("double").alias(f"f{len(columns)}"))
    label = [F.col(target).cast("double").alias(LABEL)] if target else []
    rows = prepared.select(F.col(id_col).alias(ID), *label, *carry, *columns)
    assembler = VectorAssembler(inputCols=[f"f{i}" for i in range(len(names))], outputCol=FEATURES, handleInvalid="error")
    return assembler.transform(rows).select(ID, FEATURES, *([LABEL] if target else []), *carry)


class SparkModel:
    """A fitted ML pipeline whose last stage gives the probability."""

    def __init__(self, name: str, pipeline: PipelineModel):
        self.name, self.pipeline = name, pipeline

    def score(self, df: DataFrame) -> DataFrame:
        out = self.pipeline.transform(df)
        # A calibrated margin model has columns of its own; the plain ones have the default names.
        probability = vector_to_array(F.col("probability"))[1]
        return out.select(*df.columns, F.col("prediction"), probability.alias("probability"))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path)

    @classmethod
    def load(cls, spark: SparkSession, name: str, path: str) -> SparkModel:
        return cls(name, PipelineModel.load(path))


class NeighbourModel:
    """k nearest neighbours: the fitted state is the training table."""

    def __init__(self, name: str, train: DataFrame, k: int):
        self.name, self.train, self.k = name, train, k

    def score(self, df: DataFrame) -> DataFrame:
        rows = self.train.select(ID, vector_to_array(FEATURES).alias("vec"), LABEL)
        asked = df.select(F.col(ID).alias("qid"), vector_to_array(FEATURES).alias("vec"))
        votes = knn_predict(rows, asked, self.k).withColumnRenamed("qid", ID)
        return df.join(votes, ID).select(*df.columns, "prediction", "probability")

    def save(self, path: str) -> None:
        self.train.withColumn("k", F.lit(self.k)).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, name: str, path: str) -> NeighbourModel:
        stored = spark.read.parquet(path)
        return cls(name, stored.drop("k"), stored.select("k").first()["k"])


def _pipeline(name: str, train: DataFrame, *stages) -> SparkModel:
    return SparkModel(name, Pipeline(stages=list(stages)).fit(train))


def fit_logistic(train: DataFrame, name: str = "logistic_regression", max_iter: int = 1000) -> SparkModel:
    """Ridge-penalised with C = 1 on the summed loss, so 1/n on the mean loss."""
    n = train.count()
    return _pipeline(name, train, LogisticRegression(
        maxIter=max_iter, regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False))


def fit_forest(
    train: DataFrame, name: str = "random_forest", trees: int = 200, depth: int = 20, min_split: int = 10
) -> Forest:
    """Bagged Gini trees; a split leaves at least half of ``min_split`` rows on both sides."""
    return fit_forest_trees(train, name, ForestParams(trees, depth, max(1, min_split // 2)), FEATURES, LABEL)


def fit_boosting(
    train: DataFrame, name: str = "gradient_boosting", rounds: int = 200, rate: float = 0.1, depth: int = 5
) -> BoostedTrees:
    """First-order boosting: splits fitted to gradients, Newton steps in the leaves."""
    return fit_trees(train, name, BoostParams(
        rounds, rate, depth, ridge=0.0, min_hessian=1e-9, prior=True, first_order=True), FEATURES, LABEL)


def fit_boosting_deep(train: DataFrame, name: str = "xgboost", rounds: int = 200, rate: float = 0.1, depth: int = 7) -> BoostedTrees:
    """Second-order boosting, trees grown by levels."""
    return fit_trees(train, name, BoostParams(rounds, rate, depth), FEATURES, LABEL)


def fit_boosting_hist(
    train: DataFrame, name: str = "lightgbm", rounds: int = 200, rate: float = 0.1, depth: int = 7, leaves: int = 31
) -> BoostedTrees:
    """Second-order boosting, trees grown leaf by leaf."""
    return fit_trees(train, name, BoostParams(
        rounds, rate, depth, leaves, bins=255, ridge=0.0, min_hessian=1e-3, min_rows=20, prior=True), FEATURES, LABEL)


def cross_margins(train: DataFrame, svc: LinearSVC, folds: int, lift: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(id, label, fold, margin): the margin of every row from a machine that was fitted on the other folds.

    Folds are stored as they come and lifted when they are read. The machines are fitted one after the other, since
    each fit holds its own copy of the lifted rows.
    """
    marked = materialize(cv_folds(train, LABEL, ID, folds), "svm-folds", partition_by=("fold",))

    def held_out(fold: int) -> DataFrame:
        machine = svc.fit(lift(marked.where(F.col("fold") != fold)))
        return machine.transform(lift(marked.where(F.col("fold") == fold))).select(ID, LABEL, "fold", "margin")

    return materialize(functools.reduce(DataFrame.unionByName, [held_out(fold) for fold in range(folds)]), "svm-margins")


def fit_svm(
    train: DataFrame, name: str = "svm", width: int = 256, max_iter: int = 100, folds: int = 5
) -> SparkModel:
    """RBF-kernel SVM on random Fourier features.

    Probabilities come from a logistic curve over margins of rows that the machine behind them was not fitted on
    (Platt scaling, cross-fitted); margins of new rows come from a machine fitted on all of them. With fewer rows of a
    class than folds, the curve is fitted on the margins of the rows themselves.
    """
    lift = RandomFourierFeatures(inputCol=FEATURES, outputCol="lifted", gamma=scale_gamma(train, FEATURES), width=width)
    lifted = lift.transform(train)  # never stored: 256 numbers a row
    sizes = [r["count"] for r in train.groupBy(LABEL).count().collect()]
    svc = LinearSVC(
        featuresCol="lifted", maxIter=max_iter, regParam=1.0 / max(sum(sizes), 1), standardization=False,
        predictionCol="svc_prediction", rawPredictionCol="margin",
    )
    machine = svc.fit(lifted)
    crossed = len(sizes) == 2 and min(sizes) >= folds
    held_out = cross_margins(train, svc, folds, lift.transform) if crossed else machine.transform(lifted)
    curve = LogisticRegression(featuresCol="margin", maxIter=100, rawPredictionCol="platt_margin").fit(held_out)
    return SparkModel(name, PipelineModel(stages=[lift, machine, curve]))


def fit_neighbours(train: DataFrame, name: str = "knn", k: int = 7) -> NeighbourModel:
    return NeighbourModel(name, train, k)


_KINDS = {"pipeline": SparkModel, "trees": BoostedTrees, "forest": Forest, "neighbours": NeighbourModel}


def save_model(model, path: str, spark: SparkSession | None = None) -> None:
    """Store a model with its kind and name, so that :func:`load_model` needs nothing but the path."""
    spark = spark or SparkSession.active()
    kind = next(k for k, c in _KINDS.items() if isinstance(model, c))
    model.save(f"{path}/model")
    spark.createDataFrame([(kind, model.name)], "kind string, name string").coalesce(1).write.mode("overwrite").parquet(f"{path}/kind")


def load_model(spark: SparkSession, path: str):
    """The model stored at ``path``, of the class it was stored from."""
    stored = spark.read.parquet(f"{path}/kind").first()
    return _KINDS[stored["kind"]].load(spark, stored["name"], f"{path}/model")


@dataclass(frozen=True)
class Candidate:
    name: str
    fit: Callable[..., object]
    params: Mapping[str, object]

    def train(self, df: DataFrame):
        return self.fit(df, self.name, **self.params)


QUICK_SUITE = (
    Candidate("logistic_regression", fit_logistic, {"max_iter": 100}),
    Candidate("random_forest", fit_forest, {"trees": 50, "depth": 10, "min_split": 2}),
    Candidate("knn", fit_neighbours, {"k": 5}),
)
FULL_SUITE = (
    Candidate("logistic_regression", fit_logistic, {"max_iter": 1000}),
    Candidate("random_forest", fit_forest, {"trees": 200, "depth": 20, "min_split": 10}),
    Candidate("gradient_boosting", fit_boosting, {"rounds": 200, "rate": 0.1, "depth": 5}),
    Candidate("xgboost", fit_boosting_deep, {"rounds": 200, "rate": 0.1, "depth": 7}),
    Candidate("lightgbm", fit_boosting_hist, {"rounds": 200, "rate": 0.1, "depth": 7}),
    Candidate("svm", fit_svm, {}),
    Candidate("knn", fit_neighbours, {"k": 7}),
)

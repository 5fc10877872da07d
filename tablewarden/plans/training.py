"""Training loop, cross-validation, scoring of new rows."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.operators import models
from tablewarden.operators.evaluate import evaluate, leaderboard, roc_auc, select_best
from tablewarden.operators.features import engineer_features
from tablewarden.operators.models import FULL_SUITE, ID, LABEL, QUICK_SUITE, Candidate
from tablewarden.operators.scoring import respond
from tablewarden.operators.split import cv_folds
from tablewarden.plans.prepare import Prepared, PrepState, transform
from tablewarden.session import compiled, in_pools, materialize
from tablewarden.sources.runlog import RunLog
from tablewarden.sources.tables import write_csv
from tablewarden.spec import METRICS, TableSpec

RESULT_SCHEMA = (
    "model string, test_accuracy double, test_auc double, test_f1 double, test_precision double, "
    "test_recall double, cv_auc double, training_seconds double, error string"
)


@dataclass
class TrainedSuite:
    fitted: dict[str, object] = field(default_factory=dict)
    rows: list[tuple] = field(default_factory=list)

    def table(self, spark: SparkSession) -> DataFrame:
        """Leaderboard, best test AUC first; failed models come last with their error."""
        return leaderboard(spark.createDataFrame(self.rows, RESULT_SCHEMA), "test_auc")

    def best(self, spark: SparkSession, metric: str = "auc") -> tuple[str, object, float]:
        wide = self.table(spark).where("error is null").select(
            "model", *[F.col(f"test_{m}").alias(m) for m in METRICS])
        row = select_best(wide, metric).first()
        return row["model"], self.fitted[row["model"]], row["score"]

    def metric_rows(self, spark: SparkSession, model: str) -> DataFrame:
        row = self.table(spark).where(F.col("model") == model).first()
        return spark.createDataFrame([(m, row[f"test_{m}"]) for m in METRICS], "metric string, value double")


def vectors(
    part: DataFrame, spec: TableSpec, state: PrepState, with_target: bool = True, dedup: bool = False, rows: int = 0
) -> DataFrame:
    """(id, features, label) of raw feature rows, ready for a model."""
    done = transform(part, spec, state, include_target=with_target, dedup=dedup, keep=(spec.id_col,), rows=rows)
    names = [c for c in state.feature_names if c != spec.id_col]
    return models.assemble(done, names, spec.target if with_target else None, spec.id_col, state.feature_fill)


def stored_vectors(parts: Prepared, name: str, spec: TableSpec) -> DataFrame:
    """The training vectors of a part, written once and spread for a fit."""
    distinct = parts.state.distinct if name == "train" else None
    raw = distinct if distinct is not None else parts.raw_parts(name)
    rows = raw.count()  # of a stored table
    done = vectors(raw, spec, parts.state, dedup=distinct is None, rows=rows)
    with compiled(done.sparkSession):
        return materialize(done, f"{name}-vectors", spread_by=ID, rows=rows)


def scored(model, df: DataFrame) -> DataFrame:
    """(label, prediction, probability), stored: metrics read them several times, and a score may cost a search."""
    return materialize(model.score(df).select(LABEL, "prediction", "probability"), "scored")


def metrics_of(model, df: DataFrame) -> dict[str, float]:
    row = evaluate(scored(model, df), LABEL, "prediction", "probability").first()
    return {m: row[m] for m in METRICS}


def cross_validate(candidate: Candidate, train: DataFrame, folds: int = 5) -> DataFrame:
    """(model, fold, auc): fit on the other folds, AUC on the held-out one.

    The folds are stored once, a folder each, and fitted side by side in scheduler pools.
    """
    marked = materialize(cv_folds(train, LABEL, ID, folds), "folds", partition_by=("fold",))

    def held_out(fold: int) -> float | None:
        model = candidate.train(marked.where(F.col("fold") != fold).drop("fold"))
        held = scored(model, marked.where(F.col("fold") == fold).drop("fold"))
        return roc_auc(held, LABEL, "probability").first()["auc"]

    found = in_pools(train.sparkSession, held_out, range(folds))
    rows = [(candidate.name, fold, auc) for fold, auc in enumerate(found)]
    return train.sparkSession.createDataFrame(rows, "model string, fold int, auc double")


def cv_summary(scores: DataFrame) -> DataFrame:
    return scores.groupBy("model").agg(
        F.avg("auc").alias("cv_auc_mean"), F.stddev_pop("auc").alias("cv_auc_std"), F.count("*").alias("folds"))


def train_suite(
    train: DataFrame, test: DataFrame, val: DataFrame | None = None, suite: Sequence[Candidate] | None = None,
    quick: bool = False, cv: int = 5, log_path: str | None = None, model_path: str | None = None, board_path: str | None = None,
    stored: bool = False,
) -> TrainedSuite:
    """Fit, evaluate and log every candidate. A failing one is recorded and skipped.

    ``board_path`` is where the leaderboard is stored as CSV. ``stored`` says that ``train`` and ``test`` are written and
    spread already (:func:`stored_vectors`).

    The driver only loops over models; each fit and each metric is a Spark job.
    """
    spark = train.sparkSession
    suite = suite if suite is not None else (QUICK_SUITE if quick else FULL_SUITE)
    if not stored:
        train, test = (materialize(df, "vectors", spread_by=ID) for df in (train, test))
    sizes = {"train_samples": train.count(), "test_samples": test.count()}
    result = TrainedSuite()
    for candidate in suite:
        log = RunLog(spark, log_path, candidate.name) if log_path else None
        try:
            started = time.monotonic()
            model = candidate.train(train)
            took = time.monotonic() - started
            scores = metrics_of(model, test)
            val_scores = metrics_of(model, val) if val is not None else {}
            folds = cv_summary(cross_validate(candidate, train, cv)).first() if cv else None
            if model_path:
                models.save_model(model, f"{model_path}/{candidate.name}", spark)
            if log:
                log.params({"model_type": candidate.name, **sizes, **candidate.params})
                log.metrics({
                    "training_time_seconds": took,
                    **{f"val_{m}": v for m, v in val_scores.items()},
                    **{f"test_{m}": v for m, v in scores.items()},
                    **({"cv_auc_mean": folds["cv_auc_mean"], "cv_auc_std": folds["cv_auc_std"]} if folds else {}),
                })
                log.flush()
            result.fitted[candidate.name] = model
            result.rows.append((
                candidate.name, scores["accuracy"], scores["auc"], scores["f1"], scores["precision"],
                scores["recall"], folds["cv_auc_mean"] if folds else None, took, None,
            ))
        except Exception as exc:  # one bad model must not end the run
            result.rows.append((candidate.name, *[None] * 7, f"{type(exc).__name__}: {exc}"[:500]))
    if board_path:
        write_csv(result.table(spark).coalesce(1), board_path)
    return result


def score_rows(
    df: DataFrame, spec: TableSpec, state: PrepState, model, version: str = "2.0.0", engineer: bool = True
) -> DataFrame:
    """Raw rows to answers: features, preparation, alignment, model, tier and risk factors.

    A map over the rows for every pipeline model, so it serves tables and
    streams alike.
    """
    rows = df.withColumn("__row", F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    rows = engineer_features(rows, spec, state.maxima or None) if engineer else rows
    done = transform(rows, spec, state, include_target=False, dedup=False, keep=(spec.id_col,))
    names = [c for c in state.feature_names if c != spec.id_col]
    vec = models.assemble(done, names, None, spec.id_col, state.feature_fill, carry=("__row",))
    scored = model.score(vec).select("__row.*", F.col("prediction").cast("int"), "probability")
    return respond(scored, spec, version)

"""Exact evaluation metrics, leaderboards and the model gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.operators.ranks import cumulate
from tablewarden.spec import METRICS

# Fixed value: the reason given for an approved candidate.
APPROVED_TEXT = "Candidate model meets performance criteria"


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def binary_metrics(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """accuracy, precision, recall and f1 of class 1 per key; 0 where a ratio is undefined."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    counts = df.groupBy(*keys).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if(y == p).alias("hits"),
        F.count("*").alias("n"),
    )
    return counts.select(
        *keys,
        "n",
        _ratio(F.col("hits"), F.col("n")).alias("accuracy"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )


def roc_auc(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve per key, ties counted half; null with one class only.

    The Mann-Whitney statistic over distinct scores: rows are combined per
    score before the shuffle, so hot scores cost nothing extra.
    """
    y = F.col(label).cast("int")
    counts = df.where(F.col(score).isNotNull()).groupBy(*keys, score).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )
    won = F.sum(F.col("pos") * (F.col("below_neg") + F.col("neg") / 2.0))
    pairs = F.max("total_pos").cast("double") * F.max("total_neg").cast("double")
    return cumulate(counts, keys, score, ["pos", "neg"]).groupBy(*keys).agg(F.try_divide(won, pairs).alias("auc"))


def evaluate(
    df: DataFrame, label: str, prediction: str, score: str | None, keys: Sequence[str] = ()
) -> DataFrame:
    """All five metrics per key; without a score the hard prediction is ranked."""
    hard = binary_metrics(df, label, prediction, keys)
    auc = roc_auc(df, label, score or prediction, keys)
    if keys:
        return hard.join(auc, list(keys))
    return hard.withColumn("auc", auc.scalar())


def metric_rows(metrics: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Wide metrics to (keys, metric, value)."""
    present = [m for m in METRICS if m in metrics.columns]
    return metrics.select(
        *keys, F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in present]))
    )


def leaderboard(results: DataFrame, by: str = "test_auc", name: str = "model") -> DataFrame:
    """One row per model, best first, names in order on a tie."""
    return results.orderBy(F.desc_nulls_last(by), F.asc(name))


def select_best(results: DataFrame, metric: str = "auc", name: str = "model") -> DataFrame:
    """(model, metric, score) of the best model; the first name wins a tie."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    value = F.col(metric)
    best = results.where(value.isNotNull()).agg(F.min_by(F.struct(name, metric), F.struct(-value, name)).alias("b"))
    return best.select(
        F.col(f"b.{name}").alias(name), F.lit(metric).alias("metric"), F.col(f"b.{metric}").alias("score")
    )


def compare_gate(baseline: DataFrame, candidate: DataFrame, threshold: float = 0.02) -> DataFrame:
    """(metric, baseline, candidate, delta, degraded) for the five metrics.

    Inputs are (metric, value) rows; a metric absent on one side counts as 0.
    """
    b = baseline.where(F.col("metric").isin(*METRICS)).select("metric", F.col("value").alias("b"))
    c = candidate.where(F.col("metric").isin(*METRICS)).select("metric", F.col("value").alias("c"))
    both = b.join(c, "metric", "full_outer").na.fill(0.0, ["b", "c"])
    delta = F.col("c") - F.col("b")
    return both.select(
        "metric",
        F.bround("b", 4).alias("baseline"),
        F.bround("c", 4).alias("candidate"),
        F.bround(delta, 4).alias("delta"),
        (delta < -threshold).alias("degraded"),
    )


def gate_decision(compared: DataFrame) -> DataFrame:
    """One row ``(approved, reasons)``; reasons name the degraded metrics in order."""
    reason = F.when(
        F.col("degraded"), F.format_string("%s degraded by %.4f", "metric", F.abs("delta"))
    )
    found = compared.agg(
        F.bool_and(~F.col("degraded")).alias("approved"),
        # At most five rows, one per metric.
        F.sort_array(F.collect_list(reason)).alias("reasons"),
    )
    fine = F.array(F.lit(APPROVED_TEXT))
    return found.select("approved", F.when(F.col("approved"), fine).otherwise(F.col("reasons")).alias("reasons"))

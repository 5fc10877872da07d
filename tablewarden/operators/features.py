"""Derived features, one projection for all of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.spec import (
    ACCESS_SCORE, ACTIVITY_SCORE, AGE_BINS, BMI_SCORE, DIET_SCORE, ECONOMY_SCORE,
    INSURANCE_SCORE, RISK_ROLES, SCREENING_SCORE, SIZE_BINS, STAGE_SCORE, TableSpec,
)

LIFESTYLE = {"bmi": BMI_SCORE, "diet": DIET_SCORE, "activity": ACTIVITY_SCORE}
QUALITY = {
    "access": ACCESS_SCORE, "insurance": INSURANCE_SCORE,
    "economy": ECONOMY_SCORE, "screening": SCREENING_SCORE,
}


def right_closed_bins(value: Column, bins: Sequence[tuple[float, float, str]]) -> Column:
    """Label of the (low, high] interval that holds ``value``; null outside all of them."""
    out = None
    for low, high, label in bins:
        test = (value > low) & (value <= high)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out


def ordinal(value: Column, scores: Mapping[str, int]) -> Column:
    """Score of a label; null for null and for labels without a score."""
    out = None
    for label, score in scores.items():
        out = F.when(value == label, score) if out is None else out.when(value == label, score)
    return out


def yes_flag(value: Column, positive: str = "Yes") -> Column:
    return F.coalesce((value == positive).cast("int"), F.lit(0))


def mean_score(df: DataFrame, spec: TableSpec, tables: Mapping[str, Mapping[str, int]]) -> Column | None:
    """Mean over the columns present; one unscored column makes the mean null."""
    parts = [
        ordinal(F.col(spec.roles[role]), scores)
        for role, scores in tables.items()
        if spec.role(role, df.columns)
    ]
    return sum(parts[1:], parts[0]) / F.lit(float(len(parts))) if parts else None


def risk_score(df: DataFrame, spec: TableSpec) -> Column | None:
    """How many of the risk columns say yes; columns already coded 0/1 count as they are."""
    types = dict(df.dtypes)
    flags = [
        yes_flag(F.col(c), spec.positive) if types[c] == "string"
        else F.coalesce(F.col(c).cast("int"), F.lit(0))
        for c in (spec.role(r, df.columns) for r in RISK_ROLES)
        if c
    ]
    return sum(flags[1:], flags[0]) if flags else None


def interaction_maxima(df: DataFrame, spec: TableSpec) -> dict[str, float]:
    """Maxima behind the age-size interaction, to be kept with the fitted state."""
    age, size = spec.roles["age"], spec.roles["size"]
    row = df.agg(F.max(age).alias("age"), F.max(size).alias("size")).first()
    return {"age": row["age"], "size": row["size"]}


def interaction(df: DataFrame, spec: TableSpec, maxima: Mapping[str, float] | None) -> Column | None:
    age, size = spec.role("age", df.columns), spec.role("size", df.columns)
    if not (age and size):
        return None
    if maxima is None:
        top_age: Column = df.agg(F.max(age)).scalar()
        top_size: Column = df.agg(F.max(size)).scalar()
    else:
        top_age, top_size = F.lit(maxima["age"]), F.lit(maxima["size"])
    return F.try_divide(F.col(age).cast("double"), top_age) * F.try_divide(F.col(size).cast("double"), top_size)


def feature_columns(
    df: DataFrame, spec: TableSpec, maxima: Mapping[str, float] | None = None
) -> dict[str, Column]:
    """Name to expression for every feature whose inputs the table has, in fixed order."""
    age, size = spec.role("age", df.columns), spec.role("size", df.columns)
    cost, stage = spec.role("cost", df.columns), spec.role("stage", df.columns)
    found = {
        "age_group": right_closed_bins(F.col(age), AGE_BINS) if age else None,
        "risk_score": risk_score(df, spec),
        "lifestyle_score": mean_score(df, spec, LIFESTYLE),
        "healthcare_quality_score": mean_score(df, spec, QUALITY),
        "tumor_severity": right_closed_bins(F.col(size), SIZE_BINS) if size else None,
        "age_tumor_interaction": interaction(df, spec, maxima),
        "cost_per_mm": F.try_divide(F.col(cost).cast("double"), F.col(size) + 1) if cost and size else None,
        "stage_severity_score": ordinal(F.col(stage), STAGE_SCORE) if stage else None,
    }
    return {name: expr for name, expr in found.items() if expr is not None}


def engineer_features(
    df: DataFrame,
    spec: TableSpec,
    maxima: Mapping[str, float] | None = None,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Add the derived features (all of them, or those named in ``only``).

    Without ``maxima`` the interaction uses those of ``df`` itself, as scalar
    subqueries over two pruned columns; with them (the fitted state) the whole
    step is a map over the rows.
    """
    columns = feature_columns(df, spec, maxima)
    if only is not None:
        columns = {name: columns[name] for name in only}
    return df.withColumns(columns)


NUMERIC_FEATURES = (
    "risk_score", "lifestyle_score", "healthcare_quality_score",
    "age_tumor_interaction", "cost_per_mm", "stage_severity_score",
)

"""Scalers as (center, spread) pairs, applied as one projection.

The ML library's scalers are not used: they divide by the sample deviation,
map constant columns to 0.5 and take approximate quartiles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.operators.clean import long_form
from tablewarden.operators.ranks import exact_quantiles


def fit_scaler_and_means(
    df: DataFrame, columns: Sequence[str], kind: str = "standard", means_of: Sequence[str] = ()
) -> tuple[dict[str, tuple[float, float]], dict[str, float]]:
    """The scaler of :func:`fit_scaler` and plain means of other columns, in one job where possible."""
    aggs = [F.avg(f"`{c}`").alias(f"{c}__m") for c in means_of]
    if kind != "robust":
        low, spread = (F.min, lambda c: F.max(c) - F.min(c)) if kind == "minmax" else (F.avg, F.stddev_pop)
        aggs += [low(f"`{c}`").cast("double").alias(f"{c}__c") for c in columns]
        aggs += [spread(f"`{c}`").cast("double").alias(f"{c}__s") for c in columns]
    row = df.agg(*aggs).first() if aggs else {}
    means = {c: row[f"{c}__m"] for c in means_of if row[f"{c}__m"] is not None}
    if kind == "robust":
        pairs = _quartiles(df, columns) if columns else {}
    else:
        pairs = {c: (row[f"{c}__c"], row[f"{c}__s"]) for c in columns if row[f"{c}__c"] is not None}
    return {c: (center, spread or 1.0) for c, (center, spread) in pairs.items()}, means


def _quartiles(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(median, interquartile range) of all columns in one plan."""
    found = exact_quantiles(long_form(df, columns, "double"), ["column"], "value", [0.25, 0.5, 0.75], few_keys=True)
    by_column: dict[str, dict[float, float]] = {}
    for r in found.collect():
        by_column.setdefault(r["column"], {})[r["fraction"]] = r["quantile"]
    return {c: (q[0.5], q[0.75] - q[0.25]) for c, q in by_column.items()}


def fit_scaler(df: DataFrame, columns: Sequence[str], kind: str = "standard") -> dict[str, tuple[float, float]]:
    """(center, spread) per column; nulls are left out, a spread of 0 becomes 1.

    ``minmax`` and ``robust`` are named kinds; any other name is ``standard``.
    """
    return fit_scaler_and_means(df, columns, kind)[0]


def apply_scaler(df: DataFrame, params: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Scale the fitted columns; without fitted parameters the table is unchanged."""
    return df.withColumns({
        c: (F.col(f"`{c}`") - F.lit(center)) / F.lit(spread)
        for c, (center, spread) in params.items() if c in df.columns
    })


def undo_scaler(df: DataFrame, params: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({
        c: F.col(f"`{c}`") * F.lit(spread) + F.lit(center)
        for c, (center, spread) in params.items() if c in df.columns
    })

"""Projection, duplicate removal and imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.functions.sql import name, text
from tablewarden.operators.ranks import exact_quantiles
from tablewarden.spec import TableSpec


def present(df: DataFrame, column: str) -> Column:
    """The column with NaN as null: both are missing values."""
    value = F.col(f"`{column}`")
    return F.when(~F.isnan(value), value) if dict(df.dtypes)[column] in ("double", "float") else value


def drop_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.drop(*spec.drop)


def separate_target(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(features, target). Both keep the id, the only safe way back: rows have no order."""
    keys = [spec.id_col] if spec.id_col in df.columns else []
    return df.drop(spec.target), df.select(*keys, spec.target)


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """(target, n, share_pct); the window runs over the few class rows only."""
    return (
        df.groupBy(target).agg(F.count("*").alias("n"))
        .withColumn("share_pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()))
    )


def align_features(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``names`` in that order: absent ones are 0, others are dropped."""
    return df.select(
        *[F.col(f"`{c}`") for c in keep],
        *[F.col(f"`{c}`") if c in df.columns else F.lit(0).alias(c) for c in names],
    )


def remove_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def cells(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], cast: str,
    label: str = "column", value: str = "value",
) -> DataFrame:
    """(ids, column, value): one row per cell of ``columns`` that is neither null nor NaN, cast to one type."""
    # A generator keeps the identity of the id columns, which lets plans that use the
    # result several times share its shuffle; the unpivot operator would not.
    floating = {c for c, dtype in df.dtypes if dtype in ("double", "float")}
    found = {c: f"nullif({name(c)}, double('NaN'))" if c in floating else name(c) for c in columns}
    pairs = ", ".join(f"{text(c)}, cast({found[c]} as {cast})" for c in columns)
    stacked = f"stack({len(columns)}, {pairs}) as ({name(label)}, {name(value)})"
    return df.selectExpr(*[name(c) for c in ids], stacked).where(F.col(value).isNotNull())


def long_form(df: DataFrame, columns: Sequence[str], cast: str) -> DataFrame:
    return cells(df, [], columns, cast)


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for the categories of all ``columns`` in one aggregation."""
    return long_form(df, columns, "string").groupBy("column", "value").agg(F.count("*").alias("n"))


def numeric_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(present(df, c)).alias(c) for c in columns]).first() if columns else {}
    return {c: row[c] for c in columns if row[c] is not None}


def numeric_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians of all columns, with linear interpolation between the middle values."""
    if not columns:
        return {}
    found = exact_quantiles(long_form(df, columns, "double"), ["column"], "value", [0.5], few_keys=True)
    return {r["column"]: r["quantile"] for r in found.collect()}


def modes(counts: DataFrame) -> dict[str, str]:
    """Most frequent value per column, the smallest one on a tie."""
    best = counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("value"))
    return {r["column"]: r["value"] for r in best.collect()}


def fit_fill_values(
    df: DataFrame, spec: TableSpec, strategy: str = "mean", counts: DataFrame | None = None
) -> dict[str, object]:
    """Replacement per column: mean or median for numbers, mode for categories.

    Any other strategy name means the mean, except ``drop``, which has none.
    """
    if strategy == "drop":
        return {}
    numeric = [c for c in spec.numerical if c in df.columns]
    categorical = [c for c in spec.categorical if c in df.columns]
    fill: dict[str, object] = dict((numeric_medians if strategy == "median" else numeric_means)(df, numeric))
    if categorical:
        fill.update(modes(counts if counts is not None else level_counts(df, categorical)))
    return fill


def fill_missing(df: DataFrame, fill: Mapping[str, object]) -> DataFrame:
    return df.withColumns({
        c: F.coalesce(present(df, c), F.lit(v)) for c, v in fill.items() if c in df.columns
    })


def handle_missing(
    df: DataFrame, spec: TableSpec, strategy: str = "mean", fill: Mapping[str, object] | None = None
) -> DataFrame:
    """Fill or drop. Without ``fill`` the statistics come from ``df`` itself."""
    if strategy == "drop":
        return df.dropna("any")
    return fill_missing(df, fill if fill is not None else fit_fill_values(df, spec, strategy))

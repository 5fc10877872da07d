"""Registered queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with its check SQL if there is one."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def r6(df: DataFrame, *columns: str) -> DataFrame:
    """Round float columns for comparison (all doubles when none are named)."""
    names = columns or [n for n, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), 6) for c in names})


def stamp(col: str | Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")

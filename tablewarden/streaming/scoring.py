"""Scoring of a request stream: constraints, features, model, tier, risk factors, canary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.operators.traffic import canary_assign
from tablewarden.operators.validate import accepted, rejected, request_constraints
from tablewarden.plans.prepare import PrepState
from tablewarden.plans.training import score_rows
from tablewarden.spec import TableSpec


def score_stream(
    requests: DataFrame, spec: TableSpec, state: PrepState, model, ratio: float = 0.30, version: str = "2.0.0"
) -> DataFrame:
    """Answers for the acceptable requests. A stateless plan: the same on a table and on a stream."""
    good = accepted(request_constraints(requests, spec))
    return canary_assign(score_rows(good, spec, state, model, version), spec.id_col, ratio)


def dead_letters(requests: DataFrame, spec: TableSpec) -> DataFrame:
    """The refused requests with what is wrong with them."""
    return rejected(request_constraints(requests, spec)).withColumn("error", F.array_join("errors", "; "))

"""Canary assignment of requests and checks of the traffic split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.operators.split import hash_fraction
from tablewarden.spec import Thresholds

STABLE, CANARY = "api_v1", "model_v2"


def canary_destination(request_id: str | Column, ratio: float = 0.30, seed: int = 42) -> Column:
    """Destination of a request: a hash of its id, so the answer is repeatable and stream-safe."""
    if not 0 <= ratio <= 1:
        raise ValueError("ratio must be between 0 and 1")
    return F.when(hash_fraction(request_id, seed) < ratio, CANARY).otherwise(STABLE)


def canary_assign(df: DataFrame, request_id: str, ratio: float = 0.30, seed: int = 42) -> DataFrame:
    return df.withColumn("destination", canary_destination(request_id, ratio, seed))


def route_counts(df: DataFrame, labels: Sequence[str], destination: str = "destination") -> DataFrame:
    """(destination, labels, n)."""
    return df.groupBy(destination, *labels).agg(F.count("*").alias("n"))


def canary_verify(
    df: DataFrame, succeeded: Column, ratio: float = 0.30, limits: Thresholds = Thresholds(),
    destination: str = "destination",
) -> DataFrame:
    """One row: counts per destination among successes, errors, the share and whether it is in tolerance."""
    to = F.col(destination)
    counts = df.agg(
        F.count_if(succeeded & (to == STABLE)).alias("stable_requests"),
        F.count_if(succeeded & (to == CANARY)).alias("canary_requests"),
        F.count_if(~succeeded).alias("errors"),
    )
    share = F.try_divide(
        F.col("canary_requests").cast("double"), F.col("stable_requests") + F.col("canary_requests")
    )
    ok = F.coalesce(F.abs(share - ratio) <= limits.canary_tolerance, F.lit(False))
    return counts.withColumn("canary_share", share).withColumn("within_tolerance", ok)


def traffic_stats(ratio: float) -> dict[str, int | float]:
    """The configured split in whole percent."""
    return {
        "current_ratio": ratio,
        "api_v1_percentage": int((1 - ratio) * 100),
        "model_v2_percentage": int(ratio * 100),
    }

"""Running a streaming table once over what is available."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from tablewarden.session import scratch_path


def run_available(stream: DataFrame, name: str, timeout: int | None = None) -> tuple[DataFrame, StreamingQuery]:
    """Process all available input into Parquet in the shared folder; append mode.

    Returns the written table and the finished query. Rows go from the tasks
    to files, never through the driver.
    """
    spark: SparkSession = stream.sparkSession
    out, state = scratch_path(spark, name), scratch_path(spark, f"{name}-state")
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    query.awaitTermination(timeout)
    return spark.read.schema(stream.schema).parquet(out), query


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped behind the watermark, over all recorded batches.

    Counted after partial aggregation, so several late input rows of one group
    and batch count once.
    """
    return sum(
        op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators
    )

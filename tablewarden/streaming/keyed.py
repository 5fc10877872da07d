"""What the stateful rules share: one processor per key, driven by rows and by event-time timers."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def key_columns(keys: Sequence[str], key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """``rows`` with the values of the key in front."""
    for name, value in zip(reversed(keys), reversed(key), strict=True):
        rows.insert(0, name, value)
    return rows


def run_keyed(rows: DataFrame, keys: Sequence[str], processor: StatefulProcessor, schema: str) -> DataFrame:
    """Append-mode output of ``processor`` per key; ``rows`` carry a watermark."""
    types = dict(rows.dtypes)
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=", ".join([*(f"`{k}` {types[k]}" for k in keys), schema]),
        outputMode="Append", timeMode="EventTime",
    )

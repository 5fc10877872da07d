"""Silent intervals of known series on a stream, told by event-time timers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tablewarden.operators.alerts import seconds, sliding
from tablewarden.streaming.keyed import key_columns, run_keyed

_MICROS = 1_000_000


def _processor(keys: Sequence[str], width: int) -> StatefulProcessor:
    """Times are microseconds since the epoch."""

    class Liveness(StatefulProcessor):
        """Keeps per series the start of the first interval that is not told yet."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.next = handle.getValueState("next", "start long")

        def _due(self, start: int) -> int:
            return (start + width) // 1000 - 1

        def _told(self, key, silent: list, start: int) -> pd.DataFrame:
            self.handle.registerTimer(self._due(start))
            self.next.update((start,))
            return key_columns(keys, key, pd.DataFrame({"window_start": pd.Series(silent, dtype="int64")}))

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            # One row per interval with events that the watermark closed in this batch.
            seen = sorted(pd.concat(list(rows))["start"].tolist())
            start = self.next.get()[0] if self.next.exists() else None
            if start is not None:
                self.handle.deleteTimer(self._due(start))
            silent = []
            for at in seen:
                silent += range(at if start is None else start, at, width)
                start = at + width
            closed = timerValues.getCurrentWatermarkInMs() * 1000
            while start + width <= closed:
                silent.append(start)
                start += width
            yield self._told(key, silent, start)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            start, silent = self.next.get()[0], []
            closed = timerValues.getCurrentWatermarkInMs() * 1000
            while start + width <= closed:
                silent.append(start)
                start += width
            yield self._told(key, silent, start)

        def close(self) -> None:
            pass

    return Liveness()


def silent_intervals(requests: DataFrame, ts: str, keys: Sequence[str], width: str) -> DataFrame:
    """(keys, window_start) of the closed intervals without an event, from a series' first event on.

    The rule of ``alerts.silent_series`` for streams, which know a series from its first event and can tell an
    interval silent once the watermark has passed its end. Events are combined per interval before they reach
    the state, which is one number and one timer per series.
    """
    counted = sliding(requests, ts, width, width, keys, {"n": F.count("*")}, event_time="event_time")
    rows = counted.select(*keys, F.unix_micros("window_start").alias("start"), "event_time")
    silent = run_keyed(rows, keys, _processor(list(keys), seconds(width) * _MICROS), "window_start long")
    return silent.withColumn("window_start", F.timestamp_micros("window_start"))

"""Stateful `hold for` rule with event-time timers: pending, firing, resolved.

A series that falls silent while its condition holds sends no row that could end the run. So every run
keeps a timer at its next evaluation, and when the watermark passes that time without a true row the run ends
there, as an absent evaluation ends it in ``alerts.sustained``. A series holds one run and one timer,
whatever its number of events.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tablewarden.operators.alerts import seconds
from tablewarden.streaming.keyed import key_columns, run_keyed

EVENTS = "at long, state string, pending_since long"
_MICROS = 1_000_000


def _processor(keys: Sequence[str], step: int, needed: int) -> StatefulProcessor:
    """Times are microseconds since the epoch."""

    class Hold(StatefulProcessor):
        """Keeps per series when the condition became true, was last true and whether it fired."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.run = handle.getValueState("run", "since long, last long, fired boolean")

        def _due(self, last: int) -> int:
            # Timers expire once the watermark is beyond them; evaluations are closed when it reaches them.
            return (last + step) // 1000 - 1

        def _end(self, run: tuple, events: list) -> None:
            since, last, fired = run
            events.append((last + step, "resolved" if fired else "inactive", since))

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            # One row per window of this series that the watermark closed in this batch.
            batch = pd.concat(list(rows)).sort_values("at")
            saved = run = tuple(self.run.get()) if self.run.exists() else None
            events = []
            for when, true in zip(batch["at"].tolist(), batch["true"].tolist(), strict=True):
                if run and (not true or when - run[1] > step):
                    self._end(run, events)
                    run = None
                if true:
                    if run is None:
                        events.append((when, "pending", when))
                    since, _, fired = run or (when, when, False)
                    if not fired and when - since >= needed:
                        events.append((since + needed, "firing", since))
                        fired = True
                    run = (since, when, fired)
            if run and timerValues.getCurrentWatermarkInMs() * 1000 >= run[1] + step:
                self._end(run, events)
                run = None
            if saved and (run is None or run[1] != saved[1]):
                self.handle.deleteTimer(self._due(saved[1]))
            if run and (saved is None or run[1] != saved[1]):
                self.handle.registerTimer(self._due(run[1]))
            self._keep(run)
            yield key_columns(keys, key, pd.DataFrame(events, columns=["at", "state", "pending_since"]))

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            events = []
            if self.run.exists():
                run = tuple(self.run.get())
                if expiredTimerInfo.getExpiryTimeInMs() == self._due(run[1]):
                    self._end(run, events)
                    self._keep(None)
            yield key_columns(keys, key, pd.DataFrame(events, columns=["at", "state", "pending_since"]))

        def _keep(self, run: tuple | None) -> None:
            if run is None:
                self.run.clear()
            else:
                self.run.update(run)

        def close(self) -> None:
            pass

    return Hold()


def hold_for(
    evaluated: DataFrame, at: str, condition: str, keys: Sequence[str], every: str, hold: str, event_time: str | None = None,
) -> DataFrame:
    """Alert transitions (keys, at, state, pending_since) of an evaluated stream with a watermark.

    Works after a windowed aggregation in the same query (append mode), whose event time column is
    ``event_time`` (``at`` itself where that carries the watermark), and needs the RocksDB state store.
    Same rule as ``alerts.sustained``, the latest evaluation being the last one that the watermark has closed.
    """
    rows = evaluated.select(*keys, F.unix_micros(at).alias("at"), F.col(condition).alias("true"),
                            F.col(event_time or at).alias("event_time"))
    processor = _processor(list(keys), seconds(every) * _MICROS, seconds(hold) * _MICROS)
    moves = run_keyed(rows, keys, processor, EVENTS)
    return moves.withColumns({c: F.timestamp_micros(c) for c in ("at", "pending_since")})

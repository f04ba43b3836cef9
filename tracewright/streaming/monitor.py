"""A live monitor of runs: each run's stop is told once, over restarts, with a breaker shared by the runs of a batch.

State lives in the state store by batch: counters of each run, the errors seen, and whether a run has been stopped. It is
checkpointed with the stream, so a restart goes on where the last micro-batch ended and a stop isn't told again. An
event-time timer tells runs that went silent, and forgets a batch when all has been silent for ``keep``; a batch that is
logged again later begins anew.

Within a micro-batch events are taken in the order of time and line. Each event is judged by the first rule that holds:
an upstream stop; more calls than allowed; the batch's distinct errors at the breaker's limit, which stops every run that
is open; the run's own errors at its limit. Equal errors (run, line) count once, null lines included. Events of a stopped
run count nothing. Rows with a null batch or run are left out. A batch's runs are held by one task: a batch is one
dispatch of runs, thousands at most; runs without a common breaker should each be a batch of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

STOPS = "batch string, run string, at timestamp, line long, reason string, calls long, errors long"
#: The state store that timers and maps need.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@dataclass(frozen=True)
class Limits:
    """Calls and errors of a run, errors of a batch, and the silences in seconds after which a run and a batch end."""

    calls: int = 100
    errors: int = 5
    batch_errors: int = 20
    idle: int = 600
    keep: int = 86_400


class StopMonitor(StatefulProcessor):
    """Rows of a batch: (run, at, line, kind) with the kinds call, error and stop; others only show that a run is alive."""

    def __init__(self, limits: Limits):
        self.limits = limits

    def init(self, handle) -> None:
        self.handle = handle
        self.runs = handle.getMapState("runs", "run string", "calls long, errors long, last long, stopped boolean")
        self.seen = handle.getMapState("errors", "run string, line long, known boolean", "n long")
        self.totals = handle.getValueState("totals", "errors long, last long, tripped boolean")

    def _totals(self) -> tuple[int, int, bool]:
        return tuple(self.totals.get()) if self.totals.exists() else (0, 0, False)

    def _run(self, run: str) -> list:
        return list(self.runs.getValue((run,))) if self.runs.containsKey((run,)) else [0, 0, 0, False]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows)).sort_values(["at", "line", "run", "kind"], kind="stable")
        errors, last, tripped = self._totals()
        out: list[tuple] = []
        states: dict[str, list] = {}

        def stop(run: str, at, line, reason: str) -> None:
            state = states[run]
            state[3] = True
            out.append((key[0], run, at, line, reason, state[0], state[1]))

        for e in events.itertuples(index=False):
            if e.run not in states:  # the store is asked once a run
                states[e.run] = self._run(e.run)
            state = states[e.run]
            ms = int(e.at.value // 1_000_000)
            last, state[2] = max(last, ms), max(state[2], ms)
            if state[3]:
                continue
            line = None if pd.isna(e.line) else int(e.line)
            if e.kind == "call":
                state[0] += 1
            elif e.kind == "error":
                place = (e.run, line or 0, line is not None)
                if not self.seen.containsKey(place):
                    self.seen.updateValue(place, (1,))
                    state[1], errors = state[1] + 1, errors + 1
            if e.kind == "stop":
                stop(e.run, e.at, line, "upstream")
            elif state[0] > self.limits.calls:
                stop(e.run, e.at, line, "calls")
            elif errors >= self.limits.batch_errors and not tripped:
                tripped = True
                for (run,), _ in list(self.runs.iterator()):
                    states.setdefault(run, self._run(run))
                for run in sorted(r for r, s in states.items() if not s[3]):
                    stop(run, e.at, line, "batch errors")
            elif tripped:
                stop(e.run, e.at, line, "batch errors")
            elif state[1] >= self.limits.errors:
                stop(e.run, e.at, line, "errors")
        for run, state in states.items():
            self.runs.updateValue((run,), tuple(state))
        self.totals.update((errors, last, tripped))
        self.handle.registerTimer(last + self.limits.idle * 1000)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        errors, last, tripped = self._totals()
        if now >= last + self.limits.keep * 1000:
            self.runs.clear()
            self.seen.clear()
            self.totals.clear()
            yield self._frame([])
            return
        out, later = [], last + self.limits.keep * 1000
        for (run,), state in sorted(self.runs.iterator(), key=lambda x: x[0][0]):
            calls, own, seen, stopped = state
            if stopped:
                continue
            end = seen + self.limits.idle * 1000
            if end <= now:
                out.append((key[0], run, pd.Timestamp(end, unit="ms"), None, "idle", calls, own))
                self.runs.updateValue((run,), (calls, own, seen, True))
            else:
                later = min(later, end)
        self.handle.registerTimer(later)
        yield self._frame(out)

    def close(self) -> None:
        pass

    @staticmethod
    def _frame(rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=[c.split()[0] for c in STOPS.split(", ")])
        return frame.astype({"line": "Int64", "calls": "int64", "errors": "int64", "at": "datetime64[ns]"})


def live_stops(stream: DataFrame, batch: str, run: str, at: str, line: str, kind: str, delay: str, limits: Limits = Limits()) -> DataFrame:  # noqa: B008
    """The stops of ``STOPS``, in append mode. Events later than ``delay`` behind the latest one are dropped."""
    columns = {"batch": batch, "run": run, "at": at, "line": line, "kind": kind}
    types = {"batch": "string", "run": "string", "at": "timestamp", "line": "long", "kind": "string"}
    events = stream.select(*(F.col(c).cast(types[n]).alias(n) for n, c in columns.items())).where("batch IS NOT NULL AND run IS NOT NULL AND at IS NOT NULL")
    return events.withWatermark("at", delay).groupBy("batch").transformWithStateInPandas(StopMonitor(limits), STOPS, "Append", "EventTime")

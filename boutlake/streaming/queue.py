"""The work queue as keyed state: locks end by timers, not by scans of a task table.

Events of a task (seed, claim, done, failed) arrive in any order of tasks; each task has its own state of a few fields
and, while it is locked, one timer at the end of its lock. When event time passes that, the task is
pending again, or failed if its attempts are used up. State is spread by task over the store's partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# Attempts of a task and minutes of a lock.
ATTEMPTS, LOCK_MINUTES = 3, 30
STATE = "status string, attempts int, locked_by string, locked_until long"
CHANGES = "task_id string, change string, status string, attempts int, locked_by string, at timestamp"
#: The state store that timers need.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class TaskQueue(StatefulProcessor):
    """Status, attempts, owner and end of the lock of one task."""

    def __init__(self, attempts: int = ATTEMPTS, lock_minutes: float = LOCK_MINUTES) -> None:
        self.attempts, self.lock_ms = attempts, int(lock_minutes * 60_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.task = handle.getValueState("task", STATE)

    def _changed(self, key: tuple, change: str, status: str, attempts: int, owner: str | None, at: int, until: int | None = None) -> tuple:
        self.task.update((status, attempts, owner, until))
        return (key[0], change, status, attempts, owner, pd.Timestamp(at, unit="ms"))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        events = sorted((e for part in rows for e in part.itertuples(index=False)), key=lambda e: e.at)
        out = []
        for e in events:
            at = int(e.at.timestamp() * 1000)
            status, attempts, owner, until = self.task.get() if self.task.exists() else (None, 0, None, None)
            if status == "LOCKED" and until <= at:  # the timer has not come round yet
                self.handle.deleteTimer(until)
                out.append(self._expired(key, attempts, until))
                status, owner = out[-1][2], None
            if e.event == "seed" and status is None:
                out.append(self._changed(key, "seeded", "PENDING", 0, None, at))
            elif e.event == "claim" and status == "PENDING":
                self.handle.registerTimer(at + self.lock_ms)
                out.append(self._changed(key, "claimed", "LOCKED", attempts + 1, e.worker, at, at + self.lock_ms))
            elif e.event in ("done", "failed") and status == "LOCKED" and owner == e.worker:
                self.handle.deleteTimer(until)
                again = e.event == "failed" and attempts < self.attempts
                out.append(self._changed(key, e.event, "PENDING" if again else "DONE" if e.event == "done" else "FAILED", attempts, None, at))
        yield _frame(out)

    def _expired(self, key: tuple, attempts: int, until: int) -> tuple:
        return self._changed(key, "expired", "PENDING" if attempts < self.attempts else "FAILED", attempts, None, until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        status, attempts, _, until = self.task.get()
        due = status == "LOCKED" and until == expiredTimerInfo.getExpiryTimeInMs()
        yield _frame([self._expired(key, attempts, until)] if due else [])

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[x.split()[0] for x in CHANGES.split(", ")])
    out["at"] = pd.to_datetime(out["at"])
    return out


def queue_changes(events: DataFrame, late: str = "10 minutes", attempts: int = ATTEMPTS, lock_minutes: float = LOCK_MINUTES) -> DataFrame:
    """A stream of events (task_id, event, worker, at) → the changes that they and the ends of locks make.

    Event time is at, up to ``late`` behind; spark.sql.streaming.stateStore.providerClass is to be PROVIDER.
    An event that does not fit a task's state (a claim of a locked task, a result by another worker) changes nothing.
    """
    keyed = events.withWatermark("at", late).groupBy("task_id")
    return keyed.transformWithStateInPandas(TaskQueue(attempts, lock_minutes), CHANGES, "Append", "EventTime")

"""Progress of stages, in batch and in streams, from metrics that the stages' own jobs gather: no row is read twice."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


class StageLog:
    """Lines of `stage: done of total, rate a second`; of each stage at most one in `every` seconds, and always the last."""

    def __init__(self, write: Callable[[str], None], every: float = 1.0, clock: Callable[[], float] = time.monotonic):
        self.write, self.every, self.clock = write, every, clock
        self.said: dict[str, float] = {}
        self.began: dict[str, float] = {}
        self.lock = threading.Lock()

    def start(self, stage: str) -> None:
        with self.lock:
            self.began[stage] = self.clock()

    def say(self, stage: str, done: int, total: int | None = None, last: bool = False) -> bool:
        """Whether the line was written."""
        with self.lock:
            now = self.clock()
            began = self.began.setdefault(stage, now)
            if not last and now - self.said.get(stage, float("-inf")) < self.every:
                return False
            self.said[stage] = now
            rate = f", {done / (now - began):.0f} a second" if now > began else ""
            self.write(f"{stage}: {done}{'' if total is None else f' of {total}'}{rate}")
            return True


def observed(rows: DataFrame, stage: str, **values: Column) -> tuple[DataFrame, Observation]:
    """rows, and what their next job will have counted: rows, and the aggregates given."""
    seen = Observation(stage)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[v.alias(k) for k, v in values.items()]), seen


def figures(stages: list[tuple[str, Observation]], log: StageLog) -> dict[str, dict]:
    """Metrics of stages whose jobs are done, each written as a last line."""
    found = {}
    for stage, seen in stages:
        found[stage] = seen.get
        log.say(stage, found[stage]["rows"], last=True)
    return found


class StreamProgress(StreamingQueryListener):
    """Writes the running count of every observed stage of a stream (rows.observe(stage, count as rows))."""

    def __init__(self, log: StageLog):
        self.log, self.rows = log, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for stage, row in event.progress.observedMetrics.items():
            self.rows[stage] = self.rows.get(stage, 0) + row["rows"]
            self.log.say(stage, self.rows[stage])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        for stage, rows in self.rows.items():
            self.log.say(stage, rows, last=True)

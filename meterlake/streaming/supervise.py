"""Keeping a stream going: restarts from its checkpoint, and a record of its progress."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

PROGRESS = (
    "attempt int, batch bigint, started string, input_rows bigint, duration_ms bigint, failure string"
)
FIRST_WAIT = 1.0
LONGEST_WAIT = 300.0


@dataclass
class Supervised:
    """What became of a supervised run: a row for every batch, and for every failure."""

    rows: list[tuple] = field(default_factory=list)
    attempts: int = 0

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, PROGRESS)


def _noted(query: StreamingQuery, attempt: int, seen: set[tuple[str, int]]) -> list[tuple]:
    """Batches among the query's recent progress that were not noted before."""
    rows = []
    for progress in query.recentProgress:
        told = progress if isinstance(progress, dict) else json.loads(progress.json)
        key = (told["runId"], told["batchId"])
        if key not in seen and told.get("durationMs", {}).get("addBatch") is not None:
            seen.add(key)
            rows.append(
                (attempt, told["batchId"], told["timestamp"], told["numInputRows"],
                 told["durationMs"].get("triggerExecution", 0), None)
            )
    return rows


def supervise(
    start: Callable[[], StreamingQuery],
    restarts: int = 5,
    first_wait: float = FIRST_WAIT,
    longest_wait: float = LONGEST_WAIT,
    poll: float = 5.0,
    stop_after: float | None = None,
) -> Supervised:
    """Run a stream until it ends by itself, or until `stop_after` seconds have passed.

    `start` starts it, each time on the same checkpoint, so a restart goes on where the
    last complete batch ended. After a failure the wait doubles, up to `longest_wait`; a
    batch that goes through sets it back, and the number of restarts too. After `restarts`
    failures in a row the last one is raised. Progress is read from the query itself, at
    every `poll` seconds and at its end, which needs no listener; a query keeps its last
    hundred batches. Only these rows reach the driver.
    """
    run = Supervised()
    seen: set[tuple[str, int]] = set()
    wait, failures = first_wait, 0
    ends = None if stop_after is None else time.monotonic() + stop_after
    while True:
        run.attempts += 1
        query = start()
        try:
            while not query.awaitTermination(poll):
                run.rows += _noted(query, run.attempts, seen)
                if ends is not None and time.monotonic() >= ends:
                    query.stop()
            run.rows += _noted(query, run.attempts, seen)
            return run
        except StreamingQueryException as error:
            done = _noted(query, run.attempts, seen)
            run.rows += done
            if done:
                wait, failures = first_wait, 0
            failures += 1
            reason = (str(error).strip().splitlines() or [""])[0]
            run.rows.append((run.attempts, None, None, None, None, reason))
            if failures > restarts:
                raise
            time.sleep(wait)
            wait = min(2 * wait, longest_wait)

"""Watching a job: does a batch end within its interval, and how far behind is it?

``watched`` lets Spark count a stream's records, and their oldest and newest timestamp,
while a batch reads them (``Dataset.observe``): no scan is made for it. A ``Watch`` takes
these counts and the batch's times from the progress that Spark reports. They are for
watching: a task that is repeated after a lost executor may count again, and a batch
without progress is not there. What was read, used and set aside is in the ledger.
"""

from __future__ import annotations

import json
from collections import deque
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

OBSERVED = "feed"


def watched(records: DataFrame) -> DataFrame:
    """The same records, counted as they are read."""
    metrics = [F.count(F.lit(1)).alias("records")]
    if "timestamp" in records.columns:
        metrics += [F.min("timestamp").alias("oldest"), F.max("timestamp").alias("newest")]
    return records.observe(OBSERVED, *metrics)


@dataclass(frozen=True)
class Batch:
    """One batch: ``records`` and timestamps are null of a stream that is not ``watched``."""

    run: str
    number: int
    seconds: float
    records: int | None
    oldest: datetime | None
    newest: datetime | None
    in_time: bool


class Watch(StreamingQueryListener):
    """Keeps the last ``keep`` batches of the session's streams, or of the one query
    named by ``run``, each measured against ``interval_seconds``. To use it, give it to
    ``spark.streams.addListener``."""

    def __init__(self, interval_seconds: float, run: str | None = None, keep: int = 1_000):
        self.interval, self.run = interval_seconds, run
        self.batches: deque[Batch] = deque(maxlen=keep)
        self.failures: deque[str] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self.run in (None, str(progress.runId)):
            seen = progress.observedMetrics.get(OBSERVED)
            seen = seen.asDict() if seen else {}
            seconds = json.loads(progress.json)["durationMs"].get("triggerExecution", 0) / 1000
            self.batches.append(
                Batch(
                    run=str(progress.runId),
                    number=progress.batchId,
                    seconds=seconds,
                    records=seen.get("records"),
                    oldest=seen.get("oldest"),
                    newest=seen.get("newest"),
                    in_time=seconds <= self.interval,
                )
            )

    def onQueryTerminated(self, event) -> None:
        if event.exception and self.run in (None, str(event.runId)):
            self.failures.append(event.exception)

    def late(self) -> list[Batch]:
        """The batches that took longer than their interval."""
        return [batch for batch in self.batches if not batch.in_time]

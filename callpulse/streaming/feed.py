"""The combined feed as changes: a table of all figures that a receiver keeps up to date.

Every batch gives the rows of the combined figures that it has changed, with the batch's
number as ``version``, and a delete mark for each row that is there no longer. Of the
changes of one row the last version counts, in whatever order they are received
(``apply_changes``). There are two feeds:

- ``changes``: the figures of every snapshot, keyed by pubTime, kpi and dimension;
- ``current``: those of the last snapshot, keyed by kpi and dimension. A service whose
  queue has ended by then, or of which nothing is observed any more, loses its row.

What a batch has changed follows from the store of measures: figures of its snapshots
with the batch, against those without it. Only the batch's days and the last day are read,
and a batch that is repeated gives the same changes again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from callpulse.operators.kpis import combined, merged_measures, service_measures
from callpulse.sources.files import utc_day
from callpulse.streaming.jobs import BATCH_INTERVAL, COMPACT_EVERY, BatchWriter, _started
from callpulse.streaming.store import MeasureStore

CHANGE_KEYS = ("pubTime", "kpi", "dimension")
CURRENT_KEYS = ("kpi", "dimension")
CHANGES = "pubTime timestamp, kpi string, dimension string, value double, deleted boolean, version bigint"


def row_changes(before: DataFrame, after: DataFrame, *keys: str) -> DataFrame:
    """The rows of ``after`` that ``before`` has not, and, ``deleted``, the keys that only
    ``before`` has. Both hold a key once; null keys are equal. One shuffle by key."""
    values = [name for name in after.columns if name not in keys]
    old, new = (
        rows.select(*keys, F.struct(*values).alias(side))
        for side, rows in (("old", before), ("new", after))
    )
    both = old.unionByName(new, allowMissingColumns=True).groupBy(*keys)
    sides = both.agg(F.max("old").alias("old"), F.max("new").alias("new"))
    return sides.where(~F.col("old").eqNullSafe(F.col("new"))).select(
        *keys, "new.*", F.col("new").isNull().alias("deleted")
    )


def apply_changes(changes: DataFrame, *keys: str) -> DataFrame:
    """The table that the changes make: of each key the last version, unless it is a
    delete mark. Repeated changes and their order make no difference."""
    values = [c for c in changes.columns if c not in (*keys, "version", "deleted")]
    last = changes.groupBy(*keys).agg(
        F.max_by(F.struct(*values, "deleted"), "version").alias("last")
    )
    return last.where(~F.col("last.deleted")).select(*keys, *(f"last.{v}" for v in values))


def _figures(parts: DataFrame, touched: DataFrame) -> DataFrame:
    whole = parts.join(touched, "pubTime", "left_semi")
    return combined(whole.groupBy("pubTime", "services_name").agg(*merged_measures()))


def snapshot_changes(measures: DataFrame, store: MeasureStore, batch_id: int) -> DataFrame:
    """Changes of the snapshots that the batch's measures touch; the store has them."""
    touched = measures.select("pubTime").distinct()
    days = [r.day for r in measures.select(utc_day("pubTime").alias("day")).distinct().collect()]
    parts = store.read(days).where(F.col("batch_id") <= batch_id)
    before = parts.where(F.col("batch_id") < batch_id)
    return row_changes(_figures(before, touched), _figures(parts, touched), *CHANGE_KEYS)


def _last_snapshot(store: MeasureStore, through: int) -> DataFrame:
    """Figures of the last snapshot in the batches up to ``through``. One day is read."""
    for day in reversed(store.days()):
        first = [*store.closed_through(day)[-1:], *store.open_parts(day)]
        if first and min(first) <= through:
            parts = store.read([day]).where(F.col("batch_id") <= through)
            return _figures(parts, parts.agg(F.max("pubTime").alias("pubTime")))
    return combined(store.read([]))


def current_changes(store: MeasureStore, batch_id: int) -> DataFrame:
    """Changes that the batch has made to the figures of the last snapshot."""
    before, after = (_last_snapshot(store, through) for through in (batch_id - 1, batch_id))
    return row_changes(before, after, *CURRENT_KEYS)


def publish_changes(
    calls: DataFrame,
    changes: BatchWriter,
    current: BatchWriter,
    folder: str,
    interval: str = BATCH_INTERVAL,
    available_now: bool = False,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Start the job that gives the changes of the combined figures: of all snapshots to
    ``changes``, of the last one to ``current``. It stores measures in ``folder`` as
    ``store_measures`` does. Both writers may get a batch again after a failure."""
    store = MeasureStore(calls.sparkSession, folder)

    def run(batch: DataFrame, batch_id: int) -> None:
        measures = service_measures(batch).persist()
        try:
            store.write(measures, batch_id)
            if measures.isEmpty():
                return
            version = F.lit(batch_id).cast("bigint")
            for write, rows in (
                (changes, snapshot_changes(measures, store, batch_id)),
                (current, current_changes(store, batch_id)),
            ):
                rows = rows.withColumn("version", version).persist()
                try:
                    write(rows, batch_id)
                finally:
                    rows.unpersist()
            if batch_id % compact_every == compact_every - 1:
                store.compact(through=batch_id - 1)
        finally:
            measures.unpersist()

    return _started(calls.writeStream.foreachBatch(run), folder, interval, available_now)

"""Streaming jobs: figures per snapshot that are whole, stored measures, windows.

A job has one folder. Its checkpoint and the tables it writes are in there. A
restarted job reads its offsets and goes on after the last finished batch; a batch that
failed half-way runs again under the same number and replaces its own part of every
table. If the checkpoint is lost, the next run numbers its batches after those of the
run before (``ledger``).
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from callpulse.operators.frames import frames
from callpulse.operators.kpis import MEASURES, figures, merged_measures, service_measures
from callpulse.operators.messages import all_messages, batch_messages
from callpulse.operators.records import (
    decode_records,
    observations,
    parse_lines,
    quarantined,
)
from callpulse.schema import KPI_KEYS, RECORD_METADATA
from callpulse.sources.files import utc_day
from callpulse.streaming.ledger import PLACE, Ledger, offsets_read
from callpulse.streaming.store import MeasureStore
from callpulse.streaming.watch import watched

BatchWriter = Callable[[DataFrame, int], None]

# Fixed value: the interval at which figures are published unless asked otherwise.
BATCH_INTERVAL = "3 seconds"

#: Batches after which open parts of the store are closed.
COMPACT_EVERY = 100


def _started(
    writer: DataStreamWriter, folder: str, interval: str, available_now: bool
) -> StreamingQuery:
    writer = writer.option("checkpointLocation", f"{folder}/checkpoint")
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def stored_measures(spark: SparkSession, folder: str) -> DataFrame:
    """What the job in ``folder`` has stored: measures per snapshot, service and
    part, with the columns ``day`` and ``batch_id``."""
    return MeasureStore(spark, folder).read()


def _whole_snapshots(batch: DataFrame, store: MeasureStore) -> DataFrame:
    """Stored measures of every snapshot that the batch has touched.

    The batch's days, a handful of numbers, name the parts of the store that are read;
    the snapshots are then matched by a join. No call is read again.
    """
    touched = batch.select("pubTime", utc_day("pubTime").alias("day")).distinct()
    days = [row.day for row in touched.select("day").distinct().collect()]
    whole = store.read(days).join(touched.select("pubTime"), "pubTime", "left_semi")
    return whole.groupBy("pubTime", "services_name").agg(*merged_measures())


_BAD = "_bad"


def _reduced(parsed: DataFrame) -> DataFrame:
    """All that a batch gives, in one pass over its records: measures and the ledger's
    counts of the good ones, by snapshot and service, and each of the others (``_bad``),
    with how many there are of it. What is kept of a batch is then as large as its groups
    and its bad records, not as its feed."""
    bad = F.struct(*quarantined(parsed).columns)
    places = [name for name in ("topic", "partition") if name in parsed.columns]
    marked = parsed.withColumn(_BAD, F.when(F.col("reason").isNotNull(), bad))
    # A bad record's own fields are in no group: they may be anything.
    group = [F.when(F.col(_BAD).isNull(), F.col(f)).alias(f) for f in ("pubTime", "services_name")]
    own = [c for c in marked.columns if c not in ("pubTime", "services_name")]
    marked = marked.select(*own, *group)
    return service_measures(marked, _BAD, *places, "pubTime", extra=offsets_read(parsed))


def _set_aside(reduced: DataFrame) -> DataFrame:
    """The bad records, each as often as it was read."""
    bad = reduced.where(F.col(_BAD).isNotNull())
    return bad.select(F.explode(F.sequence(F.lit(1), "calls")), f"{_BAD}.*").drop("col")


_REPAIR = "_repair"


def _first_of_each(repairs: DataFrame) -> DataFrame:
    """One of the good repairs of each offset: that of the least bytes."""
    row = F.struct(*repairs.columns).alias("row")
    least = repairs.groupBy(*PLACE).agg(F.min_by(row, "value").alias("row"))
    return least.select("row.*")


def _usable(repairs: DataFrame, ledger: Ledger, batch_id: int) -> DataFrame:
    """Parsed lines of the repairs that count: good ones of records that are set aside
    and not yet repaired. The others are left before anything of them is decoded."""
    due = repairs.join(ledger.outstanding(without=batch_id), list(PLACE), "left_semi")
    return _first_of_each(parse_lines(decode_records(due)).where("reason is null").drop("tracing"))


def publish_figures(
    records: DataFrame,
    publish: BatchWriter,
    quarantine: BatchWriter,
    folder: str,
    tenant: str,
    publishers: Mapping[str, str] | None = None,
    keys: Collection[str] = tuple(KPI_KEYS),
    per: str = "pubTime",
    interval: str = BATCH_INTERVAL,
    available_now: bool = False,
    compact_every: int = COMPACT_EVERY,
    repairs: DataFrame | None = None,
) -> StreamingQuery:
    """Start the job from enveloped records to enveloped figures.

    A batch's measures are stored, and for each snapshot it touched the figures
    of the whole snapshot are published, merged from all that is stored of it. A
    snapshot cut by a batch border is therefore published again, complete, and a
    late record corrects a figure instead of making one of its own. ``per="batch"``
    publishes one set of messages for the batch alone, stamped with its last pubTime.

    ``keys`` are the message keys to publish. Records that cannot be read go to
    ``quarantine`` with their bytes, metadata and reason; none is dropped. The
    batch is read once; its measures and bad records are kept until both are written, so
    bound it at the source (``maxOffsetsPerTrigger``, ``maxBytesPerTrigger``). The offsets of its records are
    written to the ledger last.

    ``repairs`` is a stream of records that were set aside and have been put right, under
    their own topic, partition and offset. Each corrects the figures of its snapshot, once:
    repairs of a record that was good, is repaired already or was never read change
    nothing, as do those that still cannot be read, and a repair sent before its record is
    lost. Of several good ones in a batch that of the least bytes counts. Both streams
    need Kafka's metadata, and a checkpoint that was begun with ``repairs`` keeps them.
    Only what is set aside by such a job can be repaired.
    """
    unknown = set(keys) - set(KPI_KEYS)
    if unknown or per not in ("pubTime", "batch"):
        raise ValueError(f"no such key or period: {sorted(unknown) or per}")
    store, ledger = (kind(records.sparkSession, folder) for kind in (MeasureStore, Ledger))
    first = ledger.begin()
    kept = [c for c in ("key", "value", *RECORD_METADATA) if c in records.columns]
    records = watched(records)
    if repairs is not None:
        fixed = repairs.select(*kept, F.lit(True).alias(_REPAIR))
        records = records.select(*kept, F.lit(False).alias(_REPAIR)).unionByName(fixed)

    def run(batch: DataFrame, batch_id: int) -> None:
        batch_id += first
        fresh = batch if repairs is None else batch.where(~F.col(_REPAIR))
        reduced = _reduced(parse_lines(decode_records(fresh.select(*kept)))).persist()
        held = [reduced]
        try:
            bad = _set_aside(reduced)
            quarantine(bad, batch_id)
            measures = reduced.where(F.col(_BAD).isNull()).select("pubTime", "services_name", *MEASURES)
            if repairs is not None:
                ledger.write_set_aside(bad, batch_id)
                fixed = batch.where(_REPAIR).select(*kept)
                if not fixed.isEmpty():
                    usable = _usable(fixed, ledger, batch_id).persist()
                    held.append(usable)
                    ledger.write_repaired(usable, batch_id)
                    measures = measures.unionByName(service_measures(observations(usable)))
            measures = measures.groupBy("pubTime", "services_name").agg(*merged_measures()).persist()
            held.append(measures)
            store.write(measures, batch_id)
            if not measures.isEmpty():
                if per == "pubTime":
                    messages = all_messages(_whole_snapshots(measures, store))
                else:
                    messages = batch_messages(measures)
                wanted = messages.where(F.col("key").isin(list(keys)))
                publish(frames(wanted, tenant, publishers), batch_id)
            ledger.write(reduced, batch_id)
            if batch_id % compact_every == compact_every - 1:
                store.compact(through=batch_id - 1)
                ledger.compact(through=batch_id - 1)
        finally:
            for table in reversed(held):
                table.unpersist()

    return _started(records.writeStream.foreachBatch(run), folder, interval, available_now)


def store_measures(
    calls: DataFrame,
    folder: str,
    interval: str = BATCH_INTERVAL,
    available_now: bool = False,
    then: Callable[[int], None] | None = None,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Start the job that stores each batch's measures.

    A snapshot may be cut by a batch border; measures of its parts add up,
    averages would not. ``kpis.figures_of`` gives the figures of the store.
    ``then`` is called with the batch's number once it is stored.
    """
    store = MeasureStore(calls.sparkSession, folder)

    def run(batch: DataFrame, batch_id: int) -> None:
        store.write(service_measures(batch), batch_id)
        if then:
            then(batch_id)
        if batch_id % compact_every == compact_every - 1:
            store.compact(through=batch_id - 1)

    return _started(calls.writeStream.foreachBatch(run), folder, interval, available_now)


def windowed_figures(measures: DataFrame, window: str) -> DataFrame:
    """The figures at the end of each event-time window, from stored measures.

    A call is observed in every snapshot of its life, so adding up snapshots would
    count it many times: a window has the figures of its last snapshot. All stored
    measures count, however late they came and whatever their batches were, and
    every window is there, the last one as well.
    """
    snapshots = measures.groupBy("pubTime").agg(*merged_measures())
    last = (
        snapshots.groupBy(F.window("pubTime", window).alias("window"))
        .agg(F.max(F.struct("pubTime", *MEASURES)).alias("last"))
        .select("window", "last.*")
    )
    return last.select(
        F.col("window.start").alias("windowStart"),
        F.col("window.end").alias("windowEnd"),
        "pubTime",
        *[column.alias(name) for name, column in figures().items()],
    )


def append_to_files(
    rows: DataFrame,
    folder: str,
    interval: str = BATCH_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the job that appends streamed rows to the Parquet table ``folder/table``,
    each once."""
    writer = rows.writeStream.format("parquet").option("path", f"{folder}/table")
    return _started(writer.outputMode("append"), folder, interval, available_now)

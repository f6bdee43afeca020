"""Keyed state: whole snapshots, and windows that close, in Spark's state store.

Both jobs add up the measures of calls beside the source, per Arrow batch, so that a
snapshot of any number of calls sends a few rows. Spark keeps the sums by key in RocksDB
and brings a batch's rows to their key's state: a batch reads the state of the keys it
has, whatever the age of the job. State ends by event time. Spark's watermark is the
largest pubTime of earlier batches less the delay, and a timer of each key goes off
when the watermark passes it.

A row whose key has ended already is late. It cannot join what was published, so it is
given out by itself, marked, and counted: on time and late rows are all rows.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Collection, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from callpulse.operators.frames import frames
from callpulse.operators.kpis import MEASURES, call_measures, figures
from callpulse.operators.messages import all_messages
from callpulse.schema import KPI_KEYS
from callpulse.sources.files import names_in
from callpulse.streaming.jobs import BATCH_INTERVAL, BatchWriter, _started

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SNAPSHOT = Row("at", "services_name", "late", *MEASURES)
_WINDOW = Row("start", "end", "late", "observations", "at", *MEASURES)
_LONGS = ", ".join(f"{name} bigint" for name in MEASURES)


@contextlib.contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """For a query that starts inside; it keeps the setting it started with."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def partial_measures(calls: DataFrame, *by: str, delay: str) -> DataFrame:
    """Measures of a stream's calls by ``at``, which is pubTime in microseconds, and the
    given columns, added up within each Arrow batch. The watermark is on pubTime."""
    at = F.unix_micros("pubTime").alias("at")
    rows = calls.withWatermark("pubTime", delay).select(at, *by, *call_measures())
    keys = ["at", *by]

    def add_up(batches):
        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by(keys)
            summed = sums.aggregate([(name, "sum") for name in MEASURES])
            summed = summed.rename_columns([c.removesuffix("_sum") for c in summed.column_names])
            yield from summed.select(batch.schema.names).cast(batch.schema).to_batches()

    # The schema as text: Spark shall not see the event time any more and drop late rows.
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(add_up, schema)


class _Snapshot(StatefulProcessor):
    """The measures of one snapshot, by service, until the watermark passes it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._services = handle.getMapState("services", "services_name string", _LONGS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        (at,) = key
        ends = at // 1000
        late = timerValues.getCurrentWatermarkInMs() >= ends
        services = {} if late else {name: list(sums) for (name,), sums in self._services.iterator()}
        if not late and not services:
            self._handle.registerTimer(ends)
        touched = set()
        for row in rows:
            sums = services.setdefault(row.services_name, [0] * len(MEASURES))
            for place, name in enumerate(MEASURES):
                sums[place] += row[name]
            touched.add(row.services_name)
        for name in () if late else touched:
            self._services.updateValue((name,), tuple(services[name]))
        for name, sums in services.items():
            yield _SNAPSHOT(at, name, late, *sums)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._services.clear()
        return iter(())

    def close(self) -> None:
        pass


def snapshots(calls: DataFrame, retention: str) -> DataFrame:
    """Of every batch of a stream, the snapshots it has touched, whole: pubTime,
    services_name, late and the measures.

    A snapshot is held until pubTime is ``retention`` behind the last one seen. Rows
    that come later are ``late`` and are given out as they are, added up.
    """
    keyed = partial_measures(calls, "services_name", delay=retention).groupBy("at")
    schema = f"at bigint, services_name string, late boolean, {_LONGS}"
    whole = keyed.transformWithState(_Snapshot(), schema, "Update", "EventTime")
    return whole.select(F.timestamp_micros("at").alias("pubTime"), "services_name", "late", *MEASURES)


def publish_snapshots(
    calls: DataFrame,
    publish: BatchWriter,
    late: BatchWriter,
    folder: str,
    tenant: str,
    publishers: Mapping[str, str] | None = None,
    keys: Collection[str] = tuple(KPI_KEYS),
    retention: str = "1 day",
    interval: str = BATCH_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the job that publishes the figures of each snapshot a batch has touched,
    complete, from keyed state. Measures of late rows go to ``late``."""
    spark = calls.sparkSession

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            late(batch.where("late").drop("late"), batch_id)
            messages = all_messages(batch.where("not late").drop("late"))
            publish(frames(messages.where(F.col("key").isin(list(keys))), tenant, publishers), batch_id)
        finally:
            batch.unpersist()

    with _rocksdb(spark):
        writer = snapshots(calls, retention).writeStream.outputMode("update").foreachBatch(run)
        return _started(writer, folder, interval, available_now)


class _Window(StatefulProcessor):
    """A window's last snapshot and the calls it has observed, until it closes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._held = handle.getValueState("window", f"observations bigint, at bigint, {_LONGS}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        start, end = key
        closes = end // 1000
        if timerValues.getCurrentWatermarkInMs() >= closes:
            for row in rows:
                yield _WINDOW(start, end, True, row.calls, row.at, *(row[m] for m in MEASURES))
            return
        held = self._held.get() if self._held.exists() else None
        observations, last, *sums = held or (0, None, *[0] * len(MEASURES))
        if held is None:
            self._handle.registerTimer(closes)
        for row in rows:
            observations += row.calls
            if last is None or row.at > last:
                last, sums = row.at, [row[m] for m in MEASURES]
            elif row.at == last:
                sums = [s + row[m] for s, m in zip(sums, MEASURES)]
        self._held.update((observations, last, *sums))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self._held.get()
        self._held.clear()
        yield _WINDOW(*key, False, *held)

    def close(self) -> None:
        pass


_AS_TIMES = {"start": "windowStart", "end": "windowEnd", "at": "pubTime"}


def _with_times(rows: DataFrame, *columns: str) -> DataFrame:
    times = [F.timestamp_micros(name).alias(new) for name, new in _AS_TIMES.items()]
    return rows.select(*times, *columns, *MEASURES)


def closed_windows(calls: DataFrame, window: str, delay: str) -> DataFrame:
    """Event-time windows of a stream, each once, when the watermark passes its end:
    windowStart, windowEnd, late, observations, pubTime and its measures.

    A call is observed in every snapshot of its life, so adding up snapshots would
    count it many times: a window has the measures of its last snapshot, and the number
    of all its observations. Rows of a window that has closed are ``late`` and are given
    out by themselves.
    """
    own = F.window(F.timestamp_micros("at"), window)
    keyed = partial_measures(calls, delay=delay).withColumn("own", own).select(
        *[F.unix_micros(f"own.{edge}").alias(edge) for edge in ("start", "end")], "at", *MEASURES
    )
    schema = f"start bigint, end bigint, late boolean, observations bigint, at bigint, {_LONGS}"
    found = keyed.groupBy("start", "end").transformWithState(_Window(), schema, "Append", "EventTime")
    return _with_times(found, "late", "observations")


def publish_windows(
    calls: DataFrame,
    publish: BatchWriter,
    late: BatchWriter,
    folder: str,
    window: str,
    delay: str,
    interval: str = BATCH_INTERVAL,
    available_now: bool = False,
    then: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Start the job that publishes the figures of each window when it closes, and gives
    rows that come after that to ``late``."""
    spark = calls.sparkSession
    bounds = ["windowStart", "windowEnd", "pubTime", "observations"]

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            late(batch.where("late").select(*bounds, *MEASURES), batch_id)
            closed = batch.where("not late")
            publish(closed.select(*bounds, *[c.alias(n) for n, c in figures().items()]), batch_id)
            if then:
                then(batch_id)
        finally:
            batch.unpersist()

    with _rocksdb(spark):
        writer = closed_windows(calls, window, delay).writeStream.outputMode("append").foreachBatch(run)
        return _started(writer, folder, interval, available_now)


def open_windows(spark: SparkSession, folder: str) -> DataFrame:
    """The windows that the job in ``folder`` still holds: the table of its state. A job
    that has had no batch holds none."""
    if not names_in(spark, f"{folder}/checkpoint/state"):
        none = "start bigint, end bigint, at bigint, observations bigint"
        return _with_times(spark.createDataFrame([], f"{none}, {_LONGS}"), "observations")
    state = (
        spark.read.format("statestore")
        .option("path", f"{folder}/checkpoint")
        .option("stateVarName", "window")
        .load()
    )
    held = state.select("key.start", "key.end", "value.at", "value.observations", *(f"value.{m}" for m in MEASURES))
    return _with_times(held, "observations")

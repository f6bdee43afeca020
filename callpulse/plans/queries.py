"""Every operator as a named query over the calls of a table folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callpulse.functions.envelope import length_delimited, text_field
from callpulse.operators import filters, kpis, messages, records
from callpulse.operators.frames import envelope, frames
from callpulse.operators.once import evaluate_once
from callpulse.schema import (
    AVERAGE_HANDLING_TIME,
    CALL_SCHEMA,
    MESSAGE_SCHEMAS,
    QUEUERS_AND_CALLERS,
    QUEUERS_PER_SERVICE,
    WAIT_TIME,
)
from callpulse.session import shared_folder
from callpulse.sources.files import (
    make_folder,
    move,
    parquet_sender,
    parquet_sink,
    read_parts,
    remove,
    stream_files,
    utc_day,
)
from callpulse.plans.fixtures import (
    TENANT,
    call_lines,
    call_records,
    calls_from_events,
    damaged_lines,
    damaged_records,
)
from callpulse.streaming import feed as feeds
from callpulse.streaming import jobs, state
from callpulse.streaming.ledger import Ledger
from callpulse.streaming.outbox import HEADERS, Outbox, message_id

Query = Callable[[SparkSession, str], DataFrame]

WINDOW = "15 minutes"

# The table's files are the deliveries of the feed, one batch each.
DELIVERIES = {"maxFilesPerTrigger": "1"}

QUERIES: dict[str, Query] = {}


def _named(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _events_path(folder: str) -> str:
    return f"{folder}/events.parquet"


def calls(spark: SparkSession, folder: str) -> DataFrame:
    return calls_from_events(spark.read.parquet(_events_path(folder)))


#: Events of one task where calls are made of them to be delivered: some four records each.
DEALT = 50_000


def _dealt_calls(spark: SparkSession, folder: str) -> DataFrame:
    """The calls, made by many tasks: an event grows to some hundred times its size in the
    table, of which a split may hold very many."""
    events = spark.read.parquet(_events_path(folder))
    tasks = max(spark.sparkContext.defaultParallelism, -(-events.count() // DEALT))
    return calls_from_events(events.repartition(tasks))


def _streamed_calls(spark: SparkSession, folder: str) -> DataFrame:
    path = _events_path(folder)
    schema = spark.read.parquet(path).schema
    return calls_from_events(stream_files(spark, path, schema, **DELIVERIES))


# Parsing


@_named
def call_observations(spark: SparkSession, folder: str) -> DataFrame:
    lines = damaged_lines(calls(spark, folder))
    return records.observations(records.parse_lines(lines))


@_named
def quarantined_lines(spark: SparkSession, folder: str) -> DataFrame:
    return records.quarantined(
        records.parse_lines(damaged_lines(calls(spark, folder)))
    )


@_named
def call_records_with_metadata(spark: SparkSession, folder: str) -> DataFrame:
    decoded = records.decode_record_keys(
        records.decode_records(call_records(calls(spark, folder)))
    )
    return decoded.select(
        "topic", "partition", "offset", "timestamp", "key", "tenant", "publisher", "line"
    )


# Envelopes


@_named
def envelope_key_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    keyed = calls(spark, folder).select(
        "pubTime",
        "area",
        "services_name",
        "ind_forward_service_previous",
        F.col("caseId").alias("key"),
        F.lit("").alias("value"),
    )
    encoded = envelope(
        keyed,
        tenant=F.col("area"),
        publisher=F.col("services_name"),
        retained=F.col("ind_forward_service_previous") == "1",
        qos=F.when(F.col("area") == "error", "RELIABLE").otherwise("BEST_EFFORT"),
    )
    return records.decode_keys(encoded.select("pubTime", "key")).select(
        "pubTime",
        F.col("key.key").alias("caseId"),
        F.col("key.header.identifier.tenant").alias("tenant"),
        F.col("key.header.identifier.publisher").alias("publisher"),
        F.col("key.header.retained").alias("retained"),
        F.col("key.header.qos").alias("qos"),
    )


@_named
def envelope_data_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Records of abandoned calls also carry tracing, so both decoders are used."""
    lines = call_lines(calls(spark, folder), "pubTime", "caseId", "area")
    encoded = envelope(
        lines.select(
            "pubTime", "area", F.col("caseId").alias("key"), F.col("line").alias("value")
        ),
        tenant=F.lit(TENANT),
        publisher=F.lit("call-log"),
    )
    entry = f"concat({text_field(1, 'name')}, {text_field(2, 'area')})"
    traced = evaluate_once(
        encoded.withColumn("name", F.lit("area")), entry=F.expr(entry)
    ).select(
        "pubTime",
        F.expr(
            f"""CASE WHEN area = 'error' THEN concat(value, {length_delimited(2, 'entry')})
                     ELSE value END"""
        ).alias("value"),
    )
    return records.decode_records(traced).select(
        "pubTime", "line", F.try_element_at("tracing", F.lit("area")).alias("traced_area")
    )


@_named
def kpi_frames(spark: SparkSession, folder: str) -> DataFrame:
    all_messages = messages.all_messages(kpis.service_measures(calls(spark, folder)))
    return frames(all_messages, TENANT).select(
        F.hex("key").alias("key_hex"), F.hex("value").alias("value_hex")
    )


@_named
def publisher_identity(spark: SparkSession, folder: str) -> DataFrame:
    all_messages = messages.all_messages(kpis.service_measures(calls(spark, folder)))
    decoded = records.decode_record_keys(frames(all_messages, TENANT))
    return decoded.groupBy("tenant", "publisher", "key").agg(
        F.count("*").alias("frames")
    )


# Filters


@_named
def handled_calls(spark: SparkSession, folder: str) -> DataFrame:
    return filters.handled_calls(calls(spark, folder)).select(
        "pubTime", "caseId", "handlingMs"
    )


@_named
def waiting_calls(spark: SparkSession, folder: str) -> DataFrame:
    return filters.waiting_calls(calls(spark, folder)).select(
        "pubTime", "caseId", "dt_start"
    )


@_named
def served_calls(spark: SparkSession, folder: str) -> DataFrame:
    return filters.served_calls(calls(spark, folder)).select(
        "pubTime", "caseId", "queueMs"
    )


@_named
def calls_in_service_queue(spark: SparkSession, folder: str) -> DataFrame:
    return filters.calls_in_service_queue(calls(spark, folder)).select(
        "pubTime", "caseId", "services_name"
    )


# Figures


@_named
def kpi_average_handling_time(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.average_handling_time(calls(spark, folder))


@_named
def kpi_queuers_and_callers(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.queuers_and_callers(calls(spark, folder))


@_named
def kpi_wait_time(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.wait_time(calls(spark, folder))


@_named
def kpi_queuers_per_service(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.queuers_per_service(calls(spark, folder))


@_named
def kpi_combined(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.combined(kpis.service_measures(calls(spark, folder)))


@_named
def kpi_per_batch_total(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.batch_totals(calls(spark, folder))


@_named
def kpi_empty_input(spark: SparkSession, folder: str) -> DataFrame:
    """A batch none of whose calls is in scope publishes no figure."""
    out_of_scope = calls(spark, folder).where(F.col("dt_end") < F.col("dt_offered"))
    return kpis.batch_totals(out_of_scope)


# Messages


def _parsed_back(message: DataFrame, key: str) -> DataFrame:
    parsed = F.from_json("value", f"array<struct<{_struct_fields(key)}>>")
    return message.select("key", F.inline(parsed))


def _struct_fields(key: str) -> str:
    fields = (field.split() for field in MESSAGE_SCHEMAS[key].split(", "))
    return ", ".join(f"{name}: {kind}" for name, kind in fields)


@_named
def message_average_handling_time(spark: SparkSession, folder: str) -> DataFrame:
    kpi = kpis.average_handling_time(calls(spark, folder))
    return _parsed_back(
        messages.average_handling_time_message(kpi), AVERAGE_HANDLING_TIME
    )


@_named
def message_queuers_and_callers(spark: SparkSession, folder: str) -> DataFrame:
    kpi = kpis.queuers_and_callers(calls(spark, folder))
    return _parsed_back(messages.queuers_and_callers_message(kpi), QUEUERS_AND_CALLERS)


@_named
def message_wait_time(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed_back(
        messages.wait_time_message(kpis.wait_time(calls(spark, folder))), WAIT_TIME
    )


@_named
def message_queuers_per_service(spark: SparkSession, folder: str) -> DataFrame:
    """The message text itself: it holds no fraction, so engines agree on it."""
    return messages.queuers_per_service_message(
        kpis.service_measures(calls(spark, folder))
    )


# Streams. Each runs until its input is used up and returns the written table.


@_named
def stream_call_observations(spark: SparkSession, folder: str) -> DataFrame:
    out = shared_folder(spark, "call-observations")
    feed = call_records(_streamed_calls(spark, folder))
    jobs.append_to_files(
        records.call_observations(feed), out, available_now=True
    ).awaitTermination()
    return read_parts(spark, f"{out}/table", CALL_SCHEMA)


@_named
def stream_kpi_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    out = shared_folder(spark, "kpi-per-batch")
    jobs.store_measures(
        _streamed_calls(spark, folder), out, available_now=True
    ).awaitTermination()
    return kpis.figures_of(jobs.stored_measures(spark, out))


@_named
def stream_kpi_windowed(spark: SparkSession, folder: str) -> DataFrame:
    out = shared_folder(spark, "kpi-windowed")
    jobs.store_measures(
        _streamed_calls(spark, folder), out, available_now=True
    ).awaitTermination()
    return jobs.windowed_figures(jobs.stored_measures(spark, out), WINDOW)


class _StoppedAfterStoring(Exception):
    pass


@_named
def stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    """The job dies once a batch is stored and before it is done; started again on
    the same folder it repeats that batch, and each batch is stored once."""
    out = shared_folder(spark, "restart")

    def stop(batch_id: int) -> None:
        raise _StoppedAfterStoring(batch_id)

    first = jobs.store_measures(
        _streamed_calls(spark, folder), out, available_now=True, then=stop
    )
    try:
        first.awaitTermination()
    except StreamingQueryException as stopped:
        if _StoppedAfterStoring.__name__ not in str(stopped):
            raise
    jobs.store_measures(
        _streamed_calls(spark, folder), out, available_now=True
    ).awaitTermination()
    return kpis.figures_of(jobs.stored_measures(spark, out))


# The jobs on a feed that comes in several deliveries. After each the job is started on
# its folder again and reads what is new, as one batch unless that is very much.

DELIVERED = 3
FRAMES = "key binary, value binary, batch_id bigint"


def _by_case() -> Column:
    """Deliveries that each hold a part of every snapshot."""
    return F.pmod(F.xxhash64("dt_offered"), F.lit(DELIVERED)).cast("int")


def _deliver(
    spark: SparkSession, feed: DataFrame, delivery: Column, out: str, start: Callable[[DataFrame], object], **options: str
) -> None:
    """Writes the feed once, by delivery, and moves one delivery after the other to the
    folder that the job streams."""
    feed.withColumn("delivery", delivery).write.partitionBy("delivery").parquet(f"{out}/feed")
    make_folder(spark, f"{out}/topic")
    for number in range(DELIVERED):
        move(spark, f"{out}/feed/delivery={number}", f"{out}/topic/{number}")
        stream = stream_files(spark, f"{out}/topic", feed.schema, recursiveFileLookup="true", **options)
        start(stream).awaitTermination()


def _fields_of(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _publish(spark: SparkSession, feed: DataFrame, out: str) -> None:
    def start(records: DataFrame):
        return jobs.publish_figures(
            records,
            publish=parquet_sink(f"{out}/published"),
            quarantine=parquet_sink(f"{out}/quarantine"),
            folder=out,
            tenant=TENANT,
            available_now=True,
        )

    delivery = F.pmod(F.xxhash64("key"), F.lit(DELIVERED)).cast("int")
    _deliver(spark, feed, delivery, out, start, maxBytesPerTrigger=str(8 << 30))


def _stamped(published: DataFrame) -> DataFrame:
    """``key, batch_id, line, pubTime`` of the written frames. An empty list of services
    names no snapshot and is left out."""
    decoded = records.decode_record_keys(records.decode_records(published))
    return decoded.select(
        "key", "batch_id", "line", F.get_json_object("line", "$[0].pubTime").cast("bigint").alias("pubTime")
    ).where(F.col("pubTime").isNotNull())


def _last_messages(published: DataFrame) -> DataFrame:
    """The last message of each key and snapshot, decoded from the written frames."""
    last = _stamped(published).groupBy("key", "pubTime")
    return _message_fields(last.agg(F.max_by("line", "batch_id").alias("line")))


def _message_fields(lines: DataFrame, *keep: str) -> DataFrame:
    """The fields of each message (the services of one snapshot stay one list)."""

    def field(name: str, kind: str):
        return F.get_json_object("line", f"$[0].{name}").cast(kind).alias(name)

    services = F.when(F.col("key") == QUEUERS_PER_SERVICE, F.col("line"))
    return lines.select(
        "key",
        "pubTime",
        *keep,
        field("avgCallDuration", "double"),
        field("queueSize", "bigint"),
        field("callsAmt", "bigint"),
        field("ratioServed", "double"),
        field("queueDuration", "double"),
        services.alias("services"),
    )


@_named
def stream_publish_figures(spark: SparkSession, folder: str) -> DataFrame:
    """The last message of each key and snapshot, by the job that stores measures."""
    out = shared_folder(spark, "publish-figures")
    _publish(spark, call_records(_dealt_calls(spark, folder)), out)
    return _last_messages(read_parts(spark, f"{out}/published", FRAMES))


@_named
def stream_snapshot_state(spark: SparkSession, folder: str) -> DataFrame:
    """The last message of each key and snapshot, by the job that keeps snapshots in
    keyed state; they are held for longer than the feed lasts."""
    out = shared_folder(spark, "snapshot-state")

    def start(feed: DataFrame):
        return state.publish_snapshots(
            feed,
            publish=parquet_sink(f"{out}/published"),
            late=parquet_sink(f"{out}/late"),
            folder=out,
            tenant=TENANT,
            retention="10000 days",
            available_now=True,
        )

    _deliver(spark, _dealt_calls(spark, folder), _by_case(), out, start)
    return _last_messages(read_parts(spark, f"{out}/published", FRAMES))


class _StoppedWhileSending(Exception):
    pass


@_named
def stream_outbox(spark: SparkSession, folder: str) -> DataFrame:
    """Every version of every message as the receiver has it, and how often: the job dies
    with half of the first batch sent, and with the second sent and not confirmed."""
    out = shared_folder(spark, "outbox")
    append = parquet_sender(f"{out}/received")
    received = f"key binary, value binary, headers {HEADERS}"
    feed = call_records(_dealt_calls(spark, folder))
    runs = iter(range(DELIVERED))

    def half(rows: DataFrame) -> None:
        append(rows.where(F.crc32("value") % 2 == 0))
        raise _StoppedWhileSending

    def whole(rows: DataFrame) -> None:
        append(rows)
        raise _StoppedWhileSending

    def start(stream: DataFrame):
        def run(send: Callable[[DataFrame], None]):
            outbox = Outbox(
                spark, out, send, lambda version: read_parts(spark, f"{out}/received", received)
            )
            return jobs.publish_figures(
                stream,
                publish=outbox,
                quarantine=parquet_sink(f"{out}/quarantine"),
                folder=out,
                tenant=TENANT,
                available_now=True,
            )

        stopping = {0: half, 1: whole}.get(next(runs))
        if stopping:
            try:
                run(stopping).awaitTermination()
            except StreamingQueryException as stopped:
                if _StoppedWhileSending.__name__ not in str(stopped):
                    raise
        return run(append)

    _deliver(spark, feed, F.pmod("offset", F.lit(DELIVERED)).cast("int"), out, start)
    version = F.split_part(message_id(), F.lit(":"), F.lit(1)).cast("bigint")
    sent = read_parts(spark, f"{out}/received", received).withColumn("batch_id", version)
    versions = _stamped(sent).groupBy("key", "pubTime", F.col("batch_id").alias("version"))
    counted = versions.agg(F.min("line").alias("line"), F.count("*").alias("sent"))
    return _message_fields(counted, "version", "sent")


@_named
def stream_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Figures of the damaged records once they have been put right: after the deliveries
    the whole feed without damage is sent as repairs, twice. Only what was set aside is
    used of it, and the second time nothing."""
    out = shared_folder(spark, "replay")
    all_calls = _dealt_calls(spark, folder)
    good = call_records(all_calls)
    make_folder(spark, f"{out}/repairs")

    def start(feed: DataFrame):
        return jobs.publish_figures(
            feed,
            publish=parquet_sink(f"{out}/published"),
            quarantine=parquet_sink(f"{out}/quarantine"),
            folder=out,
            tenant=TENANT,
            available_now=True,
            repairs=stream_files(spark, f"{out}/repairs", good.schema, recursiveFileLookup="true"),
        )

    delivery = F.pmod("offset", F.lit(DELIVERED)).cast("int")
    _deliver(spark, damaged_records(all_calls), delivery, out, start)
    topic = stream_files(spark, f"{out}/topic", good.schema, recursiveFileLookup="true")
    for time in range(2):
        good.write.parquet(f"{out}/repairs/{time}")
        start(topic).awaitTermination()
    return kpis.figures_of(jobs.stored_measures(spark, out))


def _changes(
    spark: SparkSession, folder: str, purpose: str, delivery: Callable[[DataFrame], Column]
) -> str:
    """The folder in which the job of changes has written both its feeds."""
    out = shared_folder(spark, purpose)

    def start(feed: DataFrame):
        return feeds.publish_changes(
            feed,
            changes=parquet_sink(f"{out}/changes"),
            current=parquet_sink(f"{out}/current"),
            folder=out,
            available_now=True,
            compact_every=2,
        )

    all_calls = _dealt_calls(spark, folder)
    _deliver(spark, all_calls, delivery(all_calls), out, start)
    return out


@_named
def stream_kpi_combined(spark: SparkSession, folder: str) -> DataFrame:
    """All figures as the changes make them; every delivery has a part of each snapshot."""
    out = _changes(spark, folder, "kpi-combined", lambda calls: _by_case())
    made = read_parts(spark, f"{out}/changes", feeds.CHANGES)
    return feeds.apply_changes(made, *feeds.CHANGE_KEYS).select(
        "pubTime", "kpi", "dimension", "value"
    )


@_named
def stream_kpi_current(spark: SparkSession, folder: str) -> DataFrame:
    """The figures of the last snapshot as the changes make them. The first third of the
    days comes first, then the last third, and what lies between comes late."""

    def third(calls: DataFrame) -> Column:
        first, last = calls.agg(F.min(utc_day("pubTime")), F.max(utc_day("pubTime"))).first()
        span = F.lit(last) - F.lit(first) + 1
        place = F.floor((utc_day("pubTime") - F.lit(first)) * DELIVERED / span)
        return F.pmod(place * 2, F.lit(DELIVERED)).cast("int")

    out = _changes(spark, folder, "kpi-current", third)
    made = read_parts(spark, f"{out}/current", feeds.CHANGES)
    return feeds.apply_changes(made, *feeds.CURRENT_KEYS).select(
        "pubTime", "kpi", "dimension", "value"
    )


LATENESS = "1 hour"


@_named
def stream_windows_live(spark: SparkSession, folder: str) -> DataFrame:
    """Every window as the live job has it, and every late row: the even days come
    first, then the odd ones, most of them too late. ``observations`` are all there are."""
    out = shared_folder(spark, "windows-live")

    def start(feed: DataFrame):
        return state.publish_windows(
            feed,
            publish=parquet_sink(f"{out}/closed"),
            late=parquet_sink(f"{out}/late"),
            folder=out,
            window=WINDOW,
            delay=LATENESS,
            available_now=True,
        )

    _deliver(spark, _dealt_calls(spark, folder), F.pmod(utc_day("pubTime"), F.lit(2)), out, start)
    bounds = "windowStart timestamp, windowEnd timestamp, pubTime timestamp, observations bigint"
    figures = "avgCallDuration double, queueSize bigint, callsAmt bigint, ratioServed double, queueDuration double"
    names = [f.split()[0] for f in f"{bounds}, {figures}".split(", ")]
    closed = read_parts(spark, f"{out}/closed", f"{bounds}, {figures}")
    late = read_parts(spark, f"{out}/late", bounds)
    open_now = state.open_windows(spark, out).select(
        *names[:4], *[c.alias(n) for n, c in kpis.figures().items()]
    )
    # Several tasks and batches may have had late rows of one window.
    late = late.groupBy("windowStart", "windowEnd").agg(
        F.max("pubTime").alias("pubTime"), F.sum("observations").alias("observations")
    )
    parts = {"closed": closed, "open": open_now, "late": late}
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [rows.select(F.lit(kind).alias("kind"), *rows.columns) for kind, rows in parts.items()],
    ).select("kind", *names)


@_named
def stream_store_compaction(spark: SparkSession, folder: str) -> DataFrame:
    """Figures of a store of which the first batches are closed and the last is not; the
    job closes parts after every second batch."""
    out = shared_folder(spark, "store-compaction")

    def start(feed: DataFrame):
        return jobs.store_measures(feed, out, available_now=True, compact_every=2)

    _deliver(spark, _dealt_calls(spark, folder), _by_case(), out, start)
    return kpis.figures_of(jobs.stored_measures(spark, out))


@_named
def stream_lost_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    """Figures of a job whose checkpoint is lost after the first delivery: the next run
    goes on after the offsets of its ledger, and each record is used once."""
    out = shared_folder(spark, "lost-checkpoint")
    feed = call_records(_dealt_calls(spark, folder))
    first, last = feed.agg(F.min("timestamp"), F.max("timestamp")).first()
    started = []

    def start(records: DataFrame):
        if len(started) == 1:
            remove(spark, f"{out}/checkpoint")
        started.append(records)
        return jobs.publish_figures(
            Ledger(spark, out).unread(records),  # a new checkpoint begins with the first file
            publish=parquet_sink(f"{out}/published"),
            quarantine=parquet_sink(f"{out}/quarantine"),
            folder=out,
            tenant=TENANT,
            available_now=True,
        )

    span = F.unix_micros(F.lit(last)) - F.unix_micros(F.lit(first)) + 1
    third = (F.unix_micros("timestamp") - F.unix_micros(F.lit(first))) * DELIVERED / span
    _deliver(spark, feed, F.floor(third).cast("int"), out, start)
    return kpis.figures_of(jobs.stored_measures(spark, out))


@_named
def stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Records of every kind of damage, as the job sets them aside: the bytes as they
    came, where they were read, and why."""
    out = shared_folder(spark, "quarantine")
    feed = damaged_records(_dealt_calls(spark, folder))
    _publish(spark, feed, out)
    return read_parts(spark, f"{out}/quarantine", f"{_fields_of(feed)}, reason string").select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.hex("key").alias("key_hex"),
        F.hex("value").alias("value_hex"),
        "reason",
    )


@_named
def stream_accounting(spark: SparkSession, folder: str) -> DataFrame:
    """Of the same damaged records: how many were read, used and set aside, as the job has
    counted them while it read them. No records give counts of 0."""
    out = shared_folder(spark, "accounting")
    _publish(spark, damaged_records(_dealt_calls(spark, folder)), out)
    return Ledger(spark, out).counts().unpivot([], ["read", "used", "set_aside"], "records", "n")

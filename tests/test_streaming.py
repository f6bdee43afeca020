import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from callpulse.functions.envelope import _message_classes
from callpulse.operators import kpis, messages
from callpulse.operators.records import decode_records
from callpulse.sources.files import parquet_sink, stream_files
from callpulse.plans.fixtures import call_records, calls_from_events
from callpulse.streaming import jobs
from conftest import SMALL

FILES = 4


@pytest.fixture(scope="module")
def calls(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("calls"))
    calls_from_events(spark.read.parquet(f"{SMALL}/events.parquet")).write.mode(
        "overwrite"
    ).parquet(path)
    return spark.read.parquet(path)


def in_time_order(df, path, column):
    """Writes ``df`` as files whose modification times follow ``column``."""
    df.repartitionByRange(FILES, column).write.parquet(path)
    names = sorted(n for n in os.listdir(path) if n.endswith(".parquet"))
    for age, name in enumerate(names):
        stamp = 1_700_000_000 + age
        os.utime(f"{path}/{name}", (stamp, stamp))
    return len(names)


@pytest.fixture(scope="module")
def feed(calls, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("feed") / "calls")
    assert in_time_order(calls, path, "pubTime") == FILES
    return path


@pytest.fixture(scope="module")
def record_feed(calls, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("records") / "records")
    in_time_order(call_records(calls), path, "timestamp")
    return path


def streamed(spark, path):
    schema = spark.read.parquet(path).schema
    return stream_files(spark, path, schema, maxFilesPerTrigger="1")


def test_measures_of_batches_add_up_to_the_table(spark, calls, feed, tmp_path, rows):
    jobs.store_measures(
        streamed(spark, feed), str(tmp_path), available_now=True
    ).awaitTermination()
    stored = jobs.stored_measures(spark, str(tmp_path))
    assert stored.select("batch_id").distinct().count() == FILES
    assert rows(kpis.figures_of(stored)) == rows(
        kpis.figures_of(kpis.service_measures(calls))
    )


@pytest.mark.parametrize("column", ["pubTime", "caseId"])
def test_windows_do_not_depend_on_batches(spark, calls, tmp_path, rows, column):
    """Late rows count: with files by caseId, all batches but the first are late."""
    path = f"{tmp_path}/feed"
    in_time_order(calls, path, column)
    jobs.store_measures(
        streamed(spark, path), f"{tmp_path}/job", available_now=True
    ).awaitTermination()
    stored = jobs.stored_measures(spark, f"{tmp_path}/job")
    found = rows(jobs.windowed_figures(stored, "15 minutes"))
    expected = rows(jobs.windowed_figures(kpis.service_measures(calls), "15 minutes"))
    assert found == expected
    windows = calls.select(F.window("pubTime", "15 minutes")).distinct().count()
    assert len(found) == windows


def test_a_window_has_the_figures_of_its_last_snapshot(spark, calls_of):
    calls = calls_of(
        {"pubTime": 1, "caseId": "a"},
        {"pubTime": 6, "caseId": "a"},
        {"pubTime": 6, "caseId": "b", "dt_start": 2, "dt_offered": 1},
        {"pubTime": 16, "caseId": "a"},
    )
    found = jobs.windowed_figures(kpis.service_measures(calls), "15 minutes")
    assert [(r.callsAmt, r.queueSize) for r in found.orderBy("windowStart").collect()] == [
        (2, 1),
        (1, 1),
    ]


def test_failed_batch_is_repeated_without_loss_or_double(spark, calls, feed, tmp_path, rows):
    failures = []

    def failing(batch_id):
        if batch_id == 2 and not failures:
            failures.append(batch_id)
            raise RuntimeError("lost after writing")

    def start():
        return jobs.store_measures(
            streamed(spark, feed), str(tmp_path), available_now=True, then=failing
        )

    with pytest.raises(StreamingQueryException):
        start().awaitTermination()
    start().awaitTermination()
    stored = jobs.stored_measures(spark, str(tmp_path))
    batches = stored.select("batch_id").distinct().collect()
    assert sorted(r.batch_id for r in batches) == [0, 1, 2, 3]
    assert rows(kpis.figures_of(stored)) == rows(
        kpis.figures_of(kpis.service_measures(calls))
    )


def test_a_second_job_leaves_the_first_ones_rows(spark, calls, feed, tmp_path, rows):
    for name, part in (("first", "caseId % 2 = 0"), ("second", "caseId % 2 = 1")):
        jobs.store_measures(
            streamed(spark, feed).where(part), f"{tmp_path}/{name}", available_now=True
        ).awaitTermination()
    both = jobs.stored_measures(spark, f"{tmp_path}/first").union(
        jobs.stored_measures(spark, f"{tmp_path}/second")
    )
    assert rows(kpis.figures_of(both)) == rows(
        kpis.figures_of(kpis.service_measures(calls))
    )


def test_reading_some_days_opens_no_others(spark, feed, tmp_path):
    jobs.store_measures(
        streamed(spark, feed), str(tmp_path), available_now=True
    ).awaitTermination()
    stored = jobs.stored_measures(spark, str(tmp_path))
    day = stored.selectExpr("min(day) AS day").first().day
    one = stored.where(F.col("day").isin([day]))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "(day#" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert 0 < one.count() < stored.count()


def published(spark, path):
    frames = decode_records(spark.read.parquet(path))
    key_class = _message_classes()["Key"]
    return [
        (row.batch_id, key_class.FromString(bytes(row.key)), row.line)
        for row in frames.collect()
    ]


def run_job(records, folder, **options):
    jobs.publish_figures(
        records,
        parquet_sink(f"{folder}/published"),
        parquet_sink(f"{folder}/quarantine"),
        str(folder),
        tenant="acme",
        available_now=True,
        **options,
    ).awaitTermination()
    return published(records.sparkSession, f"{folder}/published")


@pytest.fixture(scope="module")
def cut_feed(calls, tmp_path_factory):
    """Records whose snapshots are spread over all files."""
    path = str(tmp_path_factory.mktemp("cut") / "records")
    in_time_order(call_records(calls), path, "key")
    return path


def test_a_snapshot_cut_by_batches_is_published_whole(spark, calls, cut_feed, tmp_path):
    found = run_job(streamed(spark, cut_feed), tmp_path)
    last = {}
    for batch, key, line in sorted(found, key=lambda row: row[0]):
        entries = json.loads(line)
        if entries:
            last[key.key, entries[0]["pubTime"]] = line
    expected = messages.all_messages(kpis.service_measures(calls)).collect()
    assert sorted(last.values()) == sorted(r.value for r in expected if r.value != "[]")
    assert len({batch for batch, _, _ in found}) == FILES
    assert {k.header.identifier.tenant for _, k, _ in found} == {"acme"}


def test_a_repeated_batch_publishes_the_same(spark, calls, cut_feed, tmp_path):
    sink = parquet_sink(f"{tmp_path}/published")
    failures = []

    def failing(df, batch_id):
        sink(df, batch_id)
        if batch_id == 1 and not failures:
            failures.append(batch_id)
            raise RuntimeError("lost after publishing")

    def start():
        return jobs.publish_figures(
            streamed(spark, cut_feed), failing, parquet_sink(f"{tmp_path}/q"), str(tmp_path), "acme", available_now=True
        )

    with pytest.raises(StreamingQueryException):
        start().awaitTermination()
    start().awaitTermination()
    whole = run_job(streamed(spark, cut_feed), tmp_path / "other")
    again = published(spark, f"{tmp_path}/published")

    def plain(found):
        return sorted((b, k.key, line) for b, k, line in found)

    assert plain(again) == plain(whole)


def test_only_the_asked_figures_are_sent(spark, cut_feed, tmp_path):
    found = run_job(streamed(spark, cut_feed), tmp_path, keys=["wait-time"])
    assert {k.key for _, k, _ in found} == {"wait-time"}


def test_unknown_figures_are_refused(spark, cut_feed, tmp_path):
    with pytest.raises(ValueError):
        run_job(streamed(spark, cut_feed), tmp_path, keys=["queue-length"])


def test_batch_mode_sends_four_messages_per_batch_and_sets_bad_records_aside(
    spark, calls, record_feed, tmp_path
):
    bad = streamed(spark, record_feed).withColumn(
        "value", F.expr("CASE WHEN partition = 1 THEN X'FFFF' ELSE value END")
    )
    found = run_job(bad, tmp_path, per="batch")
    assert len(found) == 4 * FILES
    amounts = [
        json.loads(line)[0]["callsAmt"] for _, k, line in found if k.key == "queuers-and-callers"
    ]
    good = calls.where("caseId % 4 <> 1").count()
    assert sum(amounts) == good
    quarantine = spark.read.parquet(f"{tmp_path}/quarantine")
    assert quarantine.where("reason = 'bad_envelope'").count() == calls.count() - good
    sent = spark.read.parquet(record_feed).where("partition = 1")
    columns = ["key", "topic", "partition", "offset", "timestamp"]
    kept = quarantine.select(columns)
    assert kept.exceptAll(sent.select(columns)).isEmpty() and kept.count() == sent.count()
    assert {bytes(r.value) for r in quarantine.select("value").distinct().collect()} == {b"\xff\xff"}


def test_a_batch_without_good_records_publishes_nothing(spark, cut_feed, tmp_path):
    bad = streamed(spark, cut_feed).withColumn("value", F.expr("X'FFFF'"))
    quarantined = f"{tmp_path}/quarantine"
    jobs.publish_figures(
        bad, lambda df, batch_id: pytest.fail("published"), parquet_sink(quarantined), str(tmp_path), "acme", available_now=True
    ).awaitTermination()
    assert spark.read.parquet(quarantined).count() == spark.read.parquet(cut_feed).count()


def test_default_trigger_is_the_publishing_interval(spark, feed, tmp_path):
    query = jobs.store_measures(streamed(spark, feed), str(tmp_path))
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    stored = jobs.stored_measures(spark, str(tmp_path))
    assert stored.select("batch_id").distinct().count() == FILES


@pytest.mark.parametrize("asked, used", [({}, "3 seconds"), ({"interval": "1 minute"}, "1 minute")])
def test_the_interval_is_the_callers(spark, tmp_path, asked, used):
    seen = []

    class Writer:
        def option(self, name, value):
            return self

        def trigger(self, **kind):
            seen.append(kind)
            return self

        def start(self):
            return self

    jobs._started(Writer(), str(tmp_path), asked.get("interval", jobs.BATCH_INTERVAL), False)
    assert seen == [{"processingTime": used}]

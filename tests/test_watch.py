"""Counts of the job in the pass that reads, and its times against the interval."""

import time

import pytest
from pyspark.sql import functions as F

from callpulse.operators import records
from callpulse.plans.fixtures import calls_from_events, damaged_records
from callpulse.sources.files import parquet_sink, stream_files
from callpulse.streaming import jobs
from callpulse.streaming.ledger import Ledger
from callpulse.streaming.watch import Watch
from conftest import SMALL


@pytest.fixture(scope="module")
def feed(spark):
    events = spark.read.parquet(f"{SMALL}/events.parquet").where("event_id % 3 = 0")
    return damaged_records(calls_from_events(events)).cache()


def published(spark, feed, folder, fails=False, **options):
    stream = stream_files(spark, f"{folder}/topic", feed.schema, recursiveFileLookup="true", maxFilesPerTrigger="1")
    sink, failed = parquet_sink(f"{folder}/published"), []

    def publish(rows, batch_id):
        sink(rows, batch_id)
        if fails and batch_id == 1:
            failed.append(batch_id)
            raise RuntimeError("stopped before the ledger")

    return jobs.publish_figures(
        stream, publish, parquet_sink(f"{folder}/quarantine"), str(folder), "acme", available_now=True, **options
    )


def delivered(feed, folder, parts=3):
    for part in range(parts):
        feed.where(F.pmod("offset", F.lit(parts)) == part).coalesce(1).write.parquet(f"{folder}/topic/{part}")


def by_parsing(feed):
    reason = records.parse_lines(records.decode_records(feed)).select("reason")
    return tuple(reason.agg(F.count(F.lit(1)), F.count_if(F.col("reason").isNull()), F.count("reason")).first())


def test_counts_hold_over_a_failure_and_a_compaction(spark, feed, tmp_path):
    delivered(feed, tmp_path)
    with pytest.raises(Exception, match="stopped before the ledger"):
        published(spark, feed, tmp_path, fails=True).awaitTermination()
    published(spark, feed, tmp_path).awaitTermination()
    ledger, expected = Ledger(spark, str(tmp_path)), by_parsing(feed)
    assert tuple(ledger.counts().first()) == expected and expected[2] > 0
    for _ in range(2):  # the second time clears away what the first has merged
        ledger.compact(through=2)
        assert tuple(ledger.counts().first()) == expected


def test_a_ledger_without_batches_counts_nothing(spark, tmp_path):
    assert tuple(Ledger(spark, str(tmp_path)).counts().first()) == (0, 0, 0)


@pytest.mark.parametrize("interval", [0.0, 3600.0])
def test_batches_are_watched_against_the_interval(spark, feed, tmp_path, interval):
    delivered(feed, tmp_path, parts=2)
    watch = Watch(interval)
    spark.streams.addListener(watch)
    try:
        query = published(spark, feed, tmp_path)
        query.awaitTermination()
        for _ in range(100):  # progress is reported by another thread
            own = [b for b in watch.batches if b.run == str(query.runId) and b.records]
            if len(own) == 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(watch)
    assert [b.number for b in own] == [0, 1] and sum(b.records for b in own) == feed.count()
    first, last = feed.agg(F.min("timestamp"), F.max("timestamp")).first()
    assert (min(b.oldest for b in own), max(b.newest for b in own)) == (first, last)
    assert len([b for b in watch.late() if b in own]) == (2 if interval == 0 else 0)
    assert not watch.failures



def test_a_failed_run_is_told(spark, feed, tmp_path):
    delivered(feed, tmp_path, parts=2)
    watch = Watch(3600)
    spark.streams.addListener(watch)
    try:
        with pytest.raises(Exception, match="stopped before"):
            published(spark, feed, tmp_path, fails=True).awaitTermination()
        for _ in range(100):
            if watch.failures:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(watch)
    assert any("stopped before" in reason for reason in watch.failures)

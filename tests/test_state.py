"""Keyed state: whole snapshots, closing windows, late rows."""

import json
import os

import pytest
from pyspark.sql import functions as F

from callpulse.operators import kpis, messages
from callpulse.operators.records import decode_records
from callpulse.plans.fixtures import calls_from_events
from callpulse.plans.queries import FRAMES
from callpulse.sources.files import parquet_sink, read_parts, stream_files
from callpulse.streaming import state
from conftest import SMALL

LATE = "pubTime timestamp, observations bigint, calls bigint"


@pytest.fixture(scope="module")
def calls(spark):
    return calls_from_events(spark.read.parquet(f"{SMALL}/events.parquet").where("event_id % 4 = 0")).cache()


def streamed(spark, calls, folder, *columns, files=3, reverse=False):
    path = f"{folder}/feed"
    calls.repartitionByRange(files, *columns).write.parquet(path)
    names = sorted((n for n in os.listdir(path) if n.endswith(".parquet")), reverse=reverse)
    for age, name in enumerate(names):
        os.utime(f"{path}/{name}", (1_700_000_000 + age,) * 2)
    return stream_files(spark, path, calls.schema, maxFilesPerTrigger="1")


def published(spark, feed, folder, **options):
    state.publish_snapshots(
        feed, parquet_sink(f"{folder}/published"), parquet_sink(f"{folder}/late"), str(folder), "acme", available_now=True, **options
    ).awaitTermination()
    frames = decode_records(read_parts(spark, f"{folder}/published", FRAMES)).collect()
    last = {}
    for row in sorted(frames, key=lambda row: row.batch_id):
        entries = json.loads(row.line)
        if entries:
            last[bytes(row.key), entries[0]["pubTime"]] = row.line
    late = read_parts(spark, f"{folder}/late", "pubTime timestamp, services_name string, calls bigint")
    return last, late.agg(F.coalesce(F.sum("calls"), F.lit(0))).first()[0], frames


def test_snapshots_cut_by_batches_are_published_whole(spark, calls, tmp_path):
    feed = streamed(spark, calls, tmp_path, "caseId")
    last, late, frames = published(spark, feed, tmp_path, retention="1000 days")
    expected = messages.all_messages(kpis.service_measures(calls)).collect()
    assert sorted(last.values()) == sorted(r.value for r in expected if r.value != "[]")
    assert late == 0 and len({r.batch_id for r in frames}) >= 3


def test_ended_snapshots_set_their_late_rows_aside(spark, calls, tmp_path):
    feed = streamed(spark, calls, tmp_path, "pubTime", reverse=True)
    last, late, _ = published(spark, feed, tmp_path, retention="1 hour")
    amounts = [json.loads(line)[0] for line in last.values() if '"callsAmt"' in line]
    assert late > 0 and late + sum(a["callsAmt"] for a in amounts) == calls.count()


@pytest.mark.parametrize("reverse", [False, True])
def test_windows_and_late_rows_are_all_observations(spark, calls, tmp_path, reverse):
    feed = streamed(spark, calls, tmp_path, "pubTime", reverse=reverse)
    failures = []

    def failing(batch_id):
        if batch_id == 1 and not failures:
            failures.append(batch_id)
            raise RuntimeError("lost after writing")

    def start():
        return state.publish_windows(
            feed, parquet_sink(f"{tmp_path}/closed"), parquet_sink(f"{tmp_path}/late"), str(tmp_path),
            "15 minutes", "1 hour", available_now=True, then=failing,
        )

    with pytest.raises(Exception, match="lost after writing"):
        start().awaitTermination()
    start().awaitTermination()
    columns = "windowStart timestamp, windowEnd timestamp, pubTime timestamp, observations bigint, callsAmt bigint, queueSize bigint"
    closed = read_parts(spark, f"{tmp_path}/closed", columns).collect()
    late = read_parts(spark, f"{tmp_path}/late", LATE).collect()
    held = state.open_windows(spark, str(tmp_path)).collect()
    assert sum(r.observations for r in (*closed, *late, *held)) == calls.count()
    assert bool(late) == reverse and len({r.windowStart for r in closed}) == len(closed) > 0
    # A window that had no late rows has the figures of its last snapshot.
    figures = {r.pubTime: r for r in kpis.figures_of(kpis.service_measures(calls)).collect()}
    for row in closed:
        if not late:
            assert (row.callsAmt, row.queueSize) == (figures[row.pubTime].callsAmt, figures[row.pubTime].queueSize)


def test_the_session_keeps_its_state_store(spark, calls, tmp_path):
    before = spark.conf.get(state.PROVIDER, None)
    with state._rocksdb(spark):
        assert spark.conf.get(state.PROVIDER) == state.ROCKSDB
    assert spark.conf.get(state.PROVIDER, None) == before


def test_measures_of_one_call_add_up_to_those_of_all(calls, rows):
    by = ["pubTime", "services_name"]
    single = calls.select(*by, *kpis.call_measures()).groupBy(*by).agg(*kpis.merged_measures())
    assert rows(single) == rows(kpis.service_measures(calls))

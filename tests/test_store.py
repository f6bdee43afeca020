"""The store of measures: compaction, what a batch lists, and the ledger."""

import json
import random

import pytest
from pyspark.sql import functions as F

from callpulse.operators import kpis
from callpulse.plans import queries
from callpulse.sources import files
from callpulse.streaming import store as store_module
from callpulse.streaming.ledger import RUN, Ledger
from callpulse.streaming.store import MeasureStore

DAY = 24 * 60


def measures(calls_of, *rows):
    return kpis.service_measures(calls_of(*rows))


def figures(store, days=None):
    return sorted(tuple(r) for r in kpis.figures_of(store.read(days)).collect())


def filled(spark, calls_of, folder, batches=6, days=3):
    """A store of random calls in several batches, and the calls."""
    r = random.Random(batches)
    store, rows = MeasureStore(spark, str(folder)), []
    for batch in range(batches):
        new = [
            {"pubTime": r.randrange(days) * DAY + 5.0 * r.randrange(4), "services_name": r.choice(["a", "b", None]),
             "dt_offered": 0, "dt_start": r.choice([None, 1]), "dt_offered_queue": 0, "dt_handled": None}
            for _ in range(9)
        ]
        rows += new
        store.write(measures(calls_of, *new), batch)
    return store, sorted(tuple(r) for r in kpis.figures_of(measures(calls_of, *rows)).collect())


def test_figures_are_equal_before_during_and_after_a_compaction(spark, calls_of, tmp_path, monkeypatch):
    store, expected = filled(spark, calls_of, tmp_path)
    assert figures(store) == expected
    seen = []
    # Between the writing of a closed part and its pointer, and after the pointer.
    monkeypatch.setattr(store_module, "mark", lambda s, path: (seen.append(figures(store)), files.mark(s, path), seen.append(figures(store))))
    assert len(store.compact(through=3)) == 3
    assert len(seen) == 6 and all(found == expected for found in seen)
    assert figures(store) == expected
    assert {b for day in store.days() for b in store.closed_through(day)} <= {2, 3}
    store.compact(through=5)
    assert figures(store) == expected


def test_a_reader_from_before_a_compaction_still_reads(spark, calls_of, tmp_path):
    store, expected = filled(spark, calls_of, tmp_path)
    begun = kpis.figures_of(store.read())
    store.compact(through=5)
    assert sorted(tuple(r) for r in begun.collect()) == expected


def test_a_closed_day_is_one_file(spark, calls_of, tmp_path):
    store, expected = filled(spark, calls_of, tmp_path)
    for _ in range(2):  # the second time clears away what the first has closed
        store.compact(through=5)
    assert store.open_days() == [] and len(store.days()) == 3
    for day in store.days():
        (last,) = store.closed_through(day)
        parts = files.names_in(spark, f"{store.folder}/closed/day={day}/batch_id={last}")
        assert sum(name.endswith(".parquet") for name in parts) == 1
    assert figures(store) == expected
    # A late batch opens a closed day again.
    store.write(measures(calls_of, {"pubTime": 0, "caseId": "late"}), 9)
    late = figures(store)
    assert late != expected
    store.compact(through=9)
    assert figures(store) == late


def test_an_unfinished_batch_is_not_closed_and_replaced_when_repeated(spark, calls_of, tmp_path):
    store = MeasureStore(spark, str(tmp_path))
    store.write(measures(calls_of, {"pubTime": 0}), 0)
    store.write(measures(calls_of, {"pubTime": 0}, {"pubTime": 0}), 1)
    store.compact(through=0)
    store.write(measures(calls_of, {"pubTime": 0}), 1)
    assert store.read().agg(F.sum("calls")).first()[0] == 2


@pytest.mark.parametrize("days", [2, 9])
def test_a_batch_lists_its_own_days_only(spark, calls_of, tmp_path, monkeypatch, days):
    store = MeasureStore(spark, str(tmp_path))
    for batch in range(days):
        store.write(measures(calls_of, {"pubTime": batch * DAY}), batch)
    listed = []
    monkeypatch.setattr(store_module, "names_in", lambda s, path: listed.append(path) or files.names_in(s, path))
    day = store_module.numbers_in(files.names_in(spark, f"{store.folder}/open"), "day=")[0]
    found = store.read([day])
    assert len(listed) == 2 and all(f"day={day}" in path for path in listed)
    assert len(found.inputFiles()) == 1 and found.count() == 1


def test_one_day_of_many_rows_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(400_000).select(
        (F.timestamp_seconds(F.lit(0)) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") / 10_000)).alias("pubTime"),
        F.col("id").cast("string").alias("services_name"),
        *(F.col("id").alias(m) for m in kpis.MEASURES),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store = MeasureStore(spark, str(tmp_path))
        store.write(rows, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    (day,) = store.days()
    names = files.names_in(spark, f"{store.folder}/open/day={day}/batch_id=0")
    assert sum(n.endswith(".parquet") for n in names) == 4 and store.read().count() == 400_000


def test_an_empty_store(spark, calls_of, tmp_path):
    store = MeasureStore(spark, str(tmp_path))
    assert store.days() == [] and store.compact(5) == [] and store.read().isEmpty() and store.read([3]).isEmpty()
    store.write(measures(calls_of).limit(0), 0)
    assert store.read().isEmpty()
    assert store.read().columns == store_module.SCHEMA.fieldNames()


# The ledger

RECORD = "topic string, partition int, offset bigint"


def records(spark, *rows):
    return spark.createDataFrame(list(rows), RECORD)


def test_intervals_merge(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    assert ledger.begin() == 0 and ledger.starting_offsets() is None
    ledger.write(records(spark, ("t", 0, 5), ("t", 0, 9), ("t", 1, 0)), 0)
    ledger.write(records(spark, ("t", 0, 10), ("t", 0, 12), ("t", 1, 7)), 1)
    ledger.write(records(spark, (None, None, None)).where("topic is not null"), 2)
    expected = [("t", 0, 5, 13, 4, 0), ("t", 1, 0, 1, 1, 0), ("t", 1, 7, 8, 1, 0)]
    for through in (None, 1, 2, 2):
        if through is not None:
            ledger.compact(through)
        assert sorted(tuple(r) for r in ledger.intervals().collect()) == expected
    assert len(ledger.parts()) == 0 and ledger.closed_through()[-1] == 2
    assert ledger.ends() == []  # the run that goes on has read them


def test_a_lost_checkpoint_begins_a_new_run(spark, calls_of, tmp_path):
    ledger, store = Ledger(spark, str(tmp_path)), MeasureStore(spark, str(tmp_path))
    assert ledger.begin() == 0 == ledger.begin()
    store.write(measures(calls_of, {"pubTime": 0}), 0)
    ledger.write(records(spark, ("t", 0, 5), ("u", 1, 0)), 0)
    store.write(measures(calls_of, {"pubTime": 0}), 1)  # stopped before its ledger row
    files.remove(spark, f"{tmp_path}/checkpoint")
    assert json.loads(ledger.starting_offsets()) == {"t": {"0": 6}, "u": {"1": 1}}
    assert ledger.begin() == RUN
    assert store.read().select("batch_id").collect() == [(0,)]
    offered = records(spark, ("t", 0, 5), ("t", 0, 6), ("t", 3, 1), ("u", 1, 0))
    ledger.write(offered, RUN)  # what this run reads does not hide its own records
    assert sorted(tuple(r) for r in ledger.unread(offered).collect()) == [("t", 0, 6), ("t", 3, 1)]
    files.remove(spark, f"{tmp_path}/checkpoint")
    assert ledger.begin() == 2 * RUN


def test_the_query_uses_every_record_once(spark):
    folder = "/root/testdata/sf0.001"
    found = queries.stream_lost_checkpoint(spark, folder)
    assert found.agg(F.sum("callsAmt")).first()[0] == queries.calls(spark, folder).count()

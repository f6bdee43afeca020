"""The combined figures as changes: what a batch has changed, and what changes make."""

import itertools

from pyspark.sql import functions as F

from callpulse.operators import kpis
from callpulse.sources.files import parquet_sink, read_parts, stream_files
from callpulse.streaming import feed
from callpulse.streaming.store import MeasureStore

QUEUING = {"dt_offered": 0, "dt_offered_queue": 0, "dt_offered_service": 0}


def table(spark, *rows):
    return spark.createDataFrame(rows, "k string, v double")


def test_changed_new_and_lost_rows(spark):
    before = table(spark, ("same", 1.0), ("other", 1.0), ("lost", 1.0), (None, 1.0))
    after = table(spark, ("same", 1.0), ("other", 2.0), ("new", 3.0), (None, 1.0))
    found = feed.row_changes(before, after, "k").collect()
    assert {tuple(r) for r in found} == {("other", 2.0, False), ("new", 3.0, False), ("lost", None, True)}
    nothing = before.where("false")
    assert feed.row_changes(nothing, nothing, "k").isEmpty()
    assert feed.row_changes(before, nothing, "k").where("deleted").count() == 4


def test_changes_in_any_order_and_repeated_make_one_table(spark):
    rows = [("a", 1.0, False, 0), ("a", None, True, 1), ("a", 3.0, False, 2), ("b", 1.0, False, 0), ("b", None, True, 2)]
    schema = "k string, v double, deleted boolean, version bigint"
    for order in itertools.islice(itertools.permutations(rows), 0, 120, 40):
        made = feed.apply_changes(spark.createDataFrame([*order, order[0]], schema), "k")
        assert [tuple(r) for r in made.collect()] == [("a", 3.0)]


def stepped(spark, calls_of, folder, *batches):
    """The rows of both feeds after each batch of calls, by the functions of the job."""
    store = MeasureStore(spark, str(folder))
    for number, rows in enumerate(batches):
        measures = kpis.service_measures(calls_of(*rows))
        store.write(measures, number)
        yield [
            {tuple(r) for r in changes.select("pubTime", "kpi", "dimension", "value", "deleted").collect()}
            for changes in (feed.snapshot_changes(measures, store, number), feed.current_changes(store, number))
        ]


def test_a_service_whose_queue_ends_loses_its_row(spark, calls_of, tmp_path):
    first = [{"pubTime": 0, "services_name": s, **QUEUING} for s in ("a", "b", "c")]
    # a has left the queue, of b nothing is observed, c still waits
    then = [
        {"pubTime": 5, "services_name": "a", **QUEUING, "dt_start": 4},
        {"pubTime": 5, "services_name": "c", **QUEUING},
    ]
    late = [{"pubTime": 0, "services_name": "d", **QUEUING}]
    steps = list(stepped(spark, calls_of, tmp_path, first, then, late))
    queue = "amtOfQueuersInService"

    def of_queue(rows):
        return {(dimension, value, gone) for _, kpi, dimension, value, gone in rows if kpi == queue}

    assert of_queue(steps[0][1]) == {("a", 1.0, False), ("b", 1.0, False), ("c", 1.0, False)}
    assert of_queue(steps[1][1]) == {("a", None, True), ("b", None, True), ("c", 1.0, False)}
    assert of_queue(steps[1][0]) == {("c", 1.0, False)}  # the snapshot before keeps its rows
    assert steps[2][1] == set() and of_queue(steps[2][0]) == {("d", 1.0, False)}


def test_only_what_changed_is_given(spark, calls_of, tmp_path):
    one = [{"pubTime": 0, "services_name": "a", **QUEUING}]
    steps = list(stepped(spark, calls_of, tmp_path, one, [{"pubTime": 0, "services_name": "b", "dt_offered": 0}]))
    assert {kpi for _, kpi, *_ in steps[1][0]} == {"queueSize", "callsAmt"}  # ratioServed is 0 as before


def test_the_job_repeats_a_batch_with_the_same_changes(spark, calls_of, tmp_path):
    calls = calls_of(*({"pubTime": 5.0 * (i % 3), "services_name": "ab"[i % 2], **QUEUING} for i in range(12)))
    for part in range(3):
        calls.where(F.col("caseId") % 3 == part).coalesce(1).write.parquet(f"{tmp_path}/feed/{part}")
    failed = []

    def breaks_once(rows, batch_id):
        parquet_sink(f"{tmp_path}/current")(rows, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("stopped after writing")

    def run():
        source = stream_files(spark, f"{tmp_path}/feed", calls.schema, recursiveFileLookup="true", maxFilesPerTrigger="1")
        return feed.publish_changes(
            source, parquet_sink(f"{tmp_path}/changes"), breaks_once, str(tmp_path), available_now=True, compact_every=2
        )

    try:
        run().awaitTermination()
    except Exception as stopped:
        assert "stopped after writing" in str(stopped)
    assert failed == [1]
    run().awaitTermination()
    expected = {tuple(r) for r in kpis.combined(kpis.service_measures(calls)).collect()}
    made = feed.apply_changes(read_parts(spark, f"{tmp_path}/changes", feed.CHANGES), *feed.CHANGE_KEYS)
    assert {tuple(r) for r in made.select("pubTime", "kpi", "dimension", "value").collect()} == expected
    last = max(r[0] for r in expected)
    now = feed.apply_changes(read_parts(spark, f"{tmp_path}/current", feed.CHANGES), *feed.CURRENT_KEYS)
    assert {tuple(r) for r in now.select("pubTime", "kpi", "dimension", "value").collect()} == {r for r in expected if r[0] == last}

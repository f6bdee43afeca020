import random

from callpulse.operators import filters, kpis
from conftest import NOON, at


def ids(df):
    return sorted(row.caseId for row in df.collect())


def stage_rows(calls_of):
    return calls_of(
        dict(pubTime=10, dt_offered=0, dt_offered_queue=1, dt_start=10, dt_handled=10),
        dict(pubTime=10, dt_offered=0, dt_offered_queue=1, dt_start=11, dt_handled=12),
        dict(pubTime=10, dt_offered=0, dt_offered_queue=10),
        dict(pubTime=10, dt_offered=0, dt_offered_queue=11, dt_start=12),
        dict(pubTime=10, dt_offered=0, dt_start=5, dt_handled=11),
        dict(pubTime=10, dt_offered=0, dt_offered_queue=1, dt_end=5),
    )


def test_stage_reached_at_its_own_instant(calls_of):
    assert ids(filters.handled_calls(stage_rows(calls_of))) == ["0"]
    assert ids(filters.served_calls(stage_rows(calls_of))) == ["0", "4"]


def test_future_and_missing_start_wait_and_abandoned_calls_keep_waiting(calls_of):
    assert ids(filters.waiting_calls(stage_rows(calls_of))) == ["1", "2", "3", "5"]


def test_service_queue_needs_the_queue_stage(calls_of):
    assert ids(filters.calls_in_service_queue(stage_rows(calls_of))) == ["1", "2", "5"]


def test_durations(calls_of, rows):
    calls = stage_rows(calls_of)
    assert rows(filters.handled_calls(calls).select("handlingMs")) == [(600_000,)]
    assert rows(filters.served_calls(calls).select("queueMs")) == [(300_000,), (600_000,)]


def test_averages_are_minutes_unless_asked(calls_of, rows):
    calls = calls_of(
        dict(pubTime=10, dt_offered=0, dt_start=1, dt_handled=2),
        dict(pubTime=10, dt_offered=0, dt_start=2, dt_handled=5),
        dict(pubTime=10, dt_offered=0, dt_start=20, dt_handled=30),
    )
    assert rows(kpis.average_handling_time(calls)) == [(at(10), 3.5)]
    assert rows(kpis.wait_time(calls)) == [(at(10), 1.5)]
    assert rows(kpis.wait_time(calls, "seconds")) == [(at(10), 90.0)]


def test_queuers_and_callers_counts_records(calls_of, rows):
    call = dict(caseId="same", pubTime=10, dt_offered=0, dt_start=1)
    calls = calls_of(call, call, dict(pubTime=10, dt_offered=0), dict(pubTime=15))
    assert rows(kpis.queuers_and_callers(calls)) == [
        (at(10), 1, 3, 1 - 1 / 3),
        (at(15), 1, 1, 0.0),
    ]


def test_queuers_per_service(calls_of, rows):
    queued = dict(pubTime=10, dt_offered_queue=1)
    calls = calls_of(
        dict(queued, services_name="x"),
        dict(queued, services_name="x"),
        dict(queued, services_name="y"),
        dict(queued, services_name="z", dt_start=2),
    )
    figure = kpis.queuers_per_service(calls)
    assert rows(figure) == [(at(10), "x", 2), (at(10), "y", 1)]
    assert dict(figure.dtypes)["amtOfQueuersInService"] == "int"


def test_nothing_handled_or_served_gives_no_average(calls_of):
    calls = calls_of(dict(pubTime=10, dt_offered=0))
    assert kpis.average_handling_time(calls).isEmpty()
    assert kpis.wait_time(calls).isEmpty()
    assert kpis.queuers_and_callers(calls).count() == 1


def test_empty_input_gives_no_figure(calls_of):
    calls = calls_of(dict(pubTime=10)).limit(0)
    measures = kpis.service_measures(calls)
    figures = [
        kpis.average_handling_time(calls),
        kpis.queuers_and_callers(calls),
        kpis.wait_time(calls),
        kpis.queuers_per_service(calls),
        kpis.batch_totals(calls),
        kpis.combined(measures),
        kpis.figures_of(measures),
    ]
    assert all(figure.isEmpty() for figure in figures)


def test_batch_totals_use_the_last_pub_time(calls_of, rows):
    calls = calls_of(
        dict(pubTime=10, dt_offered=0, dt_start=1, dt_handled=4),
        dict(pubTime=15, dt_offered=0),
    )
    assert rows(kpis.batch_totals(calls)) == [(at(15), 4.0, 1, 2, 0.5, 1.0)]


def random_calls(calls_of, count=3000, seed=7):
    pick = random.Random(seed)

    def stage(start):
        return None if pick.random() < 0.2 else start + pick.randrange(0, 1200) / 60

    table = []
    for _ in range(count):
        offered = pick.randrange(0, 60)
        # One instant holds about a third of all observations.
        pub = 30 if pick.random() < 1 / 3 else pick.randrange(0, 100)
        table.append(
            dict(
                pubTime=pub,
                dt_offered=offered,
                dt_offered_queue=stage(offered),
                dt_start=stage(offered + 5),
                dt_handled=stage(offered + 10),
                services_name=pick.choice(["a", "b", "c", ""]),
            )
        )
    return table, calls_of(*table)


def test_figures_of_random_calls_agree_with_brute_force(calls_of):
    table, calls = random_calls(calls_of)
    expected = {}
    for row in table:
        group = expected.setdefault(row["pubTime"], dict(n=0, w=0, q={}, h=[], s=[]))
        group["n"] += 1
        start, handled = row["dt_start"], row["dt_handled"]
        waiting = start is None or start > row["pubTime"]
        group["w"] += waiting
        if not waiting:
            group["s"].append(start - row["dt_offered"])
        if handled is not None and handled <= row["pubTime"]:
            group["h"].append(handled - row["dt_offered"])
        queue = row["dt_offered_queue"]
        if waiting and queue is not None and queue <= row["pubTime"]:
            service = row["services_name"]
            group["q"][service] = group["q"].get(service, 0) + 1

    measures = kpis.service_measures(calls)
    found = {}
    for pub, kpi, dimension, value in kpis.combined(measures).collect():
        found[round((pub - NOON).total_seconds() / 60), kpi, dimension] = value
    wanted = {}
    for pub, group in expected.items():
        wanted[pub, "callsAmt", None] = group["n"]
        wanted[pub, "queueSize", None] = group["w"]
        wanted[pub, "ratioServed", None] = 1 - group["w"] / group["n"]
        if group["h"]:
            wanted[pub, "avgCallDuration", None] = sum(group["h"]) / len(group["h"])
        if group["s"]:
            wanted[pub, "queueDuration", None] = sum(group["s"]) / len(group["s"])
        for service, count in group["q"].items():
            wanted[pub, "amtOfQueuersInService", service] = count
    assert found.keys() == wanted.keys()
    # Stages of the random rows are floats in minutes; Spark holds microseconds.
    assert all(abs(found[key] - wanted[key]) < 1e-4 for key in wanted)


def test_invariants_of_random_calls(calls_of):
    _, calls = random_calls(calls_of, seed=11)
    queues = {}
    for row in kpis.queuers_per_service(calls).collect():
        queues[row.pubTime] = queues.get(row.pubTime, 0) + row.amtOfQueuersInService
    for row in kpis.queuers_and_callers(calls).collect():
        assert 0 <= row.ratioServed <= 1
        assert row.queueSize <= row.callsAmt
        assert queues.get(row.pubTime, 0) <= row.queueSize


def test_combined_equals_the_single_figures(calls_of, rows):
    _, calls = random_calls(calls_of, count=500, seed=3)
    merged = kpis.figures_of(kpis.service_measures(calls))
    assert rows(merged.select("pubTime", "queueSize", "callsAmt", "ratioServed")) == rows(
        kpis.queuers_and_callers(calls)
    )
    averages = merged.where("queueDuration IS NOT NULL").select("pubTime", "queueDuration")
    assert rows(averages) == rows(kpis.wait_time(calls))
    handled = merged.where("avgCallDuration IS NOT NULL")
    assert rows(handled.select("pubTime", "avgCallDuration")) == rows(
        kpis.average_handling_time(calls)
    )

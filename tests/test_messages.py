import json

from callpulse.operators import kpis, messages
from callpulse.schema import KPI_KEYS
from conftest import NOON, at
from datetime import timezone

EPOCH = int(NOON.replace(tzinfo=timezone.utc).timestamp() * 1000)


def calls(calls_of):
    return calls_of(
        dict(pubTime=10, dt_offered=0, dt_offered_queue=1, dt_start=2, dt_handled=4),
        dict(pubTime=10, dt_offered=0, dt_offered_queue=1, services_name='a "b"'),
        dict(pubTime=10, dt_offered=0, dt_offered_queue=1, services_name="a"),
        dict(pubTime=15, dt_offered=14),
    )


def test_message_texts(calls_of):
    table = calls(calls_of)
    at_ten = f'"pubTime":{EPOCH + 600_000}'

    def texts(message):
        return [tuple(row) for row in message.orderBy("value").collect()]

    assert texts(
        messages.average_handling_time_message(kpis.average_handling_time(table))
    ) == [("average-handling-time", "[{%s,\"avgCallDuration\":4.0}]" % at_ten)]
    assert texts(messages.wait_time_message(kpis.wait_time(table))) == [
        ("wait-time", "[{%s,\"queueDuration\":2.0}]" % at_ten)
    ]
    first, _ = texts(
        messages.queuers_and_callers_message(kpis.queuers_and_callers(table))
    )
    assert json.loads(first[1]) == [
        {
            "pubTime": EPOCH + 600_000,
            "queueSize": 2,
            "callsAmt": 3,
            "ratioServed": 1 - 2 / 3,
        }
    ]


def test_service_list_is_one_ordered_message_and_may_be_empty(calls_of):
    found = messages.queuers_per_service_message(
        kpis.service_measures(calls(calls_of))
    ).collect()
    lists = sorted((json.loads(row.value) for row in found), key=len)
    assert lists == [
        [],
        [
            {"pubTime": EPOCH + 600_000, "serviceName": name, "amtOfQueuersInService": 1}
            for name in ("a", 'a "b"')
        ],
    ]


def test_all_messages_are_the_single_messages(calls_of, rows):
    table = calls(calls_of)
    measures = kpis.service_measures(table)
    single = (
        messages.average_handling_time_message(kpis.average_handling_time(table))
        .union(messages.queuers_and_callers_message(kpis.queuers_and_callers(table)))
        .union(messages.wait_time_message(kpis.wait_time(table)))
        .union(messages.queuers_per_service_message(measures))
    )
    assert rows(messages.all_messages(measures)) == rows(single)


def test_batch_messages_are_one_per_figure(calls_of):
    table = calls(calls_of)
    found = messages.batch_messages(kpis.service_measures(table)).collect()
    values = {row.key: json.loads(row.value) for row in found}
    assert sorted(values) == sorted(KPI_KEYS)
    last = EPOCH + 900_000
    assert values["queuers-and-callers"] == [
        {"pubTime": last, "queueSize": 3, "callsAmt": 4, "ratioServed": 0.25}
    ]
    assert values["wait-time"] == [{"pubTime": last, "queueDuration": 2.0}]
    assert {s["serviceName"] for s in values["queuers-per-service"]} == {"a", 'a "b"'}
    assert {s["pubTime"] for s in values["queuers-per-service"]} == {last}


def test_no_calls_send_no_message(calls_of):
    measures = kpis.service_measures(calls(calls_of).limit(0))
    assert messages.all_messages(measures).isEmpty()
    assert messages.batch_messages(measures).isEmpty()

"""Observations of calls that are at a given stage."""

from pyspark.sql import DataFrame

from callpulse.functions import stages


def handled_calls(calls: DataFrame) -> DataFrame:
    return calls.where(stages.is_handled()).withColumn(
        "handlingMs", stages.handling_millis()
    )


def waiting_calls(calls: DataFrame) -> DataFrame:
    return calls.where(stages.is_waiting())


def served_calls(calls: DataFrame) -> DataFrame:
    return calls.where(stages.is_served()).withColumn("queueMs", stages.queue_millis())


def calls_in_service_queue(calls: DataFrame) -> DataFrame:
    return calls.where(stages.in_service_queue())

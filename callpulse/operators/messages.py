"""Figures as keyed JSON messages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callpulse.operators.kpis import MEASURES, figures, merged_measures
from callpulse.schema import (
    AVERAGE_HANDLING_TIME,
    KPI_KEYS,
    QUEUERS_AND_CALLERS,
    QUEUERS_PER_SERVICE,
    WAIT_TIME,
)

# Published fields of the one-object messages, after pubTime.
_FIELDS = {
    AVERAGE_HANDLING_TIME: ["avgCallDuration"],
    QUEUERS_AND_CALLERS: ["queueSize", "callsAmt", "ratioServed"],
    WAIT_TIME: ["queueDuration"],
}


def _epoch() -> Column:
    return F.unix_millis("pubTime").alias("pubTime")


def _object_message(key: str) -> Column:
    return F.to_json(F.array(F.struct(_epoch(), *_FIELDS[key])))


def _figure_message(kpi: DataFrame, key: str) -> DataFrame:
    return kpi.select(F.lit(key).alias("key"), _object_message(key).alias("value"))


def average_handling_time_message(kpi: DataFrame) -> DataFrame:
    return _figure_message(kpi, AVERAGE_HANDLING_TIME)


def queuers_and_callers_message(kpi: DataFrame) -> DataFrame:
    return _figure_message(kpi, QUEUERS_AND_CALLERS)


def wait_time_message(kpi: DataFrame) -> DataFrame:
    return _figure_message(kpi, WAIT_TIME)


def _service_list() -> Column:
    """List aggregate over counted services, in name order.

    One element per service with a queue: the calls are already counted, and
    the list is the message itself.
    """
    entry = F.struct(
        _epoch(),
        F.col("services_name").alias("serviceName"),
        F.col("queued").alias("amtOfQueuersInService"),
    )
    return F.array_sort(F.collect_list(F.when(F.col("queued") > 0, entry)))


def queuers_per_service_message(measures: DataFrame) -> DataFrame:
    """One message per ``pubTime`` with all its services; ``[]`` when none queues."""
    return measures.groupBy("pubTime").agg(_service_list().alias("services")).select(
        F.lit(QUEUERS_PER_SERVICE).alias("key"),
        F.to_json("services").alias("value"),
    )


def _as_messages(row: DataFrame) -> DataFrame:
    """Rows of merged measures and ``services`` to one row per message."""
    named = row.select(
        "pubTime", "services", *[c.alias(n) for n, c in figures().items()]
    )
    values = [
        F.when(F.col("avgCallDuration").isNotNull(), _object_message(AVERAGE_HANDLING_TIME)),
        _object_message(QUEUERS_AND_CALLERS),
        F.when(F.col("queueDuration").isNotNull(), _object_message(WAIT_TIME)),
        F.to_json("services"),
    ]
    pairs = [
        F.struct(F.lit(key).alias("key"), value.alias("value"))
        for key, value in zip(KPI_KEYS, values)
    ]
    return named.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull())


def all_messages(measures: DataFrame) -> DataFrame:
    """The four messages of every ``pubTime``, from measures read once."""
    return _as_messages(
        measures.groupBy("pubTime").agg(
            _service_list().alias("services"), *merged_measures()
        )
    )


def batch_messages(measures: DataFrame) -> DataFrame:
    """The four messages of the whole input, stamped with its last ``pubTime``.

    Services are totalled before the single-row step, which then sees one row
    per service.
    """
    per_service = measures.groupBy("services_name").agg(
        F.max("pubTime").alias("pubTime"), *merged_measures()
    )
    total = per_service.agg(
        F.max("pubTime").alias("pubTime"),
        F.array_sort(
            F.collect_list(
                F.when(F.col("queued") > 0, F.struct("services_name", "queued"))
            )
        ).alias("counted"),
        *merged_measures(),
    ).where(F.col("calls") > 0)
    services = F.transform(
        "counted",
        lambda service: F.struct(
            _epoch(),
            service["services_name"].alias("serviceName"),
            service["queued"].alias("amtOfQueuersInService"),
        ),
    )
    return _as_messages(total.select("pubTime", *MEASURES, services.alias("services")))

"""The published figures.

A figure belongs to one ``pubTime``, so each is a grouped aggregate: a partial
aggregate next to the scan, one shuffle of at most one row per task and group,
a final aggregate. A hot ``pubTime`` or service is therefore reduced before it
moves. No observation of a group means no row, so an empty input publishes
nothing.
"""

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callpulse.functions import stages


_LARGEST_INT = (1 << 31) - 1


def average_handling_time(calls: DataFrame, unit: str = "minutes") -> DataFrame:
    """``pubTime, avgCallDuration`` over handled calls."""
    return (
        calls.where(stages.is_handled())
        .groupBy("pubTime")
        .agg(
            stages.mean_duration(
                F.sum(stages.handling_millis()), F.count("*"), unit
            ).alias("avgCallDuration")
        )
    )


def queuers_and_callers(calls: DataFrame) -> DataFrame:
    """``pubTime, queueSize, callsAmt, ratioServed`` over all observations."""
    queue_size = F.count_if(stages.is_waiting())
    calls_amt = F.count("*")
    return calls.groupBy("pubTime").agg(
        queue_size.alias("queueSize"),
        calls_amt.alias("callsAmt"),
        stages.ratio_served(queue_size, calls_amt).alias("ratioServed"),
    )


def wait_time(calls: DataFrame, unit: str = "minutes") -> DataFrame:
    """``pubTime, queueDuration`` over calls that have left the queue."""
    return (
        calls.where(stages.is_served())
        .groupBy("pubTime")
        .agg(
            stages.mean_duration(
                F.sum(stages.queue_millis()), F.count("*"), unit
            ).alias("queueDuration")
        )
    )


def queuers_per_service(calls: DataFrame, count_type: str = "int") -> DataFrame:
    """``pubTime, serviceName, amtOfQueuersInService`` for services with a queue.

    The count is published as an int, and one that is no int raises, whether or
    not the session is in ANSI mode. Ask for ``bigint`` where one queue can pass
    two thousand million.
    """
    queued = F.count("*")
    if count_type == "int":
        too_many = F.raise_error(F.lit("a queue is longer than an int can say"))
        queued = F.when(queued > _LARGEST_INT, too_many.cast("bigint")).otherwise(queued)
    return (
        calls.where(stages.in_service_queue())
        .groupBy("pubTime", F.col("services_name").alias("serviceName"))
        .agg(queued.cast(count_type).alias("amtOfQueuersInService"))
    )


# Additive measures: sums of these over any split of the input are exact.
MEASURES = ["calls", "waiting", "handled", "handled_ms", "served", "served_ms", "queued"]


def _measures() -> list[Column]:
    handled, served = stages.is_handled(), stages.is_served()
    columns = {
        "calls": F.count("*"),
        "waiting": F.count_if(stages.is_waiting()),
        "handled": F.count_if(handled),
        "handled_ms": F.sum(F.when(handled, stages.handling_millis()).otherwise(0)),
        "served": F.count_if(served),
        "served_ms": F.sum(F.when(served, stages.queue_millis()).otherwise(0)),
        "queued": F.count_if(stages.in_service_queue()),
    }
    return [columns[name].alias(name) for name in MEASURES]


def call_measures() -> list[Column]:
    """The measures of one observation, as a row: what ``service_measures`` adds up."""
    handled, served = stages.is_handled(), stages.is_served()

    def where(condition: Column, value: Column | None = None) -> Column:
        value = F.lit(1) if value is None else value
        return F.when(condition, value).otherwise(0).cast("bigint")

    columns = {
        "calls": F.lit(1).cast("bigint"),
        "waiting": where(stages.is_waiting()),
        "handled": where(handled),
        "handled_ms": where(handled, stages.handling_millis()),
        "served": where(served),
        "served_ms": where(served, stages.queue_millis()),
        "queued": where(stages.in_service_queue()),
    }
    return [columns[name].alias(name) for name in MEASURES]


def merged_measures() -> list[Column]:
    return [F.sum(name).alias(name) for name in MEASURES]


def service_measures(calls: DataFrame, *by: str, extra: Collection[Column] = ()) -> DataFrame:
    """All figures' counts and totals in one pass, per ``pubTime`` and service.

    The result is small and additive: micro-batches store it, and every figure
    follows from it without reading the calls again. ``extra`` are more aggregates.
    """
    by = by or ("pubTime",)
    return calls.groupBy(*by, "services_name").agg(*_measures(), *extra)


def figures() -> dict[str, Column]:
    """The figures of one row of (merged) measures, by published field name."""
    waiting, calls = F.col("waiting"), F.col("calls")
    return {
        "avgCallDuration": stages.mean_duration(F.col("handled_ms"), F.col("handled")),
        "queueSize": waiting,
        "callsAmt": calls,
        "ratioServed": stages.ratio_served(waiting, calls),
        "queueDuration": stages.mean_duration(F.col("served_ms"), F.col("served")),
    }


def figures_of(measures: DataFrame, *by: str) -> DataFrame:
    """Measures merged per ``by`` (default ``pubTime``), as one row of figures each."""
    by = by or ("pubTime",)
    merged = measures.groupBy(*by).agg(*merged_measures())
    return merged.select(*by, *[c.alias(n) for n, c in figures().items()])


def combined(measures: DataFrame) -> DataFrame:
    """All figures as ``pubTime, kpi, dimension, value``; dimension is the service.

    Works on measures, so the calls are read once for everything. An average
    without calls and a service without a queue have no row.
    """
    service = F.col("services_name")
    merged = measures.groupingSets(
        [[F.col("pubTime")], [F.col("pubTime"), service]], F.col("pubTime"), service
    ).agg(F.grouping("services_name").alias("_total"), *merged_measures())
    of_all = F.col("_total") == 1
    values = {
        name: F.when(of_all, column).cast("double") for name, column in figures().items()
    }
    values["amtOfQueuersInService"] = F.when(
        ~of_all & (F.col("queued") > 0), F.col("queued")
    ).cast("double")
    wide = merged.select(
        "pubTime",
        service.alias("dimension"),
        *[column.alias(name) for name, column in values.items()],
    )
    return (
        wide.unpivot(["pubTime", "dimension"], list(values), "kpi", "value")
        .where(F.col("value").isNotNull())
        .select("pubTime", "kpi", "dimension", "value")
    )


def batch_totals(calls: DataFrame) -> DataFrame:
    """All figures over the whole input as one row, stamped with the last ``pubTime``.

    This is what one micro-batch publishes when it is not split by ``pubTime``.
    Empty input gives no row.
    """
    measures = calls.agg(F.max("pubTime").alias("pubTime"), *_measures())
    return measures.where(F.col("calls") > 0).select(
        "pubTime", *[c.alias(n) for n, c in figures().items()]
    )

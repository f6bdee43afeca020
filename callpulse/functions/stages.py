"""Column builders that place a call at the instant it was observed.

A stage is reached when its timestamp is not after ``pubTime``. A null stage is
not reached, so every predicate works both for feeds that announce future
stages and for feeds that leave them empty.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Milliseconds in one unit of the published averages.
UNIT_MILLIS = {"milliseconds": 1, "seconds": 1_000, "minutes": 60_000}


def _reached(stage: str) -> Column:
    return F.col(stage) <= F.col("pubTime")


def _not_reached(stage: str) -> Column:
    return F.col(stage).isNull() | (F.col(stage) > F.col("pubTime"))


def is_handled() -> Column:
    return _reached("dt_handled")


def is_waiting() -> Column:
    """Not helped yet. An abandoned call keeps waiting."""
    return _not_reached("dt_start")


def is_served() -> Column:
    """Has left the queue."""
    return _reached("dt_start")


def in_service_queue() -> Column:
    """Put in a service's queue and not helped yet."""
    return _reached("dt_offered_queue") & _not_reached("dt_start")


def _millis_between(start: str, end: str) -> Column:
    return F.expr(f"(unix_micros({end}) - unix_micros({start})) div 1000")


def handling_millis() -> Column:
    return _millis_between("dt_offered", "dt_handled")


def queue_millis() -> Column:
    return _millis_between("dt_offered", "dt_start")


def mean_duration(total_millis: Column, calls: Column, unit: str = "minutes") -> Column:
    """Average from an exact millisecond total, divided once at the end.

    Integer totals merge in any order, so partial results of splits and
    micro-batches give the same double as one pass. No calls gives null.
    """
    return F.try_divide(total_millis, calls) / F.lit(float(UNIT_MILLIS[unit]))


def ratio_served(queue_size: Column, calls: Column) -> Column:
    return F.lit(1.0) - F.try_divide(queue_size, calls)

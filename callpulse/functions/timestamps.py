"""Timestamp text of the call feed: ``yyyy-MM-dd HH:mm:ss.SSS``, strict, UTC.

Neither direction depends on the session's time zone.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the shape of the feed's timestamps.
TIMESTAMP_SHAPE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}[.][0-9]{3}\z"


def parse_timestamp(text: Column) -> Column:
    """The instant, or null when the text is not exactly in the pattern.

    The cast is Spark's hand-written ISO parser, several times cheaper than a
    pattern parser; it rejects impossible dates, and the shape test rejects
    the other forms it would take (short fractions, zones, bare dates).
    """
    in_utc = F.concat(text, F.lit("Z")).try_cast("timestamp")
    return F.when(text.rlike(TIMESTAMP_SHAPE), in_utc)


def format_timestamp(name: str) -> Column:
    """The instant in the named column as text.

    The wall clock of UTC is a timestamp without zone, counted from 1970; as text
    it has no fixed number of fraction digits, so these are written on their own.
    """
    millis = f"unix_millis({name})"
    clock = (
        "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
        f" + make_dt_interval(0, 0, 0, floor({millis} / 1000))"
    )
    return F.expr(
        f"concat(substring(CAST({clock} AS STRING), 1, 19), '.', "
        f"lpad(pmod({millis}, 1000), 3, '0'))"
    )

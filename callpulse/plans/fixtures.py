"""A call feed derived from a table of events.

No call recording ships with this repository, so queries and tests derive one:
each event is a call, observed at every full five minutes while it is alive.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.functions.timestamps import format_timestamp
from callpulse.operators.frames import envelope
from callpulse.operators.once import evaluate_once
from callpulse.schema import CALL_FIELDS, TIMESTAMP_FIELDS

SNAPSHOT_MILLIS = 300_000
AFTERCARE_MILLIS = 600_000
TENANT = "demo"

# The events' ts has no zone; it is the wall clock of UTC.
_MILLIS = """CAST(floor(CAST(CAST(ts - TIMESTAMP_NTZ'1970-01-01 00:00:00' AS INTERVAL SECOND)
  AS DECIMAL(18, 6)) * 1000) AS BIGINT)"""

# Room for case numbers below 10^12 between the offsets of two snapshots.
_OFFSET_STRIDE = 1_000_000_000_000


def calls_from_events(events: DataFrame) -> DataFrame:
    """One row per call and snapshot, in the field order of the feed.

    The snapshots are counted from the call's own bounds, so no row is made
    only to be filtered away, and nothing is shuffled.
    """
    timed = (
        events.selectExpr(
            "event_id",
            "user_id",
            "event_type",
            f"{_MILLIS} AS offered",
            "CAST(round(value * 100) AS BIGINT) * 100 AS wait",
            "CAST(get_json_object(props, '$.k') AS BIGINT) * 5000 + 60000 AS talk",
        )
        .selectExpr("*", "offered + 10000 + wait AS started")
        .selectExpr("*", "started + talk AS handled")
        .selectExpr(
            "*",
            f"""CASE WHEN event_type = 'error' THEN started
                     ELSE handled + {AFTERCARE_MILLIS} END AS ended""",
        )
    )
    first = f"(offered + {SNAPSHOT_MILLIS - 1}) div {SNAPSHOT_MILLIS}"
    last = f"ended div {SNAPSHOT_MILLIS}"
    observed = timed.selectExpr(
        "*",
        f"explode(CASE WHEN {first} <= {last} THEN sequence({first}, {last}) END) AS snapshot",
    )
    return observed.selectExpr(
        f"timestamp_millis(snapshot * {SNAPSHOT_MILLIS}) AS pubTime",
        "CAST(event_id AS STRING) AS caseId",
        "timestamp_millis(offered) AS dt_offered",
        "CASE WHEN event_type <> 'error' THEN timestamp_millis(handled) END AS dt_handled",
        "timestamp_millis(offered + 5000) AS dt_offered_service",
        "timestamp_millis(offered + 10000) AS dt_offered_queue",
        "CASE WHEN event_type <> 'error' THEN timestamp_millis(started) END AS dt_start",
        "timestamp_millis(ended) AS dt_end",
        "concat('service-', user_id % 8) AS services_name",
        "CASE WHEN user_id % 3 = 0 THEN '1' ELSE '0' END AS ind_forward_service_previous",
        "event_type AS area",
        "concat(event_type, '-', user_id % 4) AS subarea",
    )


def call_lines(calls: DataFrame, *keep: str) -> DataFrame:
    """Each call observation as the text line a publisher would send."""
    fields = [
        F.coalesce(
            format_timestamp(name) if name in TIMESTAMP_FIELDS else F.col(name),
            F.lit(""),
        )
        for name in CALL_FIELDS
    ]
    lines = evaluate_once(calls, line=F.concat_ws(",", *fields))
    return lines.select(*keep, "line")


def damaged_lines(calls: DataFrame) -> DataFrame:
    """Call lines of which a known part is broken, for the quarantine."""
    number = F.col("caseId").cast("bigint")
    line = F.col("line")
    return call_lines(calls, "caseId").select(
        F.when(number % 97 == 0, F.concat(F.lit("x,"), line))
        .when(number % 101 == 0, F.replace(line, F.lit("."), F.lit(".9")))
        .otherwise(line)
        .alias("line"),
    )


def call_records(calls: DataFrame, topic: str = "calls") -> DataFrame:
    """Call lines enveloped in records with the columns of the Kafka source.

    Offsets rise with the snapshot and have gaps, as a compacted topic's do;
    dense ones would need a sort of each whole partition.
    """
    return _records(call_lines(calls, "caseId", "pubTime", "services_name"), topic)


def _records(lines: DataFrame, topic: str) -> DataFrame:
    number = F.col("caseId").cast("bigint")
    snapshot = F.floor(F.unix_millis("pubTime") / SNAPSHOT_MILLIS)
    keyed = lines.select(
        F.col("caseId").alias("key"),
        F.col("line").alias("value"),
        number.alias("number"),
        "pubTime",
        "services_name",
    )
    return envelope(keyed, F.lit(TENANT), F.col("services_name")).select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        (F.col("number") % 4).cast("int").alias("partition"),
        (snapshot * F.lit(_OFFSET_STRIDE) + F.col("number")).alias("offset"),
        F.col("pubTime").alias("timestamp"),
    )


def damaged_records(calls: DataFrame) -> DataFrame:
    """Records of which known parts are broken in each way a record can be: too many
    fields, a bad timestamp, no pubTime, and a value that is no envelope."""
    number = F.col("caseId").cast("bigint")
    line = F.col("line")
    lines = call_lines(calls, "caseId", "pubTime", "services_name").withColumn(
        "line",
        F.when(number % 97 == 0, F.concat(F.lit("x,"), line))
        .when(number % 101 == 0, F.replace(line, F.lit("."), F.lit(".9")))
        .when(number % 103 == 0, F.substring(line, len("2024-01-01 00:00:00.000") + 1, 1 << 20))
        .otherwise(line),
    )
    number = (F.col("offset") % F.lit(_OFFSET_STRIDE)).alias("number")
    broken = F.when(number % 107 == 0, F.concat(F.expr("X'FF'"), F.col("value")))
    return _records(lines, "calls").withColumn("value", F.coalesce(broken, F.col("value")))

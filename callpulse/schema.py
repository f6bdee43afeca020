"""Schemas of the call feed, the envelopes and the published figures."""

from pyspark.sql import types as T

# Field order of a call line, and which fields are instants.
CALL_SCHEMA = T.StructType(
    [
        T.StructField("pubTime", T.TimestampType(), False),
        T.StructField("caseId", T.StringType()),
        T.StructField("dt_offered", T.TimestampType()),
        T.StructField("dt_handled", T.TimestampType()),
        T.StructField("dt_offered_service", T.TimestampType()),
        T.StructField("dt_offered_queue", T.TimestampType()),
        T.StructField("dt_start", T.TimestampType()),
        T.StructField("dt_end", T.TimestampType()),
        T.StructField("services_name", T.StringType()),
        T.StructField("ind_forward_service_previous", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("subarea", T.StringType()),
    ]
)
CALL_FIELDS = CALL_SCHEMA.fieldNames()
TIMESTAMP_FIELDS = [
    f.name for f in CALL_SCHEMA.fields if isinstance(f.dataType, T.TimestampType)
]

KEY_ENVELOPE = T.StructType(
    [
        T.StructField(
            "header",
            T.StructType(
                [
                    T.StructField(
                        "identifier",
                        T.StructType(
                            [
                                T.StructField("tenant", T.StringType()),
                                T.StructField("publisher", T.StringType()),
                            ]
                        ),
                    ),
                    T.StructField("retained", T.BooleanType()),
                    T.StructField("qos", T.StringType()),
                ]
            ),
        ),
        T.StructField("key", T.StringType()),
        T.StructField("envelope_ok", T.BooleanType()),
    ]
)

DATA_ENVELOPE = T.StructType(
    [
        T.StructField("binary", T.BinaryType()),
        T.StructField("tracing", T.MapType(T.StringType(), T.StringType())),
        T.StructField("envelope_ok", T.BooleanType()),
    ]
)

# The columns of Spark's Kafka source that a decoded record keeps.
RECORD_METADATA = ["topic", "partition", "offset", "timestamp"]

# Message keys of the four published figures.
AVERAGE_HANDLING_TIME = "average-handling-time"
QUEUERS_AND_CALLERS = "queuers-and-callers"
WAIT_TIME = "wait-time"
QUEUERS_PER_SERVICE = "queuers-per-service"
KPI_KEYS = [
    AVERAGE_HANDLING_TIME,
    QUEUERS_AND_CALLERS,
    WAIT_TIME,
    QUEUERS_PER_SERVICE,
]

# Names and types of the fields of one JSON object in the message of
# each figure (pubTime is epoch ms).
MESSAGE_SCHEMAS = {
    AVERAGE_HANDLING_TIME: "pubTime bigint, avgCallDuration double",
    QUEUERS_AND_CALLERS: "pubTime bigint, queueSize bigint, callsAmt bigint, ratioServed double",
    WAIT_TIME: "pubTime bigint, queueDuration double",
    QUEUERS_PER_SERVICE: "pubTime bigint, serviceName string, amtOfQueuersInService int",
}

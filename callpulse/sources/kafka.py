"""Kafka source and sink.

Needs Spark's own ``spark-sql-kafka-0-10`` package on the classpath. Offsets
live in the query's checkpoint, never in the consumer group, so nothing is
committed automatically and a restarted query goes on where it stopped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class KafkaConnection:
    """Where the brokers are and how to reach them; unset values are left out."""

    bootstrap_servers: str
    security_protocol: str | None = None
    ssl_truststore_location: str | None = None
    ssl_truststore_password: str | None = None
    ssl_keystore_location: str | None = None
    ssl_keystore_password: str | None = None
    ssl_key_password: str | None = None

    def options(self) -> dict[str, str]:
        settings = {
            "bootstrap.servers": self.bootstrap_servers,
            "security.protocol": self.security_protocol,
            "ssl.truststore.location": self.ssl_truststore_location,
            "ssl.truststore.password": self.ssl_truststore_password,
            "ssl.keystore.location": self.ssl_keystore_location,
            "ssl.keystore.password": self.ssl_keystore_password,
            "ssl.key.password": self.ssl_key_password,
        }
        return {f"kafka.{name}": value for name, value in settings.items() if value}


def source_options(
    connection: KafkaConnection,
    topic: str,
    group_id: str | None = None,
    starting_offsets: str = "latest",
    **more: str,
) -> dict[str, str]:
    """Reader options. ``more`` takes those that scale the read, for instance
    ``minPartitions`` and ``maxOffsetsPerTrigger``."""
    options = connection.options()
    options["subscribe"] = topic
    options["startingOffsets"] = starting_offsets
    if group_id:
        options["kafka.group.id"] = group_id
    return {**options, **more}


def sink_options(connection: KafkaConnection, topic: str, **more: str) -> dict[str, str]:
    return {**connection.options(), "topic": topic, **more}


def stream_records(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Enveloped records of a topic, with Kafka's metadata columns."""
    return spark.readStream.format("kafka").options(**options).load()


def read_records(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The same records as a table. A table cannot start at ``latest`` and starts at
    ``earliest`` then; other offsets are kept."""
    if options.get("startingOffsets") == "latest":
        options = {**options, "startingOffsets": "earliest"}
    return spark.read.format("kafka").options(**options).load()


def kafka_sender(options: dict[str, str]):
    """Appends the frames of an outbox, with their headers."""

    def send(frames: DataFrame) -> None:
        frames.select("key", "value", "headers").write.format("kafka").options(**options).save()

    return send


def kafka_received(spark: SparkSession, options: dict[str, str]):
    """What a topic has got, for an outbox: messages with their headers. Bound the read by
    ``startingTimestamp`` among the ``options``, some time before the job was stopped."""

    def received(version: int) -> DataFrame:
        return read_records(spark, {**options, "includeHeaders": "true"})

    return received


def kafka_sink(options: dict[str, str]):
    """Writer of one micro-batch of frames, for the streaming jobs."""

    def write(frames: DataFrame, batch_id: int) -> None:
        frames.select("key", "value").write.format("kafka").options(**options).save()

    return write

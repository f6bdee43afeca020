from types import SimpleNamespace

import pytest

from callpulse.session import CHECKPOINT_DIR, shared_folder
from callpulse.sources.files import stream_files
from callpulse.sources.kafka import (
    KafkaConnection,
    read_records,
    sink_options,
    source_options,
)
from conftest import SMALL

TLS = KafkaConnection(
    "b:9093", "SSL", "/trust.jks", "tp", "/key.jks", "kp", "sp"
)


def test_source_options():
    assert source_options(TLS, "calls", "group", maxOffsetsPerTrigger="10") == {
        "kafka.bootstrap.servers": "b:9093",
        "kafka.security.protocol": "SSL",
        "kafka.ssl.truststore.location": "/trust.jks",
        "kafka.ssl.truststore.password": "tp",
        "kafka.ssl.keystore.location": "/key.jks",
        "kafka.ssl.keystore.password": "kp",
        "kafka.ssl.key.password": "sp",
        "kafka.group.id": "group",
        "subscribe": "calls",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "10",
    }


def test_unset_values_are_left_out():
    assert sink_options(KafkaConnection("b:9092"), "kpis") == {
        "kafka.bootstrap.servers": "b:9092",
        "topic": "kpis",
    }


def session_like(master, **settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: settings.get(name, default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_shared_folder_is_new_each_time_and_under_the_setting():
    cluster = session_like("yarn", **{CHECKPOINT_DIR: "hdfs://shared/state/"})
    first, second = shared_folder(cluster, "x"), shared_folder(cluster, "x")
    assert first.startswith("hdfs://shared/state/x-") and first != second


@pytest.mark.parametrize("master", ["local[2]", "yarn"])
def test_no_session_may_lack_the_shared_folder(master):
    with pytest.raises(ValueError):
        shared_folder(session_like(master), "x")


@pytest.mark.parametrize(
    "asked, used",
    [("latest", "earliest"), ("earliest", "earliest"), ('{"calls":{"0":23}}',) * 2],
)
def test_a_table_of_records_keeps_explicit_offsets(asked, used):
    reader = SimpleNamespace(given={})
    reader.format = lambda name: reader
    reader.options = lambda **options: reader.given.update(options) or reader
    reader.load = lambda: reader
    options = source_options(TLS, "calls", starting_offsets=asked)
    read_records(SimpleNamespace(read=reader), options)
    assert reader.given["startingOffsets"] == used
    assert options["startingOffsets"] == asked


@pytest.mark.parametrize("name", ["events.parquet", "odd [1] {x}*?.parquet"])
@pytest.mark.parametrize("end", ["", "/"])
def test_a_file_or_a_folder_is_streamed_whatever_its_name(spark, tmp_path, name, end):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    (tmp_path / "other").mkdir()
    folder = tmp_path / "folder"
    events.limit(10).coalesce(1).write.parquet(str(folder))
    (part,) = folder.glob("*.parquet")
    one = tmp_path / name
    one.write_bytes(part.read_bytes())
    for path, out in ((one, "one"), (folder, "all")):
        stream = stream_files(spark, f"{path}{end}", events.schema)
        stream.writeStream.format("memory").queryName(out).trigger(availableNow=True).start().awaitTermination()
        assert spark.table(out).count() == 10

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from callpulse.functions import envelope as codec
from callpulse.operators.frames import envelope, frames
from callpulse.operators.records import decode_keys, decode_records


def encoded(spark, key="", value="", tenant="", publisher="", **more):
    keyed = spark.createDataFrame([(key, value)], "key string, value string")
    return envelope(keyed, F.lit(tenant), F.lit(publisher), **more).first()


def decoded(spark, *values):
    df = spark.createDataFrame([(v,) for v in values], "value binary")
    return [tuple(row) for row in decode_records(df).select("line", "tracing", "envelope_ok").collect()]


def test_known_key_bytes(spark):
    row = encoded(spark, key="k0", tenant="acme", publisher="p0")
    assert bytes(row.key).hex().upper() == "0A0C0A0A0A0461636D651202703012026B30"


@pytest.mark.parametrize("tenant", ["", "acme", "é" * 100, "t" * 20_000])
@pytest.mark.parametrize("retained", [False, True])
@pytest.mark.parametrize("qos", ["BEST_EFFORT", "RELIABLE"])
def test_key_bytes_are_what_protobuf_writes(spark, tenant, retained, qos):
    row = encoded(
        spark, key="k" * 200, tenant=tenant, publisher="p", retained=F.lit(retained), qos=F.lit(qos)
    )
    message = codec._message_classes()["Key"](key="k" * 200)
    message.header.identifier.tenant = tenant
    message.header.identifier.publisher = "p"
    message.header.retained = retained
    message.header.qos = codec.QOS_LEVELS[qos]
    assert bytes(row.key) == message.SerializeToString(deterministic=True)


def decoded_keys(spark, *keys):
    df = spark.createDataFrame(list(enumerate(keys)), "i int, key binary")
    return [row.key for row in decode_keys(df).orderBy("i").collect()]


def by_protobuf(raw):
    return codec._key_structs(pa.array([raw], pa.binary())).to_pylist()[0]


def test_key_roundtrip_and_damage(spark):
    good = bytes(encoded(spark, key="k", tenant="t", publisher="p").key)
    cases = [good, b"", None, b"\xff\xff", b"\x12\x01\xff", b"\x0a\x00", b"\x0a\x02\x18\x07"]
    found = decoded_keys(spark, *cases)
    assert found[0].header.identifier.asDict() == {"tenant": "t", "publisher": "p"}
    assert (found[0].header.retained, found[0].header.qos) == (False, "BEST_EFFORT")
    assert (found[1].header, found[1].key, found[1].envelope_ok) == (None, "", True)
    for unreadable in found[2:5]:
        assert (unreadable.header, unreadable.key, unreadable.envelope_ok) == (None, "", False)
    assert found[5].header.identifier is None
    assert found[6].header.qos == "UNRECOGNIZED_7"


def key_variants():
    """Well-formed keys of many sizes, each also damaged at every byte."""
    pick = random.Random(5)
    for size in (1, 2, 5, 60, 119, 120, 123, 124, 127, 128, 200, 16_383, 16_384, 20_000):
        message = codec._message_classes()["Key"](key="k" * pick.choice([0, 1, size]))
        message.header.identifier.tenant = "é" * (size // 2) or "t"
        message.header.identifier.publisher = "p" * pick.choice([0, 1, 3])
        message.header.retained = pick.random() < 0.5
        message.header.qos = pick.choice([0, 1, 2])
        yield message.SerializeToString()
    short = bytes.fromhex("0A0C0A0A0A0461636D651202703012026B30")
    flagged = bytes.fromhex("0A100A0A0A0461636D65120270301001180112026B30")
    for raw in (short, flagged):
        yield raw
        for index in range(len(raw)):
            yield raw[:index]
            for value in (0, 1, 2, 0x0A, 0x12, 0x7F, 0x80, 0xFF):
                yield raw[:index] + bytes([value]) + raw[index + 1 :]
                yield raw[:index] + bytes([value]) + raw[index:]


def test_keys_decode_as_protobuf_does(spark):
    cases = list(key_variants())
    found = decoded_keys(spark, *cases)
    assert len(found) > 500
    for raw, row in zip(cases, found):
        assert row.asDict(recursive=True) == by_protobuf(raw), raw.hex()


def test_plain_keys_do_not_reach_python(spark):
    keyed = spark.createDataFrame(
        [
            (f"k{i}" * size, "", bool(i % 2), "RELIABLE" if i % 3 else "BEST_EFFORT")
            for i, size in enumerate([1, 1, 60, 61, 62, 63, 64, 65, 9_000, 70_000])
        ],
        "key string, value string, retained boolean, qos string",
    )
    tenant, publisher = F.substring("key", 2, 200), F.concat(F.lit("p"), F.col("key"))
    raw = envelope(keyed, tenant, publisher, F.col("retained"), F.col("qos"))
    assert raw.where(codec.plain_key("key").isNull()).isEmpty()
    found = decode_keys(raw).select("key.header.retained", "key.header.qos", "key.key")
    assert sorted(map(tuple, found.collect())) == sorted(
        (row.retained, row.qos, row.key) for row in keyed.collect()
    )


@pytest.mark.parametrize(
    "length", [0, 1, 127, 128, 129, 130, 131, 16_383, 16_384, 16_390, 2_097_151, 2_097_152]
)
def test_data_bytes_and_roundtrip_at_length_borders(spark, length):
    text = "x" * length
    raw = bytes(encoded(spark, value=text).value)
    assert raw == codec._message_classes()["Data"](binary=text.encode()).SerializeToString()
    assert decoded(spark, raw) == [(text, {}, True)]


def test_plain_payloads_do_not_reach_python(spark):
    lengths = [0, 1, 127, 128, 16_383, 16_384, 2_097_151]
    raws = [(bytes(encoded(spark, value="y" * n).value),) for n in lengths]
    df = spark.createDataFrame(raws, "value binary")
    assert df.where(codec.sole_payload("value").isNull()).isEmpty()


def test_envelopes_with_more_than_a_payload(spark):
    data = codec._message_classes()["Data"]
    traced = data(binary=b"hi", tracing={"a": "1", "b": "2"}).SerializeToString()
    plain = data(binary=b"hi").SerializeToString()
    assert decoded(
        spark,
        traced,
        plain + b"\x98\x06\x07",
        b"\x98\x06\x07" + plain,
        plain + data(binary=b"later").SerializeToString(),
        b"\x0a\x82\x00hi",
        b"",
    ) == [
        ("hi", {"a": "1", "b": "2"}, True),
        ("hi", {}, True),
        ("hi", {}, True),
        ("later", {}, True),
        ("hi", {}, True),
        ("", {}, True),
    ]


def data_variants():
    """Random messages of payloads and tracing, put together from parts in any order,
    and short ones damaged at every byte."""
    data, pick = codec._message_classes()["Data"], random.Random(7)

    def text(*sizes):
        return "".join(pick.choice("ab\n\x12é ") for _ in range(pick.choice(sizes)))

    def field(tag, body):
        size, out = len(body), b""
        while size > 127:
            out, size = out + bytes([size & 127 | 128]), size >> 7
        return bytes([tag]) + out + bytes([size]) + body

    for _ in range(300):
        raw = b""
        for _ in range(pick.randrange(6)):
            if pick.random() < 0.4:
                raw += field(0x0A, text(0, 1, 130, 20_000).encode())
            else:
                parts = [field(pick.choice([0x0A, 0x12]), text(0, 1, 2, 140).encode()) for _ in range(pick.randrange(4))]
                raw += field(0x12, b"".join(parts))
        yield raw
    short = data(binary=b"hi", tracing={"a": "1", "bc": ""}).SerializeToString()
    for index in range(len(short)):
        yield short[:index]
        for value in (0, 1, 2, 0x0A, 0x12, 0x7F, 0x80, 0xFF):
            yield short[:index] + bytes([value]) + short[index + 1 :]
            yield short[:index] + bytes([value]) + short[index:]


def test_data_decodes_as_protobuf_does(spark):
    cases = list(data_variants())
    rows = codec._data_structs(pa.array(cases, pa.binary())).to_pylist()
    found = decoded(spark, *cases)
    assert len(found) > 500
    for raw, row, expected in zip(cases, found, rows):
        line = (expected["binary"] or b"").decode(errors="replace")
        if line.isascii():  # of broken UTF-8 the number of replaced bytes may differ
            assert row[0] == line, raw.hex()
        assert row[1:] == (dict(expected["tracing"]), expected["envelope_ok"]), raw.hex()


def test_traced_payloads_do_not_reach_python(spark):
    data = codec._message_classes()["Data"]
    tracing = {f"k{i}": "v" * i for i in range(200)}
    cases = [data(binary=b"x" * n, tracing=tracing).SerializeToString() for n in (0, 1, 200, 70_000)]
    cases += [data(tracing={"": ""}).SerializeToString(), b"", b"\x12\x00", b"\x12\x02\x0a\x00"]
    df = spark.createDataFrame([(c, None) for c in cases], "value binary, payload binary")
    walked = df.select(codec.walked_envelope("value", "payload").alias("w")).collect()
    assert [dict(r.w.tracing) for r in walked[:4]] == [tracing] * 4
    assert all(r.w is not None for r in walked) and [r.w.binary for r in walked[5:]] == [None] * 3


@pytest.mark.parametrize("size", ["ffffffff7f", "ffffffff0f", "8080808008", "ffffff7f"])
def test_sizes_beyond_the_record_are_damage(spark, size):
    raw = bytes.fromhex("0a" + size + "0a0161")
    assert decoded(spark, raw, raw[:1] + raw[1:].replace(b"a", b"b")) == [("", {}, False)] * 2
    for key in (raw, bytes.fromhex("0a0c0a0a0a") + bytes.fromhex(size) + b"acme"):
        (row,) = decoded_keys(spark, key)
        assert row.asDict(recursive=True) == by_protobuf(key)


def test_damaged_data_gives_the_empty_envelope(spark):
    data = codec._message_classes()["Data"]
    long = data(binary=b"z" * 127).SerializeToString()
    cases = [b"\xff\xff", None, b"\x0a", b"\x0a\x05hi", long + b"z", long[:-1]]
    assert decoded(spark, *cases) == [("", {}, False)] * len(cases)


def test_payload_with_broken_utf8_is_replaced(spark):
    raw = codec._message_classes()["Data"](binary=b"a\xff\xffb").SerializeToString()
    assert decoded(spark, raw) == [("a��b", {}, True)]


def test_frames_carry_the_figure_or_a_chosen_publisher(spark):
    messages = spark.createDataFrame([("wait-time", "[]")], "key string, value string")
    for publishers, name in ((None, "wait-time"), ({"wait-time": "other"}, "other")):
        row = frames(messages, "acme", publishers).first()
        message = codec._message_classes()["Key"].FromString(bytes(row.key))
        assert message.header.identifier.publisher == name
        assert (message.key, message.header.identifier.tenant) == ("wait-time", "acme")

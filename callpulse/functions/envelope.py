"""Protobuf envelopes around Kafka keys and values, as column functions.

Wire form (proto3): ``KeyEnvelope {header = 1 {identifier = 1 {tenant = 1,
publisher = 2}, retained = 2, qos = 3}, key = 2}`` and
``DataEnvelope {binary = 1, tracing = 2}``.

Encoding is built-in binary expressions only, written as SQL over column names. A
length stands before the bytes it counts and is named several times, so a nested
message should be a column that is already evaluated; ``operators.frames`` builds
the key envelope so.

Decoding is built-in too for records in the plain form that every publisher of
this feed writes: a payload and nothing else, or a key with its three texts, of
any length. Payloads with tracing are walked field by field, in a fold over the
record. Anything else (unknown fields, damage) goes to protobuf's own parser in an
Arrow UDF.
"""

from __future__ import annotations

import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from callpulse.schema import DATA_ENVELOPE, KEY_ENVELOPE

# Names and numbers of the quality-of-service levels.
QOS_LEVELS = {"BEST_EFFORT": 0, "RELIABLE": 1}

# A length takes at most this many varint bytes (binary columns end at 2 GiB).
_MAX_LENGTH_BYTES = 5


def _binary(*values: int) -> str:
    return f"X'{bytes(values).hex().upper()}'"


def _varint(value: str) -> str:
    """The varint of an int: groups of seven bits, least significant first, of which all
    but the last have the high bit set.

    Each group is looked up in the bytes from 0 to 255, which takes little code: a stage
    whose method is too long is not compiled by the JVM, and takes several times as long.
    """
    groups = []
    for index in range(_MAX_LENGTH_BYTES):
        place = f"(shiftright({value}, {7 * index}) & 127)"
        if index < _MAX_LENGTH_BYTES - 1:
            place += f" + CASE WHEN {value} < {1 << 7 * index + 7} THEN 1 ELSE 129 END"
        else:
            place += " + 1"
        group = f"substring({_binary(*range(256))}, {place}, 1)"
        groups.append(f"CASE WHEN {value} < {1 << 7 * index} THEN X'' ELSE {group} END" if index else group)
    return f"concat({', '.join(groups)})"


def length_delimited(number: int, body: str) -> str:
    """A field of text, bytes or a nested message, present even when empty."""
    tag = _binary(number << 3 | 2)
    return f"concat({tag}, {_varint(f'octet_length({body})')}, CAST({body} AS BINARY))"


def text_field(number: int, text: str) -> str:
    """A string field; proto3 leaves out the empty string."""
    return f"CASE WHEN {text} <> '' THEN {length_delimited(number, text)} ELSE X'' END"


def flag_field(number: int, flag: str) -> str:
    """A bool field, or an enum field of value 0 or 1; proto3 leaves out 0."""
    return f"CASE WHEN {flag} THEN {_binary(number << 3, 1)} ELSE X'' END"


def encode_data(text: str) -> Column:
    """Data envelope bytes around UTF-8 text. An empty payload is still present."""
    return F.expr(length_delimited(1, text))


def _message_classes() -> dict:
    """Message classes of the two envelopes."""
    try:
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
    except ImportError as missing:
        raise ImportError(
            "decoding enveloped records needs the 'protobuf' Python package"
        ) from missing

    field_type = descriptor_pb2.FieldDescriptorProto
    # Names, numbers and types of the envelopes' fields.
    file = descriptor_pb2.FileDescriptorProto(
        name="callpulse_envelope.proto", package="callpulse", syntax="proto3"
    )

    def add(message, name, number, kind, type_name=None, repeated=False):
        label = field_type.LABEL_REPEATED if repeated else field_type.LABEL_OPTIONAL
        field = message.field.add(name=name, number=number, type=kind, label=label)
        if type_name:
            field.type_name = f".callpulse.{type_name}"
        return field

    qos = file.enum_type.add(name="QoS")
    for level, number in QOS_LEVELS.items():
        qos.value.add(name=level, number=number)
    identity = file.message_type.add(name="Identity")
    add(identity, "tenant", 1, field_type.TYPE_STRING)
    add(identity, "publisher", 2, field_type.TYPE_STRING)
    header = file.message_type.add(name="Header")
    add(header, "identifier", 1, field_type.TYPE_MESSAGE, "Identity")
    add(header, "retained", 2, field_type.TYPE_BOOL)
    add(header, "qos", 3, field_type.TYPE_ENUM, "QoS")
    key = file.message_type.add(name="Key")
    add(key, "header", 1, field_type.TYPE_MESSAGE, "Header")
    add(key, "key", 2, field_type.TYPE_STRING)
    data = file.message_type.add(name="Data")
    entry = data.nested_type.add(name="TracingEntry")
    entry.options.map_entry = True
    add(entry, "key", 1, field_type.TYPE_STRING)
    add(entry, "value", 2, field_type.TYPE_STRING)
    data.oneof_decl.add(name="payload")
    add(data, "binary", 1, field_type.TYPE_BYTES).oneof_index = 0
    add(data, "tracing", 2, field_type.TYPE_MESSAGE, "Data.TracingEntry", repeated=True)

    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return {
        name: message_factory.GetMessageClass(
            pool.FindMessageTypeByName(f"callpulse.{name}")
        )
        for name in ("Key", "Data")
    }


def _parse_all(name: str, values: pa.Array) -> tuple[list, list[bool]]:
    """Messages, and which were readable; unreadable bytes give the empty one."""
    from google.protobuf.message import DecodeError

    message_class = _message_classes()[name]
    messages, readable = [], []
    for raw in values.to_pylist():
        try:
            messages.append(message_class.FromString(raw))
            readable.append(True)
        except DecodeError:
            messages.append(message_class())
            readable.append(False)
    return messages, readable


def _struct(columns: dict[str, pa.Array], present: list[bool] | None = None) -> pa.Array:
    mask = None if present is None else pa.array([not here for here in present])
    return pa.StructArray.from_arrays(list(columns.values()), list(columns), mask=mask)


def _key_structs(values: pa.Array) -> pa.Array:
    messages, readable = _parse_all("Key", values)
    headers = [message.header for message in messages]
    identifiers = [header.identifier for header in headers]
    qos_names = {number: name for name, number in QOS_LEVELS.items()}
    qos = [qos_names.get(header.qos, f"UNRECOGNIZED_{header.qos}") for header in headers]
    identifier = _struct(
        {
            "tenant": pa.array([i.tenant for i in identifiers], pa.string()),
            "publisher": pa.array([i.publisher for i in identifiers], pa.string()),
        },
        [header.HasField("identifier") for header in headers],
    )
    header = _struct(
        {
            "identifier": identifier,
            "retained": pa.array([h.retained for h in headers], pa.bool_()),
            "qos": pa.array(qos, pa.string()),
        },
        [message.HasField("header") for message in messages],
    )
    return _struct(
        {
            "header": header,
            "key": pa.array([message.key for message in messages], pa.string()),
            "envelope_ok": pa.array(readable, pa.bool_()),
        }
    )


def _data_structs(values: pa.Array) -> pa.Array:
    rows = [
        {
            "binary": message.binary if message.HasField("binary") else None,
            "tracing": list(message.tracing.items()),
            "envelope_ok": ok,
        }
        for message, ok in zip(*_parse_all("Data", values))
    ]
    return pa.array(rows, type=to_arrow_type(DATA_ENVELOPE))


def _only_present(values: pa.Array, structs, schema) -> pa.Array:
    """``structs`` of the bytes that are there; a null stays null."""
    if values.null_count == len(values):
        return pa.nulls(len(values), to_arrow_type(schema))
    if values.null_count == 0:
        return structs(values)
    present = values.is_valid()
    position = pc.subtract(pc.cumulative_sum(present.cast(pa.int32())), 1)
    return structs(values.drop_null()).take(pc.if_else(present, position, None))


def _parse_keys(values: pa.Array) -> pa.Array:
    return _only_present(values, _key_structs, KEY_ENVELOPE)


def _parse_data(values: pa.Array) -> pa.Array:
    return _only_present(values, _data_structs, DATA_ENVELOPE)


# The parsers travel to the executors with the query, so that a cluster needs
# pyarrow and protobuf there but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _let(name: str, value: str, body: str) -> str:
    """``body``, in which ``name`` stands for ``value``, evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _varint_at(value: str, position: str) -> str:
    """The number written at ``position`` (``n``) and where it ends (``next``); null
    unless it takes one to five bytes, no more than it needs, and is no more than
    there are bytes in all. Nearly all take one byte, which is read by itself."""
    byte = f"substring({value}, {position}, 1)"
    five = f"CAST(conv(rpad(hex(substring({value}, {position}, 5)), 10, '0'), 16, 10) AS BIGINT)"
    cases = []
    for count in range(2, _MAX_LENGTH_BYTES + 1):
        shifts = [8 * (_MAX_LENGTH_BYTES - 1 - index) for index in range(count)]
        groups = [
            f"shiftleft(shiftright(x, {shift}) & 127, {7 * index})"
            for index, shift in enumerate(shifts)
        ]
        number = " | ".join(groups)
        needed = f"shiftright(x, {shifts[-1]}) & 127 > 0 AND ({number}) <= octet_length({value})"
        ends = f"x & {128 << shifts[-1]} = 0"
        cases.append(
            f"WHEN {ends} AND {needed} THEN named_struct("
            f"'n', {number}, 'next', CAST({position} AS INT) + {count})"
        )
        cases.append(f"WHEN {ends} THEN NULL")
    return f"""CASE WHEN {byte} < X'80' THEN named_struct(
      'n', CAST(ascii(CAST({byte} AS STRING)) AS BIGINT), 'next', CAST({position} AS INT) + 1)
      ELSE {_let("x", five, f"CASE {' '.join(cases)} END")} END"""


def plain_key(value: str) -> Column:
    """The decoded key envelope if it is in the form ``operators.frames`` writes.

    That is: all three texts are there, of whatever length, and nothing is
    repeated, out of order or unknown. Anything else gives null. Each size is read
    where the one before it ends.
    """
    identity_end, header_end = "(i.next + int(i.n))", "(h.next + int(h.n))"
    tenant_end, publisher_end = "(t.next + int(t.n))", "(p.next + int(p.n))"
    tenant = f"substring({value}, t.next, int(t.n))"
    publisher = f"substring({value}, p.next, int(p.n))"
    key = f"substring({value}, k.next, int(k.n))"
    flags = f"substring({value}, {identity_end}, {header_end} - {identity_end})"

    tags = {"1": "0A", "h.next": "0A", "i.next": "0A", tenant_end: "12", header_end: "12"}
    conditions = [f"substring({value}, {at}, 1) = X'{tag}'" for at, tag in tags.items()]
    conditions += [f"{size}.n > 0" for size in "tpk"]
    conditions += [
        f"{publisher_end} = {identity_end}",
        f"{header_end} - {identity_end} IN (0, 2, 4)",
        f"{flags} IN (X'', X'1001', X'1801', X'10011801')",
        f"k.next + k.n = octet_length({value}) + 1",
    ]
    conditions += [
        f"is_valid_utf8(CAST({text} AS STRING))" for text in (tenant, publisher, key)
    ]
    decoded = f"""CASE WHEN {' AND '.join(conditions)} THEN named_struct(
      'header', named_struct(
        'identifier', named_struct(
          'tenant', CAST({tenant} AS STRING), 'publisher', CAST({publisher} AS STRING)),
        'retained', {flags} IN (X'1001', X'10011801'),
        'qos', CASE WHEN {flags} IN (X'1801', X'10011801') THEN 'RELIABLE'
                    ELSE 'BEST_EFFORT' END),
      'key', CAST({key} AS STRING),
      'envelope_ok', true) END"""
    places = {"h": "2", "i": "h.next + 1", "t": "i.next + 1"}
    places |= {"p": f"{tenant_end} + 1", "k": f"{header_end} + 1"}
    for name, place in reversed(places.items()):
        decoded = _let(name, _varint_at(value, place), decoded)
    return F.expr(decoded)


def key_envelope(value: str, plain: str) -> Column:
    """The decoded envelope in ``value``, given its ``plain_key``."""
    other = F.expr(f"CASE WHEN {plain} IS NULL THEN {value} END")
    empty = F.struct(
        F.lit(None).cast(KEY_ENVELOPE["header"].dataType).alias("header"),
        F.lit("").alias("key"),
        F.lit(False).alias("envelope_ok"),
    )
    return F.coalesce(plain, F.arrow_udf(_parse_keys, KEY_ENVELOPE)(other), empty)


def sole_payload(value: str) -> Column:
    """The payload of an envelope that holds nothing else, or null.

    The size of the record alone says how many bytes the payload's length must
    take, so the record is compared with the one prefix it can start with.
    """
    size = f"octet_length({value})"
    cases = [
        f"WHEN {size} < {(1 << 7 * count) + 1 + count} THEN {1 + count}"
        for count in range(1, _MAX_LENGTH_BYTES)
    ]
    taken = f"CASE {' '.join(cases)} ELSE {1 + _MAX_LENGTH_BYTES} END"
    prefix = f"concat(X'0A', {_varint(f'({size} - ({taken}))')})"
    return F.expr(
        f"""CASE WHEN {size} >= 2 AND substring({value}, 1, {taken}) = {prefix}
                 THEN substring({value}, 1 + {taken}) END"""
    )


def walked_envelope(value: str, payload: str) -> Column:
    """The decoded envelope of a record that holds payloads and tracing entries only,
    repeated and in any order; null if there is a ``sole_payload`` or anything else.

    Each step of the fold reads one field at ``at``: of the envelope, or of the tracing
    entry that ends before ``until``. A field begins with one of two tags, so the bytes
    equal to these are as many steps as there can be; those left over do nothing.
    """
    entries = "array<struct<key:string,value:string>>"
    size = f"octet_length({value})"
    latin = f"decode({value}, 'ISO-8859-1')"
    tags = f"{size} - length(translate({latin}, concat(chr(10), chr(18)), ''))"
    body = f"substring({value}, h.next, int(h.n))"
    end = "(h.next + int(h.n))"

    def state(at="s.at", until="s.until", key="s.key", text="s.text", binary="s.binary", found="s.found"):
        return (
            f"named_struct('at', {at}, 'until', {until}, 'key', {key}, 'text', {text}, "
            f"'binary', {binary}, 'found', {found})"
        )

    def with_entry(key: str, text: str) -> str:
        return f"concat(s.found, array(named_struct('key', {key}, 'value', {text})))"

    def entry_field(key: str, text: str) -> str:
        more = state(at=end, key=key, text=text)
        done = state(at=end, until="0", found=with_entry(key, text))
        return f"CASE WHEN {end} = s.until THEN {done} ELSE {more} END"

    text = f"CAST({body} AS STRING)"
    step = f"""CASE
      WHEN h IS NULL OR {end} > (CASE WHEN s.until > 0 THEN s.until ELSE {size} + 1 END)
        THEN {state(at="CAST(NULL AS INT)")}
      WHEN s.until = 0 AND tag = X'0A' THEN {state(at=end, binary=body)}
      WHEN s.until = 0 AND tag = X'12' AND h.n = 0
        THEN {state(at="h.next", found=with_entry("''", "''"))}
      WHEN s.until = 0 AND tag = X'12' THEN {state(at="h.next", until=end, key="''", text="''")}
      WHEN tag = X'0A' AND is_valid_utf8({text}) THEN {entry_field(text, "s.text")}
      WHEN tag = X'12' AND is_valid_utf8({text}) THEN {entry_field("s.key", text)}
      ELSE {state(at="CAST(NULL AS INT)")} END"""
    step = _let("h", _varint_at(value, "(s.at + 1)"), step)
    step = _let("tag", f"substring({value}, s.at, 1)", step)
    begin = state("1", "0", "''", "''", "CAST(NULL AS BINARY)", f"CAST(array() AS {entries})")
    # Of entries with one key the last counts.
    last = "filter(s.found, (e, i) -> NOT exists(slice(s.found, i + 2, size(s.found)), f -> f.key = e.key))"
    once = f"""CASE WHEN size(array_distinct(s.found.key)) = size(s.found) THEN s.found ELSE {last} END"""
    return F.expr(
        f"""CASE WHEN {payload} IS NULL THEN aggregate(
          CASE WHEN {tags} > 0 THEN sequence(1, {tags}) ELSE CAST(array() AS array<int>) END,
          {begin},
          (s, i) -> CASE WHEN s.at IS NULL OR s.at > {size} THEN s ELSE {step} END,
          s -> CASE WHEN s.at > {size} THEN named_struct(
            'binary', s.binary, 'tracing', map_from_entries({once}), 'envelope_ok', true) END) END"""
    )


def data_envelope(value: str, payload: str, walked: str) -> Column:
    """The decoded envelope in ``value``, given its ``sole_payload`` and, for records
    without one, its ``walked_envelope``."""
    other = F.expr(f"CASE WHEN {payload} IS NULL AND {walked} IS NULL THEN {value} END")
    return F.when(
        F.col(payload).isNotNull(), _envelope(F.col(payload), True)
    ).otherwise(
        F.coalesce(
            F.col(walked),
            F.arrow_udf(_parse_data, DATA_ENVELOPE)(other),
            _envelope(F.lit(None).cast("binary"), False),
        )
    )


def _envelope(binary: Column, ok: bool) -> Column:
    no_tracing = F.create_map().cast("map<string,string>")
    return F.struct(
        binary.alias("binary"), no_tracing.alias("tracing"), F.lit(ok).alias("envelope_ok")
    )


def payload_text(data: Column) -> Column:
    """Payload as text: bad UTF-8 is replaced, a missing payload is ``''``."""
    text = F.make_valid_utf8(data.getField("binary").cast("string"))
    return F.coalesce(text, F.lit(""))

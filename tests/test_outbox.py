import pytest
from pyspark.sql import functions as F

from callpulse.sources.files import names_in, parquet_sender, read_parts
from callpulse.streaming.outbox import HEADERS, Outbox, message_id

RECEIVED = f"key binary, value binary, headers {HEADERS}"


class Lost(Exception):
    pass


@pytest.fixture
def outbox_of(spark, tmp_path):
    """An outbox into a table of files; ``part`` of a batch is sent before it fails."""

    def build(part=None):
        append = parquet_sender(f"{tmp_path}/received")

        def send(rows):
            append(rows if part is None else rows.where(part))
            if part is not None:
                raise Lost

        received = lambda version: read_parts(spark, f"{tmp_path}/received", RECEIVED)
        return Outbox(spark, str(tmp_path), send, received)

    return build


@pytest.fixture
def frames(spark):
    def build(*values):
        rows = [(b"k", v.encode()) for v in values]
        return spark.createDataFrame(rows, "key binary, value binary").repartition(3)

    return build


@pytest.fixture
def arrived(spark, tmp_path):
    def collect():
        rows = read_parts(spark, f"{tmp_path}/received", RECEIVED).select("value", message_id())
        found = [(bytes(value).decode(), i) for value, i in rows.collect()]
        assert len({i for _, i in found}) == len(found)
        return sorted((i.split(":")[0], value) for value, i in found)

    return collect


def test_each_message_arrives_once_and_equal_ones_too(outbox_of, frames, arrived):
    outbox = outbox_of()
    outbox(frames("a", "a", "b"), 0)
    outbox(frames("a"), 1)
    outbox(frames("a"), 1)  # a batch that is repeated though it was confirmed
    outbox(frames(), 2)
    assert arrived() == [("0", "a"), ("0", "a"), ("0", "b"), ("1", "a")]


@pytest.mark.parametrize("part", ["true", "false", "value < X'63'"])
def test_after_a_failure_the_rest_of_what_was_staged_is_sent(outbox_of, frames, arrived, part):
    with pytest.raises(Lost):
        outbox_of(part)(frames("a", "b", "c", "d"), 7)
    outbox_of()(frames("computed", "otherwise"), 7)
    assert arrived() == [("7", v) for v in "abcd"]


def test_a_failure_while_staging_stages_again(outbox_of, frames, arrived, monkeypatch):
    outbox = outbox_of()
    with monkeypatch.context() as patched:
        patched.setattr(outbox, "_mark", lambda *_: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            outbox(frames("half"), 0)
    outbox(frames("a", "b"), 0)
    assert arrived() == [("0", "a"), ("0", "b")]


def test_what_a_lost_run_left_is_finished_first(outbox_of, frames, arrived):
    with pytest.raises(Lost):
        outbox_of("value = X'61'")(frames("a", "b"), 3)
    outbox_of()(frames("c"), 1_000_000_000)
    assert arrived() == [("1000000000", "c"), ("3", "a"), ("3", "b")]


def test_messages_of_others_are_passed_over(spark, outbox_of, frames, arrived, tmp_path):
    others = [(b"k", b"x", None), (b"k", b"y", []), (b"k", b"z", [("trace", b"7:0")])]
    with pytest.raises(Lost):
        outbox_of("false")(frames("a"), 7)
    spark.createDataFrame(others, RECEIVED).write.mode("append").parquet(f"{tmp_path}/received")
    outbox_of()(frames(), 7)
    rows = spark.read.parquet(f"{tmp_path}/received").where(message_id().isNotNull())
    assert [bytes(r.value) for r in rows.collect()] == [b"a"]


def test_only_the_last_batch_is_kept(spark, outbox_of, frames, tmp_path):
    outbox = outbox_of()
    for batch in range(4):
        outbox(frames("a"), batch)
    parts = [n for n in names_in(spark, f"{tmp_path}/outbox/staged") if n.startswith("batch")]
    assert parts == ["batch_id=3"]
    marks = {n for n in names_in(spark, f"{tmp_path}/outbox/marks") if not n.startswith(".")}
    assert marks == {"staged-3", "begun-3", "confirmed-3"}
    assert outbox.staged(3).select(F.count("*")).first()[0] == 1

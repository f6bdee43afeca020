from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from callpulse.functions.timestamps import format_timestamp, parse_timestamp
from callpulse.operators import records
from callpulse.operators.frames import envelope
from callpulse.schema import CALL_FIELDS

GOOD = (
    "2024-01-01 12:00:00.000,7,2024-01-01 11:58:00.000,,2024-01-01 11:58:05.000,"
    "2024-01-01 11:58:10.000,,2024-01-01 12:30:00.250,sales,0,north,north-1"
)


def lines_of(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "line string")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2018-09-01 10:00:00.123", datetime(2018, 9, 1, 10, 0, 0, 123000)),
        ("2018-09-01 10:00:00.5", None),
        ("2018-09-01 10:00:00.123456", None),
        ("2018-09-01 10:00:00", None),
        ("", None),
        ("2018-13-41 10:00:00.000", None),
        ("2018-02-30 10:00:00.000", None),
        ("2018-09-01 10:00:00.123xyz", None),
        ("2018-09-01T10:00:00.123", None),
        ("2018-09-01 10:00:00.12Z", None),
        (" 2018-09-01 10:00:00.123", None),
        ("2018-09-01 10:00:00.123\n", None),
    ],
)
def test_timestamps_are_strict(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_timestamp(F.col("t"))).first()[0] == expected


@pytest.mark.parametrize("zone", ["UTC", "Europe/Amsterdam", "America/St_Johns"])
@pytest.mark.parametrize(
    "text",
    [
        "2024-07-01 12:00:00.000",
        "2024-03-31 02:30:00.000",
        "2024-10-27 02:30:00.999",
        "1969-12-31 23:59:59.001",
    ],
)
def test_timestamps_do_not_depend_on_the_session(spark, zone, text):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(text,)], "t string")
        parsed = df.select(parse_timestamp(F.col("t")).alias("t"))
        millis, again = parsed.select(F.unix_millis("t"), format_timestamp("t")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    instant = datetime.fromisoformat(text).replace(tzinfo=timezone.utc)
    assert (millis, again) == (round(instant.timestamp() * 1000), text)


def test_good_line_binds_by_position(spark):
    row = records.observations(records.parse_lines(lines_of(spark, GOOD))).first()
    assert row.asDict() == dict(
        zip(
            CALL_FIELDS,
            [
                datetime(2024, 1, 1, 12),
                "7",
                datetime(2024, 1, 1, 11, 58),
                None,
                datetime(2024, 1, 1, 11, 58, 5),
                datetime(2024, 1, 1, 11, 58, 10),
                None,
                datetime(2024, 1, 1, 12, 30, 0, 250000),
                "sales",
                "0",
                "north",
                "north-1",
            ],
        )
    )


@pytest.mark.parametrize(
    "line, reason",
    [
        (GOOD, None),
        ("", "field_count"),
        (None, "field_count"),
        ("x," + GOOD, "field_count"),
        (GOOD.rsplit(",", 1)[0], "field_count"),
        (GOOD.rsplit(",", 1)[0] + ",", None),
        (GOOD.replace("north,", '"north, far",'), "field_count"),
        (GOOD[len("2024-01-01 12:00:00.000") :], "missing_pub_time"),
        (GOOD.replace("00.250", "00.25"), "bad_timestamp"),
        (GOOD.replace("00.250", "00.250000"), "bad_timestamp"),
        (GOOD.replace("2024-01-01 11:58:00", "2024-13-01 11:58:00"), "bad_timestamp"),
    ],
)
def test_quarantine_reasons(spark, line, reason):
    parsed = records.parse_lines(lines_of(spark, line))
    assert parsed.first().reason == reason
    assert records.observations(parsed).count() == (reason is None)
    set_aside = records.quarantined(parsed)
    assert set_aside.columns == ["line", "reason"]
    assert set_aside.count() == (reason is not None)


def test_every_line_is_kept_exactly_once(spark):
    lines = [GOOD, "x," + GOOD, "", GOOD.replace(".250", ".9250")] * 50
    parsed = records.parse_lines(lines_of(spark, *lines))
    assert records.observations(parsed).count() == 50
    assert records.quarantined(parsed).count() == 150


def test_records_keep_metadata_and_flag_bad_envelopes(spark):
    keyed = spark.createDataFrame([("k", GOOD, "calls", 3, 42)], "key string, value string, topic string, partition int, offset bigint")
    good = envelope(keyed, F.lit("t"), F.lit("p"))
    bad = good.withColumn("value", F.expr("X'FFFF'")).withColumn("offset", F.lit(43).cast("bigint"))
    decoded = records.decode_records(good.unionByName(bad))
    found = {row.offset: row for row in decoded.collect()}
    assert (found[42].topic, found[42].partition, found[42].line) == ("calls", 3, GOOD)
    assert found[42].envelope_ok and not found[43].envelope_ok
    assert found[43].line == ""
    reasons = records.parse_lines(decoded.select("offset", "line", "envelope_ok"))
    assert {row.offset: row.reason for row in reasons.collect()} == {
        42: None,
        43: "bad_envelope",
    }
    keys = records.decode_record_keys(good).first()
    assert (keys.key, keys.tenant, keys.publisher) == ("k", "t", "p")


def test_parsed_fields_are_evaluated_once(spark):
    observed = records.observations(records.parse_lines(lines_of(spark, GOOD)))
    plan = observed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("RLIKE") == 7
    assert plan.count("split(") == 1

"""What a batch of the publishing job keeps, and how its feed is made."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from callpulse.operators.records import decode_records, observations, parse_lines, quarantined
from callpulse.operators import kpis
from callpulse.plans import queries
from callpulse.plans.fixtures import call_records
from callpulse.streaming import jobs


def feed(calls_of, copies=50):
    rows = [{"pubTime": 5 * (n % 3), "dt_offered": 0, "caseId": str(n)} for n in range(12)]
    good = call_records(calls_of(*rows))
    many = good.crossJoin(good.sparkSession.range(copies).select(F.col("id").alias("copy")))
    number = F.col("offset") % 12
    damaged = F.when((number == 5) & (F.col("copy") < 2), F.expr("X'FF'")).otherwise(F.col("value"))
    return many.withColumn("value", damaged).drop("copy")


def test_a_batch_keeps_groups_and_bad_records_not_its_feed(spark, calls_of, rows):
    parsed = parse_lines(decode_records(feed(calls_of)))
    reduced = jobs._reduced(parsed)
    bad, groups = quarantined(parsed), kpis.service_measures(observations(parsed, "topic", "partition"), "topic", "partition", "pubTime")
    assert reduced.count() == bad.distinct().count() + groups.count() < parsed.count() / 10
    assert bad.count() > bad.distinct().count() > 0
    assert rows(jobs._set_aside(reduced).select(bad.columns)) == rows(bad)


def test_the_stages_that_write_and_read_records_are_short_enough_for_the_compiler(spark):
    records = call_records(queries.calls(spark, "/root/testdata/sf0.001"))
    for df in (records, decode_records(records)):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            df.explain("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
        assert sizes and max(sizes) < 8000  # the JVM's limit


def test_a_feed_is_made_by_many_tasks(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(queries, "DEALT", 10)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(95)
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    dealt = queries._dealt_calls(spark, str(tmp_path))
    assert dealt.rdd.getNumPartitions() == 10
    assert rows(dealt) == rows(queries.calls(spark, str(tmp_path)))

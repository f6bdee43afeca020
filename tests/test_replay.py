import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from callpulse.operators import kpis
from callpulse.plans.fixtures import call_records
from callpulse.sources.files import parquet_sink, stream_files
from callpulse.streaming import jobs
from callpulse.streaming.ledger import Ledger

SCHEMA = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"


@pytest.fixture
def good(calls_of):
    rows = [{"pubTime": 5 * (n % 3), "dt_offered": 0, "dt_start": n % 7, "caseId": str(n)} for n in range(24)]
    return call_records(calls_of(*rows)).select(*[f.split()[0] for f in SCHEMA.split(", ")])


def is_bad():
    return F.col("offset") % 4 == 1


@pytest.fixture
def job(spark, tmp_path, good):
    """Delivers records and repairs and runs the job; it has read the feed, a quarter of
    it damaged, once it is made."""
    given = {"topic": 0, "repairs": 0}

    def deliver(name, rows):
        rows.select(*good.columns).coalesce(1).write.parquet(f"{tmp_path}/{name}/{given[name]}")
        given[name] += 1

    def run(repairs=None, records=None, publish=None):
        for name, rows in (("topic", records), ("repairs", repairs)):
            if rows is not None:
                deliver(name, rows)
        streams = [
            stream_files(spark, f"{tmp_path}/{name}", good.schema, recursiveFileLookup="true")
            for name in given
        ]
        jobs.publish_figures(
            streams[0],
            publish or parquet_sink(f"{tmp_path}/published"),
            parquet_sink(f"{tmp_path}/quarantine"),
            str(tmp_path),
            "acme",
            available_now=True,
            repairs=streams[1],
        ).awaitTermination()
        return Ledger(spark, str(tmp_path))

    (tmp_path / "repairs").mkdir()
    run(records=good.withColumn("value", F.when(is_bad(), F.expr("X'FF'")).otherwise(F.col("value"))))
    return run


def used(spark, folder):
    return jobs.stored_measures(spark, str(folder)).agg(F.sum("calls")).first()[0] or 0


def figures(spark, folder):
    return sorted(map(tuple, kpis.figures_of(jobs.stored_measures(spark, str(folder))).collect()))


def whole(good):
    from callpulse.operators.records import call_observations

    return sorted(map(tuple, kpis.figures_of(kpis.service_measures(call_observations(good))).collect()))


def test_repairs_are_used_once(spark, job, good, tmp_path):
    bad = good.where(is_bad()).count()
    assert 0 < bad < 24 and used(spark, tmp_path) == 24 - bad
    for _ in range(2):  # the whole feed as repairs, and again
        ledger = job(repairs=good)
        assert figures(spark, tmp_path) == whole(good)
        assert ledger.outstanding().count() == 0
    read = ledger.read().agg(F.sum("records")).first()[0]
    assert read == used(spark, tmp_path) == 24
    assert spark.read.parquet(f"{tmp_path}/quarantine").count() == bad


def test_used_and_outstanding_are_all_that_was_read(spark, job, good, tmp_path):
    some = good.where(is_bad()).limit(2)
    ledger = job(repairs=some.unionByName(some))
    assert ledger.outstanding().count() + used(spark, tmp_path) == 24
    assert ledger.outstanding().count() == good.where(is_bad()).count() - 2


def test_repairs_that_do_not_count(spark, job, good, tmp_path):
    """Of records unknown, without an offset, or unreadable still."""
    before = figures(spark, tmp_path)
    bad = good.where(is_bad())
    job(
        repairs=bad.withColumn("offset", F.col("offset") + 2)
        .unionByName(bad.withColumn("offset", F.lit(None).cast("bigint")))
        .unionByName(bad.withColumn("topic", F.lit("other")))
        .unionByName(bad.withColumn("value", F.expr("X'FF'")))
        .unionByName(bad.withColumn("value", F.lit(None).cast("binary")))
    )
    assert figures(spark, tmp_path) == before
    ledger = job(repairs=good)  # and they stand in the way of none that does
    assert figures(spark, tmp_path) == whole(good) and ledger.outstanding().isEmpty()


def test_a_record_and_its_repair_in_one_batch(spark, job, good, tmp_path):
    later = good.withColumn("offset", F.col("offset") + 10**15)
    job(records=later.withColumn("value", F.expr("X'FF'")), repairs=later)
    assert used(spark, tmp_path) == 24 - good.where(is_bad()).count() + 24


def test_of_two_good_repairs_the_least_counts(spark, job, good, tmp_path):
    bad = good.where(is_bad()).orderBy("offset").limit(1)
    other = good.where(~is_bad()).orderBy("offset").limit(1)
    one, two = bad.first(), other.first()
    swapped = bad.withColumn("value", F.lit(bytes(two.value)))
    job(repairs=bad.unionByName(swapped).unionByName(bad))
    lesser = min(bytes(one.value), bytes(two.value))
    rest = good.where(~is_bad()).unionByName(bad.withColumn("value", F.lit(lesser)))
    assert figures(spark, tmp_path) == whole(rest)


def test_a_batch_of_repairs_is_repeated_without_double(spark, job, good, tmp_path):
    def failing(frames, batch_id):
        raise RuntimeError("lost after storing")

    with pytest.raises(StreamingQueryException):
        job(repairs=good, publish=failing)
    ledger = job()
    assert figures(spark, tmp_path) == whole(good) and ledger.outstanding().isEmpty()


def test_repairs_of_an_unfinished_batch_are_forgotten_with_its_checkpoint(spark, job, good, tmp_path):
    def failing(frames, batch_id):
        raise RuntimeError("lost after storing")

    with pytest.raises(StreamingQueryException):
        job(repairs=good, publish=failing)
    (tmp_path / "checkpoint").rename(tmp_path / "lost")
    ledger = Ledger(spark, str(tmp_path))
    ledger.begin()
    assert ledger.outstanding().count() == good.where(is_bad()).count()
    assert used(spark, tmp_path) == good.where(~is_bad()).count()

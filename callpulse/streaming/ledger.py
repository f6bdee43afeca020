"""The ledger: which offsets each batch has read, kept beside its measures.

A checkpoint knows where its stream goes on. If it is lost, the ledger knows it too: per
topic and partition the offsets read so far are a set of intervals, one a batch, which
merge by union. A new checkpoint begins a new run of the job. Its batches are numbered
after those of earlier runs, so that they replace none of their parts, and its stream
begins after the offsets of the ledger. The ledger's row is written last in a batch: a
part of an earlier run without one was not finished and is removed when the next run
begins, as its records will be read again.

The source must give the records of a partition in the order of their offsets, as Kafka
does. Gaps, as compaction leaves them, are no matter.

Records that a job has set aside can be sent again, repaired, under their old offsets. The
ledger names the offsets that were set aside and those repaired since, so that a repair is
used once, and one of a record that was good never.

    ledger/batch_id=B             offsets of batch B
    set-aside/batch_id=B          offsets that batch B has set aside
    repaired/batch_id=B           offsets whose repairs batch B has used
    ledger-closed/batch_id=B      intervals of all batches up to B
    ledger-pointers/B             the closed part in force is that of the largest B
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callpulse.sources.files import mark, names_in, remove
from callpulse.streaming.store import MeasureStore, numbers_in

SCHEMA = "topic string, partition int, first bigint, until bigint, records bigint, run bigint"
#: Of these records, how many were used and how many were set aside.
COUNTED = f"{SCHEMA}, used bigint, set_aside bigint"
PLACE = ("topic", "partition", "offset")
PLACES = "topic string, partition int, offset bigint"
#: Numbers of one run; the batches of run r begin at r times this.
RUN = 1_000_000_000


def offsets_read(records: DataFrame) -> list[Column]:
    """What the ledger counts of the records of a group; none without ``offset``."""
    if "offset" not in records.columns:
        return []
    there = F.col("offset").isNotNull()
    good = F.col("reason").isNull() if "reason" in records.columns else F.lit(True)
    return [
        F.min("offset").alias("first"),
        (F.max("offset") + 1).alias("until"),
        F.count("offset").alias("records"),
        F.count_if(there & good).alias("used"),
        F.count_if(there & ~good).alias("set_aside"),
    ]


class Ledger:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.path = f"{folder}/ledger"

    def parts(self) -> list[int]:
        return numbers_in(names_in(self.spark, self.path), "batch_id=")

    def closed_through(self) -> list[int]:
        return numbers_in(names_in(self.spark, f"{self.path}-pointers"))

    def _marked_run(self) -> int | None:
        return max(numbers_in(names_in(self.spark, f"{self.folder}/checkpoint"), "run-"), default=None)

    def begin(self) -> int:
        """The number that this run's batches count from.

        The run is marked in the checkpoint's folder. Without a mark the checkpoint is
        new, and so is the run; what the last run has left unfinished is removed.
        """
        run = self._marked_run()
        if run is None:
            finished = self.closed_through() + self.parts()
            store = MeasureStore(self.spark, self.folder)
            places = [(kind, b) for kind in ("set-aside", "repaired") for b in self._batches(kind)]
            begun = {b // RUN for day in store.open_days() for b in store.open_parts(day)}
            begun |= {b // RUN for _, b in places}
            for left in begun:
                last = max((n for n in finished if n // RUN == left), default=left * RUN - 1)
                store.forget(last + 1, (left + 1) * RUN - 1)
                for kind, batch in places:
                    if last < batch < (left + 1) * RUN:
                        remove(self.spark, f"{self.folder}/{kind}/batch_id={batch}")
            run = max([*(n // RUN for n in finished), *begun], default=-1) + 1
            mark(self.spark, f"{self.folder}/checkpoint/run-{run}")
        return run * RUN

    def write(self, records: DataFrame, number: int) -> None:
        """The offsets of a batch's records, and how many of them were used and set aside
        by their ``reason``, in one pass; of records, or of what ``offsets_read`` has
        counted. A batch without records, or of a source without offsets, has a part
        without rows all the same: it is finished."""
        run = F.lit(number // RUN).cast("bigint").alias("run")
        if {"topic", "partition", "offset"} <= set(records.columns):
            records = records.groupBy("topic", "partition").agg(*offsets_read(records))
        if {"topic", "partition", "first"} <= set(records.columns):
            counts = [F.sum(name).alias(name) for name in ("records", "used", "set_aside")]
            read = (
                records.where("records > 0")
                .groupBy("topic", "partition")
                .agg(F.min("first").alias("first"), F.max("until").alias("until"), *counts)
                .select("topic", "partition", "first", "until", "records", run, "used", "set_aside")
            )
        else:
            read = self.spark.createDataFrame([], COUNTED)
        read.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch_id={number}")

    def _batches(self, kind: str) -> list[int]:
        return numbers_in(names_in(self.spark, f"{self.folder}/{kind}"), "batch_id=")

    def _write_places(self, kind: str, records: DataFrame, number: int) -> None:
        """The offsets of the records. An attempt before may have left others."""
        path = f"{self.folder}/{kind}/batch_id={number}"
        places = records.where("offset is not null").select(*PLACE)
        if places.isEmpty():
            remove(self.spark, path)
        else:
            places.write.mode("overwrite").parquet(path)

    def _places(self, kind: str, without: int | None = None) -> DataFrame:
        paths = [f"{self.folder}/{kind}/batch_id={b}" for b in self._batches(kind) if b != without]
        if not paths:
            return self.spark.createDataFrame([], PLACES)
        return self.spark.read.schema(PLACES).parquet(*paths)

    def write_set_aside(self, records: DataFrame, number: int) -> None:
        self._write_places("set-aside", records, number)

    def write_repaired(self, records: DataFrame, number: int) -> None:
        self._write_places("repaired", records, number)

    def outstanding(self, without: int | None = None) -> DataFrame:
        """The offsets that are set aside and not yet repaired; ``without`` the repairs of
        a batch, for that batch itself when it is repeated."""
        repaired = self._places("repaired", without)
        return self._places("set-aside").distinct().join(repaired, list(PLACE), "left_anti")

    def _rows(self, through: int | None = None) -> DataFrame:
        """The rows of the closed part, and of batches after it, up to ``through``."""
        last = max(self.closed_through(), default=-1)
        paths = [f"{self.path}-closed/batch_id={last}"] if last >= 0 else []
        paths += [
            f"{self.path}/batch_id={b}"
            for b in self.parts()
            if b > last and (through is None or b <= through)
        ]
        if not paths:
            return self.spark.createDataFrame([], COUNTED)
        return self.spark.read.schema(COUNTED).parquet(*paths)

    def read(self, through: int | None = None) -> DataFrame:
        """The intervals: of the closed part, and of batches after it, up to ``through``."""
        return self._rows(through).drop("used", "set_aside")

    def counts(self) -> DataFrame:
        """One row: how many records the finished batches have ``read``, ``used`` and
        ``set_aside``. No record is read again for it, and a batch that was repeated, or
        tasks of which were, counts once."""
        sums = {"read": "records", "used": "used", "set_aside": "set_aside"}
        return self._rows().agg(*(F.coalesce(F.sum(of), F.lit(0)).alias(n) for n, of in sums.items()))

    def _merged(self, through: int | None) -> DataFrame:
        order = Window.partitionBy("topic", "partition", "run").orderBy("first", "until")
        before = F.max("until").over(order.rowsBetween(Window.unboundedPreceding, -1))
        begins = F.when(before.isNull() | (F.col("first") > before), 1).otherwise(0)
        rows = self._rows(through).withColumn("begins", begins)
        island = F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0))
        merged = rows.withColumn("island", island).groupBy("topic", "partition", "run", "island")
        sums = [F.sum(name).alias(name) for name in ("records", "used", "set_aside")]
        return merged.agg(F.min("first").alias("first"), F.max("until").alias("until"), *sums).select(
            "topic", "partition", "first", "until", "records", "run", "used", "set_aside"
        )

    def intervals(self, through: int | None = None) -> DataFrame:
        """As ``read``, with intervals of one run that touch or overlap made one. The
        number of batches, not of records, bounds them."""
        return self._merged(through).drop("used", "set_aside")

    def compact(self, through: int) -> None:
        """Merges the intervals of all batches up to ``through``, which are finished, and
        clears away what an earlier compaction has superseded."""
        before = self.closed_through()
        last = max(before, default=-1)
        for batch in self.parts():
            if batch <= last:
                remove(self.spark, f"{self.path}/batch_id={batch}")
        for batch in before[:-1]:
            remove(self.spark, f"{self.path}-pointers/{batch}")
            remove(self.spark, f"{self.path}-closed/batch_id={batch}")
        if any(last < batch <= through for batch in self.parts()):
            closed = f"{self.path}-closed/batch_id={through}"
            self._merged(through).coalesce(1).write.mode("overwrite").parquet(closed)
            mark(self.spark, f"{self.path}-pointers/{through}")

    def ends(self) -> list[tuple[str, int, int]]:
        """(topic, partition, until): where each partition goes on after earlier runs.
        There is one for each partition of a topic."""
        rows = self.read()
        run = self._marked_run()
        rows = rows if run is None else rows.where(F.col("run") < run)
        found = rows.groupBy("topic", "partition").agg(F.max("until").alias("until"))
        return sorted(tuple(row) for row in found.collect())

    def starting_offsets(self) -> str | None:
        """``startingOffsets`` for a new checkpoint; None if nothing was read yet.

        A partition that the ledger does not name is new to it; name it as well.
        """
        found: dict[str, dict[str, int]] = {}
        for topic, partition, until in self.ends():
            found.setdefault(topic, {})[str(partition)] = until
        return json.dumps(found, sort_keys=True) if found else None

    def unread(self, records: DataFrame) -> DataFrame:
        """The records that no earlier run has read, of a source that has no starting
        offsets of its own. What this run reads itself, its checkpoint knows."""
        schema = "topic string, partition int, until bigint"
        ends = self.spark.createDataFrame(self.ends(), schema)
        found = records.join(F.broadcast(ends), ["topic", "partition"], "left")
        return found.where("until is null or offset >= until").select(records.columns)

"""The store of measures: open parts of batches, and a closed part for each day.

A batch writes its measures as open parts, one for each day of its snapshots. Now and
then the open parts of a day are added up into a closed part of one file, which is
possible at any time because measures are additive. Which closed part of a day is in
force is said by a pointer: an empty file whose name is the number of the last batch
that the closed part holds. It is made after the part is written, so a reader sees the
old part and the open parts after it, or the new part and those after that; both add up
to the same. What a pointer has superseded stays until the next compaction, for readers
that began before it.

    open/day=D/batch_id=B     measures of batch B
    closed/day=D/batch_id=B   measures of all batches up to B
    pointers/day=D/B          the closed part in force is that of the largest B

Folders are found by listing those of the days that are read, never the whole store, so
what a batch reads does not grow with the age of the store.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

from callpulse.operators.kpis import MEASURES, merged_measures
from callpulse.sources.files import mark, names_in, remove, utc_day

SCHEMA = StructType(
    [
        StructField("pubTime", TimestampType()),
        StructField("services_name", StringType()),
        *(StructField(name, LongType()) for name in MEASURES),
        StructField("day", IntegerType()),
        StructField("batch_id", LongType()),
    ]
)
#: Parts of a day that tasks write side by side, and rows of one file of a closed day.
SALTS, CLOSED_ROWS = 16, 5_000_000


def numbers_in(names: Iterable[str], prefix: str = "") -> list[int]:
    """The numbers in names like ``batch_id=7``, in order; other files are passed over."""
    ends = (name.removeprefix(prefix) for name in names if name.startswith(prefix))
    return sorted(int(end) for end in ends if end.lstrip("-").isdigit())


class MeasureStore:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, f"{folder}/measures"

    def write(self, measures: DataFrame, batch_id: int) -> None:
        """The measures of a batch; written again, they replace the first attempt's."""
        dated = measures.select(
            "pubTime", "services_name", *(F.col(m).cast("long").alias(m) for m in MEASURES),
            utc_day("pubTime").alias("day"), F.lit(batch_id).cast("long").alias("batch_id"),
        )
        # Few files for each day, and many tasks for one day of many rows.
        salt = F.pmod(F.xxhash64("pubTime", "services_name"), F.lit(SALTS))
        (
            dated.repartition("day", salt)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "batch_id")
            .parquet(f"{self.folder}/open")
        )

    def open_parts(self, day: int) -> list[int]:
        return numbers_in(names_in(self.spark, f"{self.folder}/open/day={day}"), "batch_id=")

    def closed_through(self, day: int) -> list[int]:
        """The last batches of the day's closed parts; that in force is the last one."""
        return numbers_in(names_in(self.spark, f"{self.folder}/pointers/day={day}"))

    def open_days(self) -> list[int]:
        """The days that have open parts: those since the last compactions, not all."""
        return numbers_in(names_in(self.spark, f"{self.folder}/open"), "day=")

    def days(self) -> list[int]:
        """All days that the store has."""
        closed = numbers_in(names_in(self.spark, f"{self.folder}/pointers"), "day=")
        return sorted({*closed, *self.open_days()})

    def _parts(self, days: Iterable[int]) -> dict[str, list[str]]:
        """The folders in force, by kind."""
        parts: dict[str, list[str]] = {"open": [], "closed": []}
        for day in days:
            # The pointers first: parts it has superseded may go after it is read.
            last = max(self.closed_through(day), default=-1)
            if last >= 0:
                parts["closed"].append(f"day={day}/batch_id={last}")
            parts["open"] += [f"day={day}/batch_id={b}" for b in self.open_parts(day) if b > last]
        return parts

    def read(self, days: Iterable[int] | None = None) -> DataFrame:
        """Measures per snapshot, service and part, with ``day`` and ``batch_id``; of the
        given days only, of all without."""
        tables = []
        for kind, parts in self._parts(self.days() if days is None else days).items():
            if parts:
                root = f"{self.folder}/{kind}"
                reader = self.spark.read.schema(SCHEMA).option("basePath", root)
                tables.append(reader.parquet(*(f"{root}/{part}" for part in parts)))
        return reduce(DataFrame.union, tables) if tables else self.spark.createDataFrame([], SCHEMA)

    def compact(self, through: int) -> list[int]:
        """Closes the days that have open parts, with all batches up to ``through``, and
        clears away what an earlier compaction has superseded. Gives the days closed.

        ``through`` is the last finished batch: a later one may be written again.
        """
        closed = []
        for day in self.open_days():
            before = max(self.closed_through(day), default=-1)
            self._clear(day, before)
            fresh = [b for b in self.open_parts(day) if before < b <= through]
            if fresh:
                self._close(day, fresh[-1])
                closed.append(day)
        return closed

    def _close(self, day: int, last: int) -> None:
        """The day's closed part for all batches up to ``last``."""
        own = self.read([day]).where(F.col("batch_id") <= last)
        files = -(-own.count() // CLOSED_ROWS)
        whole = own.groupBy("pubTime", "services_name").agg(*merged_measures())
        whole.coalesce(max(1, files)).write.mode("overwrite").parquet(
            f"{self.folder}/closed/day={day}/batch_id={last}"
        )
        mark(self.spark, f"{self.folder}/pointers/day={day}/{last}")

    def _clear(self, day: int, last: int) -> None:
        for batch in self.open_parts(day):
            if batch <= last:
                remove(self.spark, f"{self.folder}/open/day={day}/batch_id={batch}")
        if not self.open_parts(day):
            remove(self.spark, f"{self.folder}/open/day={day}")
        for batch in self.closed_through(day):
            if batch < last:
                remove(self.spark, f"{self.folder}/pointers/day={day}/{batch}")
                remove(self.spark, f"{self.folder}/closed/day={day}/batch_id={batch}")

    def forget(self, first: int, last: int) -> None:
        """Removes the open parts of batches ``first`` to ``last``: they were not finished."""
        for day in self.open_days():
            for batch in self.open_parts(day):
                if first <= batch <= last:
                    remove(self.spark, f"{self.folder}/open/day={day}/batch_id={batch}")

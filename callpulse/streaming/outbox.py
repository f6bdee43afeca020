"""The outbox: messages that reach a receiver once, whatever fails on the way.

A sink that is sent a batch again after a failure has its messages twice. The outbox
sends in steps that each leave a mark, an empty file that is there or is not:

1. A batch's messages are written and numbered, then marked as staged. Staged messages
   stay as they are: a repeated batch sends those, whatever it would compute now.
2. Sending is marked as begun, the messages are sent, and the batch is confirmed.

A batch that is confirmed is not sent again. One that was begun and not confirmed may
have arrived in whole, in part or not at all; then the receiver is asked which of its
messages it has, and the others are sent. Each message carries its identity, the batch
number as version and its own number, in a header that Kafka and files both keep.

A batch that is left unconfirmed by a run whose checkpoint was lost is finished before
the next one is staged. Of confirmed batches only the last is kept, as no other can be
repeated. The receiver must show what it has been sent, and one outbox at a time sends.

    outbox/staged/batch_id=B          messages of batch B
    outbox/marks/staged-B, begun-B, confirmed-B
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callpulse.sources.files import mark, names_in, remove
from callpulse.streaming.store import numbers_in

IDENTITY = "message-id"
HEADERS = "array<struct<key: string, value: binary>>"
FRAME = f"key binary, value binary, headers {HEADERS}, version bigint, number bigint"


def message_id(headers: str = "headers") -> Column:
    """``version:number`` as the message carries it; null if it carries none."""
    own = F.filter(headers, lambda h: h["key"] == IDENTITY)
    return F.get(own, F.lit(0))["value"].cast("string")


class Outbox:
    """A writer of micro-batches of frames, for ``publish_figures``.

    ``send`` appends frames (key, value, headers) to the receiver. ``received`` gives, for
    a version, messages that the receiver has, with their headers: all of that version,
    and any others. Messages without an identity are passed over.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        send: Callable[[DataFrame], None],
        received: Callable[[int], DataFrame],
    ):
        self.spark, self.folder = spark, f"{folder}/outbox"
        self.send, self.received = send, received

    def __call__(self, frames: DataFrame, batch_id: int) -> None:
        for left in sorted(self._marked("staged") - self._marked("confirmed") - {batch_id}):
            self.deliver(left)
        self.stage(frames, batch_id)
        self.deliver(batch_id)
        self._clear(batch_id)

    def _marked(self, step: str) -> set[int]:
        return set(numbers_in(names_in(self.spark, f"{self.folder}/marks"), f"{step}-"))

    def _mark(self, step: str, batch_id: int) -> None:
        mark(self.spark, f"{self.folder}/marks/{step}-{batch_id}")

    def _part(self, batch_id: int) -> str:
        return f"{self.folder}/staged/batch_id={batch_id}"

    def staged(self, batch_id: int) -> DataFrame:
        return self.spark.read.schema(FRAME).parquet(self._part(batch_id))

    def stage(self, frames: DataFrame, batch_id: int) -> None:
        """Writes the messages of a batch, unless it is staged already."""
        if batch_id in self._marked("staged"):
            return
        # A column of its own, so that the header and the number are made of one value.
        numbered = frames.select(
            "key", "value",
            F.lit(batch_id).cast("bigint").alias("version"),
            F.monotonically_increasing_id().alias("number"),
        )
        identity = F.concat_ws(":", "version", "number").cast("binary")
        header = F.struct(F.lit(IDENTITY).alias("key"), identity.alias("value"))
        whole = numbered.select("key", "value", F.array(header).alias("headers"), "version", "number")
        whole.write.mode("overwrite").parquet(self._part(batch_id))
        self._mark("staged", batch_id)

    def unsent(self, batch_id: int) -> DataFrame:
        """The staged messages that the receiver has not got."""
        staged = self.staged(batch_id)
        if batch_id not in self._marked("begun"):
            return staged
        there = self.received(batch_id).select(message_id().alias("id")).where("id is not null")
        return staged.withColumn("id", message_id()).join(there, "id", "left_anti").drop("id")

    def deliver(self, batch_id: int) -> None:
        """Sends what is not there yet of a staged batch, and confirms it."""
        if batch_id in self._marked("confirmed"):
            return
        left = self.unsent(batch_id)
        self._mark("begun", batch_id)
        self.send(left.select("key", "value", "headers"))
        self._mark("confirmed", batch_id)

    def _clear(self, last: int) -> None:
        """Removes the confirmed batches before ``last``. The mark that confirms goes
        last, so that a batch half cleared away is not sent again."""
        for batch in sorted(self._marked("confirmed") - {last}):
            remove(self.spark, f"{self.folder}/marks/staged-{batch}")
            remove(self.spark, self._part(batch))
            remove(self.spark, f"{self.folder}/marks/begun-{batch}")
            remove(self.spark, f"{self.folder}/marks/confirmed-{batch}")

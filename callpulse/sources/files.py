"""Files in place of Kafka: the same columns, the same jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def located(spark: SparkSession, path: str):
    """The path and its file system, whichever that is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder; nothing if there is no such folder."""
    at, system = located(spark, path)
    return [str(s.getPath().getName()) for s in system.listStatus(at)] if system.exists(at) else []


def mark(spark: SparkSession, path: str) -> None:
    """Makes an empty file, at once or not at all. Its name is what it says."""
    at, system = located(spark, path)
    system.create(at, True).close()


def remove(spark: SparkSession, path: str) -> None:
    at, system = located(spark, path)
    system.delete(at, True)


def make_folder(spark: SparkSession, path: str) -> None:
    at, system = located(spark, path)
    system.mkdirs(at)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Moves a file or folder, if there is one."""
    at, system = located(spark, path)
    if system.exists(at):
        system.rename(at, located(spark, to)[0])


def read_parts(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A table of ``parquet_sink``, which has no folder until a row was written."""
    if names_in(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def stream_files(
    spark: SparkSession, path: str, schema: StructType, **options: str
) -> DataFrame:
    """Parquet files of a folder, or one file, as a stream.

    How many files one batch takes is the caller's: ``maxFilesPerTrigger`` or
    ``maxBytesPerTrigger``.
    """
    reader = spark.readStream.schema(schema).options(**options)
    hadoop_path, system = located(spark, path)
    if system.getFileStatus(hadoop_path).isDirectory():
        return reader.parquet(str(hadoop_path))
    # The file source takes folders; a filter on names picks the one file.
    name = hadoop_path.getName()
    for sign in "\\[]{}*?":
        name = name.replace(sign, f"\\{sign}")
    return reader.option("pathGlobFilter", name).parquet(str(hadoop_path.getParent()))


def parquet_sink(path: str):
    """Writer of micro-batches into one table, each into its own part of it.

    A batch that is repeated after a failure replaces what its first attempt
    wrote, so the table holds every batch once. Batch numbers are those of one
    checkpoint: keep table and checkpoint in one folder, as the jobs do, so that
    a new checkpoint begins a new table. A batch without rows writes nothing;
    ``read_parts`` reads the table also where none has any.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        if not rows.isEmpty():
            rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def parquet_sender(path: str):
    """Appends the frames of an outbox to one table. A task that fails leaves nothing."""

    def send(frames: DataFrame) -> None:
        frames.write.mode("append").parquet(path)

    return send


def utc_day(instant: str):
    """Days from 1970 to the instant in the named column, in UTC."""
    return F.floor(F.unix_seconds(instant) / 86_400).cast("int")

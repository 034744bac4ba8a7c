"""Sinks: records as JSON values, to files or to Kafka."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskstream.functions.expressions import JSON_WRITE

CHECKPOINT_INTERVAL = "10 seconds"


def json_values(records: DataFrame, key: str | None = None) -> DataFrame:
    """Each record as one JSON `value`, null fields included; no key by default."""
    value = F.to_json(F.struct(*records.columns), JSON_WRITE).alias("value")
    if key is None:
        return records.select(value)
    return records.select(F.col(key).alias("key"), value)


def write_topic(values: DataFrame, topic: str, servers: str) -> None:
    """Append a bounded frame of (key,) value to a Kafka topic."""
    values.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def start_topic_sink(values: DataFrame, topic: str, servers: str, checkpoint: str) -> StreamingQuery:
    return (
        values.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=CHECKPOINT_INTERVAL)
        .start()
    )


def start_file_sink(
    records: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", available_now: bool = False
) -> StreamingQuery:
    """Append-mode records to a folder, each record exactly once."""
    writer = records.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    return _trigger(writer, available_now).start(path)


def start_batch_sink(
    records: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    available_now: bool = False,
) -> StreamingQuery:
    """Hand every micro-batch to `write(frame, batch_id)`, which must replace or
    keep what an earlier attempt of the same batch has written."""
    writer = (
        records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(output_mode)
    )
    return _trigger(writer, available_now).start()


def write_once(frame: DataFrame, folder: str) -> None:
    """Write a folder of Parquet that appears as a whole, and only if it is not there yet.

    Files are written aside, in a folder beside it that Spark's readers skip, and
    moved in one step. So a reader of the parent never sees part of a batch, nor
    a batch twice, wherever a run dies. Needs a file system that moves folders in
    one step, as HDFS and local ones do.
    """
    spark = frame.sparkSession
    paths = spark._jvm.org.apache.hadoop.fs
    target = paths.Path(folder)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target):
        return
    aside = paths.Path(paths.Path(target.getParent(), "_unfinished"), target.getName())
    frame.write.mode("overwrite").parquet(aside.toString())
    if not files.rename(aside, target):
        raise OSError(f"{aside.toString()} could not be moved to {folder}")


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_batch_folder(path: str) -> Callable[[DataFrame, int], None]:
    """A `write` for `start_batch_sink`: one folder per batch, written once."""

    def write(frame: DataFrame, batch_id: int) -> None:
        write_once(frame, f"{path}/batch_id={batch_id}")

    return write


def _trigger(writer, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=CHECKPOINT_INTERVAL)

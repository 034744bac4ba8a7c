"""The repeated results of windows from what ingest lands, with state in tables (`operators.carried`).

The stream is that of ingest's progress, which says up to where batches are whole;
rows are read from the folders of the batches since the last step. There is no
state store, so a query may be stopped and go on with other limits and partitions,
or on a new checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskstream.config import MINUTE, WindowSpec
from riskstream.operators.carried import advance, last_mark
from riskstream.sources.sinks import start_batch_sink
from riskstream.streaming.ingest import LANDED, LANDED_SCHEMA, PROGRESS, PROGRESS_SCHEMA

Landed = Callable[[SparkSession, int, int], DataFrame]


def ingested_batches(spark: SparkSession, root: str, batches_per_step: int | None = None) -> DataFrame:
    """A stream with the numbers of the batches that ingest has landed whole."""
    reader = spark.readStream.schema(f"{PROGRESS_SCHEMA}, batch_id bigint")
    if batches_per_step is not None:
        reader = reader.option("maxFilesPerTrigger", batches_per_step)  # progress is a file per batch
    return reader.parquet(f"{root}/{PROGRESS}").filter("topic IS NULL").select("batch_id")


def landed_batches(root: str) -> Landed:
    """Reads the folders of some batches, and lists no others."""

    def read(spark: SparkSession, first: int, last: int) -> DataFrame:
        folders = [f"{root}/{LANDED}/batch_id={number}" for number in range(first, last + 1)]
        return spark.read.schema(LANDED_SCHEMA).option("basePath", f"{root}/{LANDED}").parquet(*folders)

    return read


def start_emissions(
    batches: DataFrame,
    landed: Landed,
    folder: str,
    out: str,
    checkpoint: str,
    key: Column,
    spec: WindowSpec = MINUTE,
    finish: Callable[[DataFrame], DataFrame] = lambda stats: stats,
    available_now: bool = False,
) -> StreamingQuery:
    """Advance the state in `folder` by the numbers that `batches` streams; results go to a folder per step in `out`.

    A step reads all batches from the last one that the state holds, so none is lost if numbers come out of order
    or again, as they do on a new checkpoint.
    """

    def write(frame: DataFrame, _: int) -> None:
        spark = frame.sparkSession
        last = frame.agg(F.max("batch_id")).first()[0]
        if last is None:
            return
        mark = last_mark(spark, folder, spec)
        first = 0 if mark is None else mark.last_batch + 1
        if first <= last:
            advance(landed(spark, first, last), last, folder, out, key, spec, finish)

    return start_batch_sink(batches, write, checkpoint, available_now=available_now)

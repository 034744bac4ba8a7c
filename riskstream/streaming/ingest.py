"""First stage of the stream job: parse once, write everything that needs no state.

Each micro-batch is parsed, then written as folders under `root`:

- landed/:      good rows in time, with `batch_id` and the `watermark` that held;
- quarantine/:  rejected and late records;
- alerts/:      high-risk alerts, late rows included;
- progress/:    what the batch read per topic and partition (offsets, records, rejected and late ones), and a row
                for the whole batch, without a topic, with the highest event time so far. It is written last,
                so a batch that has progress is whole.

The watermark of a batch is made of earlier batches only, so a retried batch gets
the same one. A folder appears when all of it is written, and is never written
again, so its readers count every row once. Landed rows are a file per RECORDS_PER_TASK
records, so a small batch is one file, which a stream of landed files reads whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskstream.config import DEFAULT_THRESHOLDS, DEFAULT_TOPICS, MINUTE, RiskThresholds, Topics, WindowSpec
from riskstream.operators.alerts import high_risk_alerts
from riskstream.operators.late import events_in_time, is_late, late_events, late_records, watermark_after
from riskstream.operators.parse import parse_transactions, rejected_records, valid_transactions
from riskstream.schemas import TRANSACTION
from riskstream.sources.sinks import start_batch_sink, write_once

LANDED, QUARANTINE, ALERTS, PROGRESS = "landed", "quarantine", "alerts", "progress"

LANDED_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        *[T.StructField(f.name, f.dataType) for f in TRANSACTION.fields],
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("watermark", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
#: Records of a micro-batch per task at most when it is parsed; file splits count compressed bytes.
RECORDS_PER_TASK = 250_000
PROGRESS_SCHEMA = (
    "topic string, partition int, low bigint, high bigint, records bigint, rejected bigint, late bigint, highest bigint, watermark bigint"
)


def batch_progress(parsed: DataFrame, before: Column, spec: WindowSpec = MINUTE) -> DataFrame:
    """What a batch of parsed records holds, per topic and partition and as a whole.

    low and high bound the offsets read, high being the next one to read; highest is the
    greatest event time of good rows, in the whole row that of all batches so far.
    """
    stamped = parsed.withColumn("watermark", watermark_after(before, spec))
    good = F.col("reason").isNull()
    counts = [
        F.count(F.lit(1)).alias("records"),
        F.count_if(~good).alias("rejected"),
        F.count_if(good & is_late(spec)).alias("late"),
        F.max(F.when(good, F.col("eventTime"))).alias("highest"),
        F.first("watermark").alias("watermark"),
    ]
    bounds = [F.min("offset").alias("low"), (F.max("offset") + 1).alias("high")]
    parts = stamped.groupBy("topic", "partition").agg(*bounds, *counts)
    whole = stamped.agg(*counts).withColumns(
        {
            **{name: F.lit(None).cast(kind) for name, kind in (("topic", "string"), ("partition", "int"), ("low", "long"), ("high", "long"))},
            "highest": F.greatest("highest", before),
            "watermark": watermark_after(before, spec),
        }
    )
    return parts.unionByName(whole)


def spread_batch(frame: DataFrame, records_per_task: int = RECORDS_PER_TASK) -> DataFrame:
    """A micro-batch in a partition per core at least, and one per `records_per_task` records."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    wanted = max(cores, -(-frame.count() // records_per_task))
    return frame.repartition(wanted) if frame.rdd.getNumPartitions() < wanted else frame


def start_ingest(
    log: DataFrame,
    root: str,
    checkpoint: str,
    spec: WindowSpec = MINUTE,
    limits: RiskThresholds = DEFAULT_THRESHOLDS,
    topics: Topics = DEFAULT_TOPICS,
    observed_at: int | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the stage on a streaming log; `log` is in Kafka layout."""

    def write(frame: DataFrame, batch_id: int) -> None:
        spark = frame.sparkSession

        def folder(name: str, batch: int = batch_id) -> str:
            return f"{root}/{name}/batch_id={batch}"

        before = F.lit(None).cast("bigint")
        if batch_id > 0:
            last = spark.read.schema(PROGRESS_SCHEMA).parquet(folder(PROGRESS, batch_id - 1)).filter("topic IS NULL").first()
            before = F.lit(last.highest).cast("bigint")
        parsed = parse_transactions(spread_batch(frame)).persist()
        try:
            valid = valid_transactions(parsed).withColumn("watermark", watermark_after(before, spec))
            late = late_records(late_events(valid, spec), observed_at, topics)
            rejected = rejected_records(parsed, observed_at, topics)
            write_once(rejected.unionByName(late), folder(QUARANTINE))
            write_once(high_risk_alerts(valid, limits), folder(ALERTS))
            landed = [f.name for f in LANDED_SCHEMA.fields if f.name != "batch_id"]
            files = max(1, -(-parsed.count() // RECORDS_PER_TASK))
            write_once(events_in_time(valid, spec).select(*landed).coalesce(files), folder(LANDED))
            write_once(batch_progress(parsed, before, spec).coalesce(1), folder(PROGRESS))
        finally:
            parsed.unpersist()

    return start_batch_sink(log, write, checkpoint, available_now=available_now)


def landed_stream(spark: SparkSession, root: str, files_per_batch: int | None = None) -> DataFrame:
    """The landed rows as a stream. Folders are read in the order they were
    written, so no row overtakes an earlier batch."""
    reader = spark.readStream.schema(LANDED_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{root}/{LANDED}")


def landed_table(spark: SparkSession, root: str, name: str = LANDED) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")

"""The whole stream job: ingest, and one query per windowed result over what it lands.

Parsing happens once, in ingest. The windowed queries read the landed rows, each
with its own checkpoint, so one can be stopped, changed or restarted alone. A
query that is started again on its checkpoint goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskstream.config import DEFAULT_THRESHOLDS, DEFAULT_TOPICS, MINUTE, RiskThresholds, Topics, WindowSpec
from riskstream.functions import expressions as E
from riskstream.operators.aggregates import aggregate_records
from riskstream.operators.alerts import anomaly_records, burst_records
from riskstream.operators.parse import read_transactions_leniently
from riskstream.operators.topics import topic_statistics
from riskstream.schemas import AGGREGATE, ALERT, DLQ, SQL_AGGREGATE
from riskstream.sources.logs import from_topics, merge_topics
from riskstream.sources.sinks import json_values, start_batch_sink, start_file_sink, start_topic_sink, write_batch_folder
from riskstream.streaming import windows
from riskstream.streaming.carried import ingested_batches, landed_batches, start_emissions
from riskstream.streaming.exact import exact_emissions, use_disk_state
from riskstream.streaming.ingest import ALERTS, PROGRESS, PROGRESS_SCHEMA, QUARANTINE, landed_stream, start_ingest

EXACT, CARRIED, FINAL, CORRECTIONS = "exact", "carried", "final", "corrections"
MODES = (EXACT, CARRIED, FINAL, CORRECTIONS)


@dataclass(frozen=True)
class RiskJob:
    """Folders and settings of one job.

    mode: "exact" gives a result at the close of a window and one per later row,
    "carried" the same with state in tables instead of a state store, in a folder per
    step, and limits that may change between runs, "final" one result when the allowed lateness is over, "corrections" a new
    result whenever a window changes, in a folder per micro-batch.
    """

    root: str
    spec: WindowSpec = MINUTE
    limits: RiskThresholds = DEFAULT_THRESHOLDS
    topics: Topics = DEFAULT_TOPICS
    mode: str = EXACT
    files_per_batch: int | None = None

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, not {self.mode!r}")

    def _checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def start_ingest(
        self, log: DataFrame, observed_at: int | None = None, available_now: bool = False
    ) -> StreamingQuery:
        return start_ingest(
            merge_topics(log, *self.topics.sources),
            self.root,
            self._checkpoint("ingest"),
            self.spec,
            self.limits,
            self.topics,
            observed_at,
            available_now,
        )

    def progress(self, spark: SparkSession) -> DataFrame:
        """What each ingested batch read: per topic and partition, as the topic numbers them, and in a row
        without topic for the batch. Read from what ingest has landed, so it outlives the run, and a batch
        that is tried again counts once. There must be a first batch."""
        rows = spark.read.schema(f"{PROGRESS_SCHEMA}, batch_id bigint").parquet(f"{self.root}/{PROGRESS}")
        return rows.withColumn("partition", F.expr(f"CAST(partition div {len(self.topics.sources)} AS INT)"))

    def committed_offsets(self, spark: SparkSession) -> DataFrame:
        """topic, partition, offset: the next one to read of each partition, as commits for `topic_statistics`."""
        read = self.progress(spark).filter("topic IS NOT NULL")
        return read.groupBy("topic", "partition").agg(F.max("high").alias("offset"))

    def lag(self, log: DataFrame) -> DataFrame:
        """Statistics of the topics of a log, with what this job has yet to read of them."""
        return topic_statistics(log, self.committed_offsets(log.sparkSession), self.topics)

    def window_results(self, landed: DataFrame) -> dict[str, DataFrame]:
        """Name → streaming frame of each windowed result, but for the mode "carried", whose results come in steps. Landed partitions are unique over the topics."""
        landed = landed.drop("topic")
        if self.mode == CARRIED:
            raise ValueError("start_windows() runs the steps of this mode")
        if self.mode != EXACT:
            return {
                "aggregates": windows.stream_aggregates(landed, self.spec),
                "user_bursts": windows.stream_user_bursts(landed, self.spec, self.limits),
                "merchant_anomalies": windows.stream_merchant_anomalies(landed, self.spec, self.limits),
            }
        return {
            name: finish(exact_emissions(landed, key, self.spec)) for name, (key, finish) in self.emitters().items()
        }

    def emitters(self) -> dict[str, tuple[Column, Callable[[DataFrame], DataFrame]]]:
        """Name → key and records of what windows emit."""
        cause = ("kind", "batch_id", "partition", "offset")
        return {
            "aggregates": (E.aggregate_key(), lambda stats: aggregate_records(stats, *cause)),
            "user_bursts": (F.col("userId"), lambda stats: burst_records(stats, *cause, limits=self.limits)),
            "merchant_anomalies": (
                E.merchant_key(),
                lambda stats: anomaly_records(stats, *cause, limits=self.limits),
            ),
        }

    def start_windows(
        self, spark: SparkSession, available_now: bool = False, only: tuple[str, ...] | None = None
    ) -> dict[str, StreamingQuery]:
        """Start the windowed results, or those named in `only`."""
        if self.mode == CARRIED:
            return {
                name: self._start_carried(spark, name, available_now)
                for name in self.emitters()
                if only is None or name in only
            }
        use_disk_state(spark)
        landed = landed_stream(spark, self.root, self.files_per_batch)
        return {
            name: self._start_result(name, frame, available_now)
            for name, frame in self.window_results(landed).items()
            if only is None or name in only
        }

    def _start_carried(self, spark: SparkSession, name: str, available_now: bool) -> StreamingQuery:
        key, finish = self.emitters()[name]
        return start_emissions(
            ingested_batches(spark, self.root, self.files_per_batch),
            landed_batches(self.root),
            f"{self.root}/state/{name}",
            f"{self.root}/{name}",
            self._checkpoint(name),
            key,
            self.spec,
            finish,
            available_now,
        )

    def _start_result(self, name: str, frame: DataFrame, available_now: bool) -> StreamingQuery:
        folder, checkpoint = f"{self.root}/{name}", self._checkpoint(name)
        if self.mode == CORRECTIONS:
            write = write_batch_folder(folder)
            return start_batch_sink(frame, write, checkpoint, windows.CORRECTIONS, available_now)
        return start_file_sink(frame, folder, checkpoint, available_now=available_now)

    def outputs(self) -> dict[str, tuple[str, T.StructType]]:
        """Folder → topic and record schema of everything the job writes for others."""
        return {
            ALERTS: (self.topics.alerts, ALERT),
            "user_bursts": (self.topics.alerts, ALERT),
            "merchant_anomalies": (self.topics.alerts, ALERT),
            "aggregates": (self.topics.aggregates, AGGREGATE),
            "sql_aggregates": (self.topics.sql_aggregates, SQL_AGGREGATE),
            QUARANTINE: (self.topics.dlq, DLQ),
        }

    def topic_values(self, spark: SparkSession, folder: str) -> DataFrame:
        """The records of an output folder as a stream of JSON values."""
        _, schema = self.outputs()[folder]
        records = spark.readStream.schema(schema).parquet(f"{self.root}/{folder}")
        return json_values(records.select(*schema.fieldNames()))  # without the batch of the folder

    def _has_output(self, spark: SparkSession, folder: str) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    def start_publishing(self, spark: SparkSession, servers: str) -> dict[str, StreamingQuery]:
        """Copy every output that there is to its Kafka topic, at least once.

        The SQL aggregates, say, are there only if their query was started. If a
        copy cannot start, those that did are stopped.
        """
        started: dict[str, StreamingQuery] = {}
        try:
            for folder, (topic, _) in self.outputs().items():
                if self._has_output(spark, folder):
                    started[folder] = start_topic_sink(
                        self.topic_values(spark, folder), topic, servers, self._checkpoint(f"publish-{folder}")
                    )
        except Exception:
            for query in started.values():
                query.stop()
            raise
        return started

    def start_sql_aggregates(self, log: DataFrame, available_now: bool = False) -> StreamingQuery:
        """The SQL aggregate reads the raw topic itself, without checks or lateness."""
        use_disk_state(log.sparkSession)
        raw = read_transactions_leniently(from_topics(log, self.topics.raw))
        return start_file_sink(
            windows.stream_sql_aggregates(raw, self.spec),
            f"{self.root}/sql_aggregates",
            self._checkpoint("sql_aggregates"),
            available_now=available_now,
        )


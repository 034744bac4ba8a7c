"""Sources in the layout of Spark's Kafka source.

Operators take any frame in that layout, so Kafka, a folder of files and a table
are interchangeable. Kafka itself needs the connector package on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.config import DEFAULT_TOPICS, Topics
from riskstream.schemas import LOG


def kafka_options(servers: str, topics: tuple[str, ...], starting: str = "latest", **extra: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        **extra,
    }


def kafka_stream(
    spark: SparkSession, servers: str, topics: tuple[str, ...], starting: str = "latest", **extra: str
) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, topics, starting, **extra)).load()


def kafka_table(spark: SparkSession, servers: str, topics: tuple[str, ...], **extra: str) -> DataFrame:
    """Everything that a topic holds now, from the earliest record."""
    options = kafka_options(servers, topics, "earliest", endingOffsets="latest", **extra)
    return spark.read.format("kafka").options(**options).load()


def transaction_stream(spark: SparkSession, servers: str, topics: Topics = DEFAULT_TOPICS) -> DataFrame:
    """The raw and the replay topic as one stream, from now on."""
    return kafka_stream(spark, servers, topics.sources)


def file_stream(spark: SparkSession, path: str, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """A folder that receives log files; in JSON files, key and value are base64."""
    reader = spark.readStream.schema(LOG).format(fmt)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def file_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(LOG).format(fmt).load(path)


def text_log(texts: DataFrame, topic: str, value: str = "value") -> DataFrame:
    """A frame with partition, offset and a text column in log layout."""
    return texts.select(
        F.lit(topic).alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        (F.col("key").cast("binary") if "key" in texts.columns else F.lit(None).cast("binary")).alias("key"),
        F.encode(F.col(value), "UTF-8").alias("value"),
    )


def merge_topics(log: DataFrame, *topics: str) -> DataFrame:
    """Several topics as one log, with partition numbers that are unique over the
    topics: number p of the i-th of n topics becomes p * n + i."""
    index = F.array_position(F.array(*[F.lit(name) for name in topics]), F.col("topic")) - 1
    return from_topics(log, *topics).withColumn("partition", (F.col("partition") * len(topics) + index).cast("int"))


def from_topics(log: DataFrame, *topics: str) -> DataFrame:
    return log.filter(F.col("topic").isin(*topics))

"""Volume, lag and newest records of topics, from tables in log layout.

Offsets of one partition are dense in an uncompacted log, so `high - low` is its
number of records. The frames of bounds have one row per partition.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream import config as cfg
from riskstream.config import DEFAULT_TOPICS, Topics


def topic_names(log: DataFrame) -> DataFrame:
    return log.select("topic").distinct().orderBy("topic")


def partition_bounds(log: DataFrame) -> DataFrame:
    return log.groupBy("topic", "partition").agg(
        F.min("offset").alias("low"), (F.max("offset") + 1).alias("high")
    )


def topic_statistics(log: DataFrame, committed: DataFrame, topics: Topics = DEFAULT_TOPICS) -> DataFrame:
    """One row per topic and partition: availability, bounds, messages, and lag
    where a commit (topic, partition, offset) exists. A topic of the list that has
    no records gives one row that is not available."""
    wanted = log.sparkSession.createDataFrame([(name,) for name in topics.all], "topic string")
    commits = committed.filter("offset >= 0").select("topic", "partition", F.col("offset").alias("committed"))
    known = partition_bounds(log).join(commits, ["topic", "partition"], "left")
    return (
        wanted.join(known, "topic", "left")
        .select(
            "topic",
            "partition",
            F.when(F.col("high").isNotNull(), 1).otherwise(0).alias("available"),
            F.when(F.col("high").isNotNull(), F.greatest(F.col("high") - F.col("low"), F.lit(0))).alias("messages"),
            F.col("high").alias("logEndOffset"),
            F.when(F.col("committed").isNotNull(), F.greatest(F.col("high") - F.col("committed"), F.lit(0))).alias(
                "lag"
            ),
        )
    )


def topic_totals(statistics: DataFrame) -> DataFrame:
    """Messages and lag per available topic."""
    return (
        statistics.filter("available = 1")
        .groupBy("topic")
        .agg(F.sum("messages").alias("messages"), F.sum("lag").alias("lag"))
    )


def headline_counts(statistics: DataFrame, topics: Topics = DEFAULT_TOPICS) -> DataFrame:
    """One row: quarantined records and alerts so far; null without such a topic."""
    def total(name: str):
        return F.sum(F.when(F.col("topic") == name, F.col("messages")))

    return statistics.agg(total(topics.dlq).alias("dlqMessages"), total(topics.alerts).alias("alertMessages"))


def rejections_by_reason(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("errorType", "reason").agg(F.count(F.lit(1)).alias("records"))


def topic_tail(
    log: DataFrame, topic: str, limit: int = cfg.TAIL_DEFAULT_LIMIT, from_beginning: bool = False
) -> DataFrame:
    """Up to `limit` records of a topic, by partition and offset: the first ones,
    or the newest `limit / partitions + 1` of each partition. `valueIsJson` tells
    whether the value reads as JSON; otherwise it is plain text."""
    if not cfg.TAIL_MIN_LIMIT <= limit <= cfg.TAIL_MAX_LIMIT:
        raise ValueError(f"limit must be between {cfg.TAIL_MIN_LIMIT} and {cfg.TAIL_MAX_LIMIT}")
    rows = log.filter(F.col("topic") == topic)
    bounds = partition_bounds(rows).collect()  # a row per partition
    if not bounds:
        raise LookupError(f"topic not found: {topic}")
    if not from_beginning:
        each = max(1, limit // len(bounds) + 1)
        newest = [
            (F.col("partition") == b["partition"]) & (F.col("offset") >= max(b["low"], b["high"] - each)) for b in bounds
        ]
        # literals, so that the bounds reach the files; the newest records need no other pass
        rows = rows.filter(reduce(or_, newest))
    text = F.coalesce(F.col("value").cast("string"), F.lit(""))
    return (
        rows.orderBy("partition", "offset")
        .limit(limit)
        .select(
            "topic",
            "partition",
            "offset",
            F.nullif(F.col("key").cast("string"), F.lit("")).alias("key"),
            text.alias("value"),
            F.try_parse_json(text).isNotNull().alias("valueIsJson"),
        )
    )

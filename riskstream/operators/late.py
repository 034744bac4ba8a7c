"""Watermarks and late events of a log that is read in numbered batches.

Every row carries `batch_id`. The watermark that holds while batch b is read is
made of the batches before b: the highest event time seen, minus the
out-of-orderness, minus 1 ms. A row is late when its whole window, allowed
lateness included, lies behind that watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskstream import config as cfg
from riskstream.config import DEFAULT_TOPICS, MINUTE, Topics, WindowSpec
from riskstream.functions import expressions as E
from riskstream.plans.lookup import lookup_join

# batches per block of the two-level running maximum
_BLOCK = 4096


def watermark_after(highest: Column, spec: WindowSpec) -> Column:
    return highest - F.lit(spec.out_of_orderness_ms + 1)


def window_start(spec: WindowSpec) -> Column:
    return F.col("eventTime") - F.pmod(F.col("eventTime"), F.lit(spec.size_ms))


def _passed(spec: WindowSpec, extra_ms: int) -> Column:
    """The watermark of the row has reached the last instant of its window + extra."""
    return F.coalesce(F.col("watermark") >= window_start(spec) + (spec.size_ms - 1 + extra_ms), F.lit(False))


def is_closed(spec: WindowSpec) -> Column:
    """The window of the row had fired before the row came."""
    return _passed(spec, 0)


def is_late(spec: WindowSpec) -> Column:
    """The window of the row no longer took rows when the row came."""
    return _passed(spec, spec.allowed_lateness_ms)


def batch_watermarks(rows: DataFrame, spec: WindowSpec = MINUTE) -> DataFrame:
    """batch_id → watermark, for all batches but those before the first event.

    The running maximum works in two levels: within blocks of batches, then over
    the maxima of the blocks, so no task sees the list of all batches.
    """
    highest = rows.groupBy("batch_id").agg(F.max("eventTime").alias("highest"))
    blocked = highest.withColumn("_block", F.floor(F.col("batch_id") / _BLOCK))
    inside = Window.partitionBy("_block").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    block_highest = (
        blocked.groupBy("_block")
        .agg(F.max("highest").alias("_before"))
        .withColumn("_before", F.max("_before").over(across))
    )
    seen = F.greatest(F.max("highest").over(inside), F.col("_before"))
    return blocked.join(block_highest, "_block").select(
        "batch_id", watermark_after(seen, spec).alias("watermark")
    )


def stamp_watermark(rows: DataFrame, spec: WindowSpec = MINUTE, broadcast_bytes: int | None = None) -> DataFrame:
    """Add to each row the watermark that held when its batch was read."""
    watermarks = batch_watermarks(rows.select("batch_id", "eventTime"), spec)
    limit = {} if broadcast_bytes is None else {"broadcast_bytes": broadcast_bytes}
    return lookup_join(rows, watermarks, "batch_id", ["partition", "offset"], **limit)


def late_events(stamped: DataFrame, spec: WindowSpec = MINUTE) -> DataFrame:
    return stamped.filter(is_late(spec))


def events_in_time(stamped: DataFrame, spec: WindowSpec = MINUTE) -> DataFrame:
    return stamped.filter(~is_late(spec))


def late_records(late: DataFrame, observed_at: int | None = None, topics: Topics = DEFAULT_TOPICS) -> DataFrame:
    """Quarantine records for late events."""
    return late.select(
        F.lit(cfg.ERROR_LATE).alias("errorType"),
        F.lit(cfg.REASON_LATE).alias("reason"),
        F.lit(topics.raw).alias("sourceTopic"),
        F.lit(topics.replay).alias("replayTopic"),
        E.transaction_json().alias("rawValue"),
        E.now_millis(observed_at).alias("observedAt"),
    )

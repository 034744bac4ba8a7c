"""Transactions joined with the profile that was valid when they happened."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskstream.config import DEFAULT_THRESHOLDS, RiskThresholds
from riskstream.operators.changelog import DELETE, change_place
from riskstream.operators.enrich import profiled_high_risk_alerts
from riskstream.plans.lookup import materialize
from riskstream.sources.sinks import start_batch_sink, write_batch_folder

PROFILE_COLUMNS = ["risk_tier", "risk_multiplier", "manual_review_required"]
# versions and transactions of a merchant meet in blocks of this time
BLOCK_MS = 86_400_000
# transactions of one merchant and block that one task should order
SHARE = 200_000
_LONG_AGO = -(1 << 63)
_CELL = ["merchantId", "_block"]


def with_profiles_as_of(tx: DataFrame, changes: DataFrame, block_ms: int = BLOCK_MS, share: int = SHARE) -> DataFrame:
    """Left join by merchant with the last change at or before the event time. A deleted profile is none;
    without a profile the multiplier is 1. Changes without a source time come before all others.

    Time is cut into blocks. A transaction's version is the last one of its block before it or, if there is none, the last
    of all blocks before, which is a running maximum over blocks, not over versions. Only rows in blocks
    with a change are ordered by time; a block of a merchant with more transactions than `share` is dealt
    over several tasks, each of which gets the block's versions too.
    """

    def block(time: Column) -> Column:
        return F.call_function("div", time, F.lit(block_ms).cast("bigint"))

    versions = changes.select(
        F.col("merchant_id").alias("merchantId"),
        F.coalesce("source_ts_ms", F.lit(_LONG_AGO).cast("bigint")).alias("_time"),
        change_place(changes).alias("_place"),
        "op",
        *PROFILE_COLUMNS,
    ).withColumn("_block", block(F.col("_time")))
    events = tx.withColumn("_block", block(F.col("eventTime")))
    cells = _cells(versions, events, share)
    rows = events.select(*_CELL, "eventTime", F.struct(*tx.columns).alias("_row")).join(cells, _CELL, "left")
    quiet = rows.filter("_own IS NULL").select("_row", F.col("_before").alias("_place"))
    busy = _ordered(rows.filter("_own IS NOT NULL"), versions, cells.filter("_own IS NOT NULL"))
    images = versions.filter(F.coalesce(F.col("op") != DELETE, F.lit(True))).select("_place", *PROFILE_COLUMNS)
    found = quiet.unionByName(busy).join(images, "_place", "left").select("_row.*", *PROFILE_COLUMNS)
    return found.withColumn("risk_multiplier", F.coalesce(F.col("risk_multiplier").cast("double"), F.lit(1.0)))


def _cells(versions: DataFrame, events: DataFrame, share: int) -> DataFrame:
    """Blocks of a merchant that have transactions: the last version before it, its own last one, and over how many tasks it goes."""
    own = versions.groupBy(*_CELL).agg(F.max("_place").alias("_own")).withColumn("_rows", F.lit(0).cast("bigint"))
    counts = events.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("_rows"))
    none = F.lit(None).cast(own.schema["_own"].dataType)
    both = own.unionByName(counts.withColumn("_own", none)).groupBy(*_CELL).agg(F.max("_own").alias("_own"), F.sum("_rows").alias("_rows"))
    earlier = Window.partitionBy("merchantId").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    cells = both.withColumn("_before", F.max("_own").over(earlier)).filter("_rows > 0")
    return materialize(cells.select(*_CELL, "_before", "_own", F.ceil(F.col("_rows") / share).cast("int").alias("_salts")))


def _ordered(rows: DataFrame, versions: DataFrame, cells: DataFrame) -> DataFrame:
    salt = F.pmod(F.xxhash64("_row.eventId"), F.col("_salts")).cast("int")
    points = rows.select(*_CELL, salt.alias("_salt"), F.col("eventTime").alias("_time"), F.lit(1).alias("_kind"), "_before", "_row")
    marks = versions.join(cells, _CELL).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    marks = marks.select(*_CELL, "_salt", "_time", F.lit(0).alias("_kind"), "_place")
    both = points.unionByName(marks, allowMissingColumns=True)
    # places grow with time, so the last one so far is the greatest
    order = Window.partitionBy(*_CELL, "_salt").orderBy("_time", "_kind", "_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_last", F.max("_place").over(order)).filter("_kind = 1")
    return found.select("_row", F.coalesce("_last", "_before").alias("_place"))


def start_profiled_alerts(
    tx: DataFrame,
    changes: Callable[[], DataFrame],
    folder: str,
    checkpoint: str,
    limits: RiskThresholds = DEFAULT_THRESHOLDS,
    available_now: bool = False,
) -> StreamingQuery:
    """High-risk alerts of a stream with the profiles as of each event. `changes` is called for every
    micro-batch, so a profile that changes while the stream runs counts from the next micro-batch on; what was
    written before is not corrected."""
    publish = write_batch_folder(folder)

    def write(batch: DataFrame, batch_id: int) -> None:
        publish(profiled_high_risk_alerts(with_profiles_as_of(batch, changes()), limits), batch_id)

    return start_batch_sink(tx, write, checkpoint, "append", available_now)

"""Statistics per key and tumbling window, and the records made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream import config as cfg
from riskstream.config import MINUTE, WindowSpec
from riskstream.functions import expressions as E
from riskstream.functions import sums as S

# value columns of every statistics frame, in the order of their sum functions
STAT_COLUMNS = ["eventCount", "totalAmount", "totalFraudScore", "maxFraudScore"]
# what is summed
_TOTALS = {"totalAmount": "amount", "totalFraudScore": "mlFraudScore"}


def window_stats(tx: DataFrame, key: Column, spec: WindowSpec = MINUTE, first_event: str | None = None) -> DataFrame:
    """Count, sums and highest score per key and window.

    All values are fixed-width, so Spark pre-aggregates in a hash map before the
    shuffle and a hot key arrives as one row per task. Sums are exact whatever the
    size of their terms, see `sums`. `first_event` adds the
    earliest event of the group: "position" as a packed log position, still
    fixed-width, or "id" as its eventId, for streams, which cannot look ids up
    afterwards; text in the buffer makes Spark sort instead of hash.
    """
    first = {
        None: [],
        "position": [F.min(E.position(tx)).alias("samplePosition")],
        "id": [F.min_by("eventId", E.position(tx)).alias("sampleEventId")],
    }[first_event]
    group = [F.window("event_ts", spec.size).alias("window"), key.alias("key")]
    sums = [S.near_sum(F.col(c)).alias(f"_near_{name}") for name, c in _TOTALS.items()]
    sums += [S.odd_sum(F.col(c)).alias(f"_odd_{name}") for name, c in _TOTALS.items()]
    grouped = tx.groupBy(*group).agg(
        F.count(F.lit(1)).alias("eventCount"),
        *sums,
        F.max("mlFraudScore").alias("maxFraudScore"),
        *first,
        *(_far_columns() if tx.isStreaming else []),
    )
    if tx.isStreaming:
        far = {name: S.far_array([F.col(f"_{name}{i}") for i in range(S.FAR_LIMBS)]) for name in _TOTALS}
    elif has_far_terms(tx):
        grouped, far = _with_far_sums(grouped, tx, group), {name: F.col(f"_far_{name}") for name in _TOTALS}
    else:
        far = dict.fromkeys(_TOTALS)
    return grouped.select(
        "key",
        F.unix_millis("window.start").alias("windowStart"),
        F.unix_millis("window.end").alias("windowEnd"),
        "eventCount",
        *[S.total(F.col(f"_near_{name}"), F.col(f"_odd_{name}"), far[name]).alias(name) for name in _TOTALS],
        F.greatest(F.lit(0.0), F.col("maxFraudScore")).alias("maxFraudScore"),
        *[c for c in ("samplePosition", "sampleEventId") if c in grouped.columns],
    )


def _far_columns() -> list[Column]:
    return [limb.alias(f"_{name}{i}") for name, c in _TOTALS.items() for i, limb in enumerate(S.far_sums(F.col(c)))]


def has_far_terms(tx: DataFrame) -> bool:
    """Whether a table has an amount or score that does not add up with the others. The filter reaches the
    reader as bounds, so files that keep the range of their columns are not read for it."""
    return not tx.filter(S.is_far(F.col("amount")) | S.is_far(F.col("mlFraudScore"))).isEmpty()


def _with_far_sums(grouped: DataFrame, tx: DataFrame, group: list[Column]) -> DataFrame:
    """The sums of far terms beside those of near ones. They come from the few rows that have one."""
    rows = tx.filter(S.is_far(F.col("amount")) | S.is_far(F.col("mlFraudScore")))
    arrays = {name: S.far_array([F.col(f"_{name}{i}") for i in range(S.FAR_LIMBS)]) for name in _TOTALS}
    far = rows.groupBy(*group).agg(*_far_columns()).select(
        F.col("window").alias("_window"), F.col("key").alias("_key"), *[array.alias(f"_far_{name}") for name, array in arrays.items()]
    )
    key = F.col("key")
    same_key = key.eqNullSafe(F.col("_key")) if grouped.schema["key"].nullable else key == F.col("_key")
    return grouped.join(far, (F.col("window") == F.col("_window")) & same_key, "left")


def aggregate_records(stats: DataFrame, *extra: str) -> DataFrame:
    """Statistics per country|category|merchant as aggregate records."""
    count, total = F.col("eventCount"), F.col("totalAmount")
    return stats.select(
        F.lit(cfg.AGGREGATE_TYPE).alias("aggregateType"),
        "key",
        "windowStart",
        "windowEnd",
        "eventCount",
        E.round_half_up(total).alias("totalAmount"),
        E.round_half_up(E.ratio(total, count)).alias("avgAmount"),
        E.round_half_up(E.ratio(F.col("totalFraudScore"), count)).alias("avgFraudScore"),
        *extra,
    )


def country_category_aggregates(tx: DataFrame, spec: WindowSpec = MINUTE) -> DataFrame:
    return aggregate_records(window_stats(tx, E.aggregate_key(), spec))

"""Every result that a window emits: at its close, and again per row that comes
after the close but within the allowed lateness.

Input rows are stamped with `watermark` (see `late`). FIRE carries all rows that
came before the close; each REFIRE carries all rows up to its own, in the order
(batch_id, partition, offset). Rows that are late emit nothing.

The rows are summed once, into cells: one for all that came before the close, and
one per block of the log for those after it. All buffers are fixed-width, so Spark
sums in hash maps. What comes next reads the cells, and the later rows alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskstream.config import MINUTE, WindowSpec
from riskstream.functions import expressions as E
from riskstream.functions import sums as S
from riskstream.operators.aggregates import has_far_terms
from riskstream.operators.late import is_closed, is_late, watermark_after, window_start
from riskstream.plans.lookup import materialize

FIRE, REFIRE = "FIRE", "REFIRE"

# log offsets per block of the two-level running totals
_BLOCK = 65_536

# the two sums of a window, each as near terms and as those that are not finite
PARTS = ["amountExact", "amountOdd", "scoreExact", "scoreOdd"]
# the same of far terms, limb by limb; only where a table has such terms
_FAR = {name: [f"{name}{i}" for i in range(S.FAR_LIMBS)] for name in ("amountFar", "scoreFar")}


def sum_parts() -> list[Column]:
    """The terms of PARTS that a transaction gives."""
    amount, score = F.col("amount"), F.col("mlFraudScore")
    terms = [S.near_term(amount), S.odd_term(amount), S.near_term(score), S.odd_term(score)]
    return [term.alias(name) for term, name in zip(terms, PARTS, strict=True)]


def _far_parts() -> list[Column]:
    columns = zip(_FAR.values(), (F.col("amount"), F.col("mlFraudScore")), strict=True)
    return [S.far_limb(c, i).alias(name) for names, c in columns for i, name in enumerate(names)]


def totals(amount_far: Column | None = None, score_far: Column | None = None) -> list[Column]:
    """The sums made of PARTS and of the limbs of far terms, as doubles."""
    return [
        S.total(F.col("amountExact"), F.col("amountOdd"), amount_far).alias("totalAmount"),
        S.total(F.col("scoreExact"), F.col("scoreOdd"), score_far).alias("totalFraudScore"),
    ]


def sum_kind(name: str) -> str:
    return S.TOTAL if name.endswith("Exact") else "double" if name.endswith("Odd") else "decimal(38,0)"


def _added(a: Column, b: Column) -> Column:
    return F.coalesce(a + b, a, b)


GROUP = ["key", "windowStart"]
CELL = ["batch_id", "partition", "_block"]


def arrival(rows: DataFrame) -> Column:
    """The place of a row in the order (batch_id, partition, offset), as one fixed-width number."""
    position = E.position(rows.drop("topic"))  # partitions are unique over the topics
    return F.col("batch_id").cast("decimal(18,0)") * F.lit(str(1 << 63)).cast("decimal(19,0)") + position.cast("decimal(19,0)")


def sum_names(has_far: bool) -> list[str]:
    """The names of the parts of a window's two sums."""
    return [*PARTS, *_FAR["amountFar"], *_FAR["scoreFar"]] if has_far else PARTS


def far_arrays(has_far: bool) -> list[Column]:
    return [S.far_array([F.col(limb) for limb in limbs]) for limbs in _FAR.values()] if has_far else []


def cell_rows(stamped: DataFrame, key: Column, spec: WindowSpec, has_far: bool) -> DataFrame:
    """The rows in time, with their cell and what they add to it."""
    closed = is_closed(spec)
    return stamped.filter(~is_late(spec)).select(
        key.alias("key"),
        window_start(spec).alias("windowStart"),
        "eventTime",
        F.when(closed, F.col("batch_id").cast("bigint")).otherwise(-1).alias("batch_id"),
        F.when(closed, F.col("partition")).otherwise(-1).alias("partition"),
        F.when(closed, F.floor(F.col("offset") / _BLOCK)).otherwise(-1).alias("_block"),
        "offset",
        F.greatest(F.lit(0.0), F.col("mlFraudScore")).alias("maxFraudScore"),
        *sum_parts(),
        *(_far_parts() if has_far else []),
        arrival(stamped).alias("samplePlace"),
    )


def cell_values(parts: list[str]) -> list[Column]:
    """The aggregates that join rows, or cells of them, to one."""
    return [
        *[F.sum(name).cast(sum_kind(name)).alias(name) for name in parts],
        F.max("maxFraudScore").alias("maxFraudScore"),
        F.min("samplePlace").alias("samplePlace"),
    ]


def window_emissions(
    stamped: DataFrame, key: Column, spec: WindowSpec = MINUTE, first_event: bool = True
) -> DataFrame:
    """Statistics per emission, with its `kind` and the batch_id, partition and
    offset of the row that caused it (-1 for FIRE). `first_event` adds the eventId
    of the first row, which is looked up by its place, after any filter on the
    statistics."""
    has_far = has_far_terms(stamped)
    parts = sum_names(has_far)
    rows = cell_rows(stamped, key, spec, has_far)
    cells = materialize(
        rows.groupBy(*GROUP, *CELL).agg(
            F.count(F.lit(1)).alias("eventCount"), *cell_values(parts), F.max("eventTime").alias("newest")
        )
    )
    # a window whose close lies beyond the last watermark has not fired yet; late rows are never the newest
    last_watermark = cells.agg(watermark_after(F.max("newest"), spec)).scalar()
    fires = cells.filter(F.col("_block") < 0).filter(F.col("windowStart") + (spec.size_ms - 1) <= last_watermark)
    emitted = emission_records(fires, refires(rows.filter(F.col("_block") >= 0), cells, parts), spec, has_far)
    if not first_event:
        return emitted.drop("samplePlace")
    events = stamped.select(arrival(stamped).alias("samplePlace"), F.col("eventId").alias("sampleEventId"))
    return emitted.join(events, "samplePlace").drop("samplePlace")


def emission_records(fires: DataFrame, again: DataFrame, spec: WindowSpec, has_far: bool) -> DataFrame:
    """Cells that fire and the results of later rows, in the columns of window_emissions()."""
    values = ["eventCount", *sum_names(has_far), "maxFraudScore", "samplePlace"]
    first = fires.select(
        *GROUP,
        *values,
        F.lit(FIRE).alias("kind"),
        F.lit(-1).cast("bigint").alias("batch_id"),
        F.lit(-1).alias("partition"),
        F.lit(-1).cast("bigint").alias("offset"),
    )
    return first.unionByName(again).select(
        *GROUP,
        (F.col("windowStart") + spec.size_ms).alias("windowEnd"),
        "eventCount",
        *totals(*far_arrays(has_far)),
        "maxFraudScore",
        "samplePlace",
        "kind",
        "batch_id",
        "partition",
        "offset",
    )


def refires(later: DataFrame, cells: DataFrame, parts: list[str]) -> DataFrame:
    """A running total per later row of a group, in log order, without a task that
    holds the rows of a group: totals run over the cells, which are sums, and inside
    each cell, which has at most _BLOCK rows."""
    groups = cells.filter(F.col("_block") >= 0).select(*GROUP).distinct()
    before = Window.partitionBy(*GROUP).orderBy(*CELL).rowsBetween(Window.unboundedPreceding, -1)
    earlier = cells.join(groups, GROUP, "left_semi").select(
        *GROUP,
        *CELL,
        F.sum("eventCount").over(before).alias("_count"),
        *[F.sum(name).over(before).cast(sum_kind(name)).alias(f"_{name}") for name in parts],
        F.max("maxFraudScore").over(before).alias("_max"),
        F.first("samplePlace").over(before).alias("_first"),
    )
    inside = (
        Window.partitionBy(*GROUP, *CELL).orderBy("offset").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = later.select(
        *GROUP,
        *CELL,
        "offset",
        F.count(F.lit(1)).over(inside).alias("eventCount"),
        *[F.sum(name).over(inside).cast(sum_kind(name)).alias(name) for name in parts],
        F.max("maxFraudScore").over(inside).alias("maxFraudScore"),
        F.first("samplePlace").over(inside).alias("samplePlace"),
    )
    return local.join(earlier, [*GROUP, *CELL]).select(
        *GROUP,
        (F.col("eventCount") + F.coalesce("_count", F.lit(0))).alias("eventCount"),
        *[_added(F.col(name), F.col(f"_{name}")).cast(sum_kind(name)).alias(name) for name in parts],
        F.greatest("maxFraudScore", "_max").alias("maxFraudScore"),
        F.coalesce("_first", "samplePlace").alias("samplePlace"),
        F.lit(REFIRE).alias("kind"),
        "batch_id",
        "partition",
        "offset",
    )

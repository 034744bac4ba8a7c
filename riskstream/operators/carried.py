"""Repeated emissions of windows in increments, with the state of open windows kept as tables.

An increment holds whole batches of a log, in order. Its rows are summed into
cells as in `emissions`; what a window had before is one more cell, ahead of
them. So a hot window is many cells in many tasks here too, and rows that come
after the close are put in order by cells, which spill, not as a list of a key.

A folder holds, for every step, named by the last batch in it:

- state/: the sums of every window that still takes rows, with its first event;
- marks/: up to where the log was read, which is written last;
- cells/: the sums of the increment, while a step runs.

What a step writes follows from the last mark and its last batch alone, so a step that
dies is done again, and rows below the mark never count twice, whoever hands them in.
Nothing depends on limits of rules, on the number of partitions or on a
checkpoint, so those may change between steps.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.config import MINUTE, WindowSpec
from riskstream.operators.aggregates import has_far_terms
from riskstream.operators.emissions import (
    CELL,
    GROUP,
    arrival,
    cell_rows,
    cell_values,
    emission_records,
    refires,
    sum_kind,
    sum_names,
)
from riskstream.sources.sinks import remove_folder, write_once

_MARK = "lastBatch bigint, highest bigint, hasFar boolean, sizeMs bigint, outOfOrdernessMs bigint, latenessMs bigint"
_PLACE = "decimal(38,0)"
_SUMS = ", ".join(f"{name} {sum_kind(name)}" for name in sum_names(has_far=True))
_STATE = f"key string, windowStart bigint, eventCount bigint, {_SUMS}, maxFraudScore double, samplePlace {_PLACE}, sampleEventId string"
#: The cell of what a window had before: it stands ahead of all others.
_BEFORE = -2


@dataclass(frozen=True)
class Mark:
    """Up to where a folder's state has read the log: the last batch and the highest event time."""

    last_batch: int
    highest: int | None
    has_far: bool

    def watermark(self, spec: WindowSpec) -> int | None:
        return None if self.highest is None else self.highest - spec.out_of_orderness_ms - 1


def last_mark(spark: SparkSession, folder: str, spec: WindowSpec = MINUTE) -> Mark | None:
    """The mark of the last complete step; None if there is none yet. A window's times must not change."""
    try:
        marks = spark.read.schema(_MARK).parquet(f"{folder}/marks")
    except AnalysisException:
        return None
    row = marks.orderBy(F.desc("lastBatch")).first()
    if row is None:
        return None
    if (row.sizeMs, row.outOfOrdernessMs, row.latenessMs) != (spec.size_ms, spec.out_of_orderness_ms, spec.allowed_lateness_ms):
        raise ValueError(f"the state in {folder} is that of windows with other times")
    return Mark(row.lastBatch, row.highest, row.hasFar)


def _step(folder: str, name: str, last_batch: int) -> str:
    return f"{folder}/{name}/step={last_batch}"


def open_windows(spark: SparkSession, folder: str, mark: Mark, spec: WindowSpec = MINUTE) -> DataFrame:
    """The state of a mark, for windows that still take rows."""
    state = spark.read.schema(_STATE).parquet(_step(folder, "state", mark.last_batch))
    if mark.highest is None:
        return state
    return state.filter(F.col("windowStart") + (spec.size_ms - 1 + spec.allowed_lateness_ms) > mark.watermark(spec))


def advance(
    stamped: DataFrame,
    last_batch: int,
    folder: str,
    out: str,
    key: Column,
    spec: WindowSpec = MINUTE,
    finish: Callable[[DataFrame], DataFrame] = lambda stats: stats,
) -> Mark:
    """Read the batches after the folder's mark, up to `last_batch`, and write what their windows emit.

    stamped: rows with `watermark` and `batch_id`, as ingest lands them, with whole batches; those that
    were read before may be among them. `finish` makes the output of the statistics, which have
    the columns of `emissions.window_emissions`. The output is a folder `step=<last_batch>` in `out`.
    """
    spark = stamped.sparkSession
    before = last_mark(spark, folder, spec)
    if before is not None and before.last_batch >= last_batch:
        return before
    rows = stamped.filter(F.col("batch_id") <= last_batch)
    if before is not None:
        rows = rows.filter(F.col("batch_id") > before.last_batch)
    has_far = (before is not None and before.has_far) or has_far_terms(rows)
    parts = sum_names(has_far)
    values = ["eventCount", *parts, "maxFraudScore", "samplePlace"]

    own = cell_rows(rows, key, spec, has_far)
    sums = own.groupBy(*GROUP, *CELL).agg(
        F.count(F.lit(1)).alias("eventCount"), *cell_values(parts), F.max("eventTime").alias("newest")
    )
    sums = sums.withColumn("samplePlace", F.col("samplePlace").cast(_PLACE))
    write_once(sums, _step(folder, "cells", last_batch))
    gained = spark.read.schema(sums.schema).parquet(_step(folder, "cells", last_batch))
    seen = [t for t in (before and before.highest, gained.agg(F.max("newest")).first()[0]) if t is not None]
    mark = Mark(last_batch, max(seen, default=None), has_far)

    cells = gained.select(*GROUP, *CELL, *values)
    if before is not None:
        state = open_windows(spark, folder, before, spec)
        place = [F.lit(_BEFORE).cast(cells.schema[name].dataType).alias(name) for name in CELL]
        cells = cells.unionByName(state.select(*GROUP, *place, *values))

    joined = [F.sum("eventCount").alias("eventCount"), *cell_values(parts)]
    events = rows.select(arrival(rows).cast(_PLACE).alias("samplePlace"), F.col("eventId").alias("sampleEventId"))
    windows = cells.groupBy(*GROUP).agg(*joined)
    if before is None:
        named = windows.join(events, "samplePlace")
    else:
        known = state.select(*GROUP, "sampleEventId")
        new = windows.join(known, GROUP, "left_anti").join(events, "samplePlace")
        named = windows.join(known, GROUP).unionByName(new)
    write_once(named.select(*GROUP, *values, "sampleEventId"), _step(folder, "state", last_batch))

    fires = cells.filter(F.col("_block") < 0).groupBy(*GROUP).agg(*joined)
    close = F.col("windowStart") + (spec.size_ms - 1)
    fires = fires.filter(close <= F.lit(mark.watermark(spec)))
    if before is not None and before.highest is not None:
        fires = fires.filter(close > before.watermark(spec))  # else it has fired
    emitted = emission_records(fires, refires(own.filter(F.col("_block") >= 0), cells, parts), spec, has_far)
    names = spark.read.schema(_STATE).parquet(_step(folder, "state", last_batch)).select(*GROUP, "sampleEventId")
    write_once(finish(emitted.drop("samplePlace").join(names, GROUP)), f"{out}/step={last_batch}")

    times = (spec.size_ms, spec.out_of_orderness_ms, spec.allowed_lateness_ms)
    write_once(spark.createDataFrame([(last_batch, mark.highest, has_far, *times)], _MARK).coalesce(1), _step(folder, "marks", last_batch))
    remove_folder(spark, _step(folder, "cells", last_batch))
    if before is not None:  # the state before is kept for readers that hold it, those before that are not
        _forget(spark, folder, before.last_batch)
    return mark


def _forget(spark: SparkSession, folder: str, kept_from: int) -> None:
    """Remove the steps before the last two."""
    old = spark.read.schema(f"{_MARK}, step bigint").parquet(f"{folder}/marks").filter(F.col("step") < kept_from)
    for row in old.select("step").collect():  # one row at most, as every step removes its own
        remove_folder(spark, _step(folder, "state", row.step))
        remove_folder(spark, _step(folder, "marks", row.step))

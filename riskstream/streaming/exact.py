"""One result when a window closes, and one more per row that comes after it.

Input is a stream of rows stamped with the `watermark` of their batch, without
late rows, as `ingest` lands them; results equal those of
`riskstream.operators.emissions` on the same rows, however the stream is cut
into micro-batches.

Rows that came before the close only add up, so each task sums them per key and
window before the shuffle; a hot key arrives as a few rows. Every call to the state
store is a message to Spark, which takes longer than a sum, so keys are hashed into
KEY_BUCKETS buckets, and state and timers are kept per bucket and window. Spark hands
rows to a processor cell by cell, so the values of a row travel as one. Needs the
RocksDB state store.
"""

from __future__ import annotations

import decimal
import pickle
import sys
from collections import namedtuple
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from riskstream.config import MINUTE, WindowSpec
from riskstream.functions import sums as S
from riskstream.operators.emissions import FIRE, PARTS, REFIRE, sum_kind, sum_parts, totals
from riskstream.operators.late import is_closed, window_start

# executors get the code of this module with the query; it need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Buckets of keys. A task holds the keys of one bucket and window at a time; a checkpoint keeps its number of buckets.
KEY_BUCKETS = 256


def use_disk_state(spark: SparkSession) -> None:
    """Keep the state of streaming queries on local disk with changes saved to the
    checkpoint, instead of in executor memory. Holds for queries started later."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


_STATS = f"eventCount bigint, amountExact {S.TOTAL}, amountOdd double, scoreExact {S.TOTAL}, scoreOdd double, maxFraudScore double"
S_BITS, S_LIMBS = S.LIMB_BITS, S.FAR_LIMBS  # plain numbers, which go to executors with this module
_DIGITS = 38  # of decimal sums, as in Spark
_PARTIAL = "bucket int, windowStart bigint, event_ts timestamp, packed binary"
_VALUES = [
    "key", "closed", "batch_id", "partition", "offset", "eventId", "eventCount", *PARTS, "maxFraudScore", "amountFar", "scoreFar",
]
Partial = namedtuple("Partial", _VALUES)
_STATE = (
    f"keys array<struct<key string, {_STATS}, batch_id bigint, partition int, offset bigint, "
    "sampleEventId string, amountFar string, scoreFar string, fired boolean>>"
)
_LIMBS = "array<decimal(38,0)>"
_OUTPUT = (
    f"key string, windowStart bigint, {_STATS}, amountFar {_LIMBS}, scoreFar {_LIMBS}, sampleEventId string, kind string, "
    "batch_id bigint, partition int, offset bigint"
)


def _sum_open_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per Arrow batch: open rows summed per key and window, closed rows as they are.
    Rows with a value that is null, not finite or far stay single too, because pandas
    would leave it out of a sum, or round it; so do those that are alone with their key."""
    decimal.getcontext().prec = _DIGITS
    order, group = ["batch_id", "partition", "offset"], ["key", "windowStart"]
    for rows in batches:
        single = rows["closed"] | rows["amountExact"].isna() | rows["scoreExact"].isna()
        single |= rows["amountFar"].notna() | rows["scoreFar"].notna()
        keyed = rows[group].notna().all(axis=1)  # open rows without a key or a window are in no sum
        single |= keyed & ~rows[~single].duplicated(group, keep=False).reindex(rows.index, fill_value=True)
        open_rows = rows[~single].sort_values(order)
        summed = open_rows.groupby(group, as_index=False, sort=False).agg(
            bucket=("bucket", "first"),
            closed=("closed", "first"),
            batch_id=("batch_id", "first"),
            partition=("partition", "first"),
            offset=("offset", "first"),
            event_ts=("event_ts", "max"),
            eventId=("eventId", "first"),
            eventCount=("eventCount", "sum"),
            amountExact=("amountExact", "sum"),
            amountOdd=("amountOdd", "first"),
            scoreExact=("scoreExact", "sum"),
            scoreOdd=("scoreOdd", "first"),
            maxFraudScore=("maxFraudScore", "max"),
            amountFar=("amountFar", "first"),
            scoreFar=("scoreFar", "first"),
        )
        yield _packed(summed)
        yield _packed(rows[single])


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    """The columns of _PARTIAL, with the rest as one value that `Partial` is made of."""
    plain = rows[_VALUES].astype(object).where(rows[_VALUES].notna(), None)
    packed = [pickle.dumps(values) for values in plain.itertuples(index=False, name=None)]
    return rows[["bucket", "windowStart", "event_ts"]].assign(packed=pd.Series(packed, index=rows.index, dtype=object))


def _greater(a: float, b: float) -> float:
    """Like Spark's greatest: NaN is above all numbers."""
    return a if a != a or a >= b else b


def _sum(a: Any, b: Any) -> Any:
    """a + b, where null counts as nothing."""
    return b if a is None else a if b is None else a + b


def _far_sum(a: str | None, b: float | None) -> str | None:
    """The sum of far terms so far, as the digits of a whole number, and one more of them."""
    return a if b is None else str(int(a or 0) + int(b))


def _limbs(digits: str | None) -> list[decimal.Decimal] | None:
    if digits is None:
        return None
    sign, size = (-1, -int(digits)) if digits.startswith("-") else (1, int(digits))
    parts = [size >> (S_BITS * i) & ((1 << S_BITS) - 1) for i in range(S_LIMBS - 1)]
    return [decimal.Decimal(sign * part) for part in [*parts, size >> (S_BITS * (S_LIMBS - 1))]]


class WindowEmitter(StatefulProcessor):
    """State of the keys of one bucket and window, and what they emit.

    Spark's watermark trails the newest event by the whole life of a window, so
    that Spark itself never drops a row that is in time. The timers are set on
    that trailing watermark: the window closes at `start - lateness` and is
    forgotten at `start`.
    """

    def __init__(self, lateness_ms: int):
        self._lateness_ms = lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        decimal.getcontext().prec = _DIGITS
        self._handle = handle
        self._state = handle.getValueState("windows", _STATE)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        _, start = key
        known = self._load()
        new = known is None
        windows = {} if new else known
        after = []
        for given in rows:
            row = Partial(*pickle.loads(given.packed))
            if row.closed:
                after.append(row)
            else:
                windows[row.key] = self._add(windows.get(row.key), row, fired=False)
        waiting = new or any(not stats[-1] for stats in windows.values())
        for row in sorted(after, key=lambda r: (r.batch_id, r.partition, r.offset)):
            stats = windows.get(row.key)
            if stats is not None and not stats[-1]:
                yield self._emit(row.key, start, stats, FIRE, (-1, -1, -1))
            windows[row.key] = stats = self._add(stats, row, fired=True)
            yield self._emit(row.key, start, stats, REFIRE, (row.batch_id, row.partition, row.offset))
        self._save(windows)
        if waiting:  # a timer that has gone off is set again for keys that came after it
            self._handle.registerTimer(start - self._lateness_ms)
        if new:
            self._handle.registerTimer(start)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        _, start = key
        windows = self._load() or {}
        waiting = [name for name, stats in windows.items() if not stats[-1]]
        for name in waiting:
            yield self._emit(name, start, windows[name], FIRE, (-1, -1, -1))
            windows[name] = (*windows[name][:-1], True)
        if expiredTimerInfo.getExpiryTimeInMs() >= start:
            self._state.clear()
        elif waiting:
            self._save(windows)

    def _load(self) -> dict[str | None, tuple] | None:
        """Key → its statistics; None if the bucket has no state."""
        found = self._state.get()
        return None if found is None else {name: tuple(stats) for name, *stats in found[0]}

    def _save(self, windows: dict[str | None, tuple]) -> None:
        self._state.update(([(name, *stats) for name, stats in windows.items()],))

    def close(self) -> None:
        pass

    @staticmethod
    def _add(stats: tuple | None, row: Partial, fired: bool) -> tuple:
        place = (row.batch_id, row.partition, row.offset)
        if stats is None:
            return (
                row.eventCount, row.amountExact, row.amountOdd, row.scoreExact, row.scoreOdd, row.maxFraudScore,
                *place, row.eventId, _far_sum(None, row.amountFar), _far_sum(None, row.scoreFar), fired,
            )
        first = stats[6:10] if stats[6:9] <= place else (*place, row.eventId)
        return (
            stats[0] + row.eventCount,
            _sum(stats[1], row.amountExact),
            _sum(stats[2], row.amountOdd),
            _sum(stats[3], row.scoreExact),
            _sum(stats[4], row.scoreOdd),
            _greater(stats[5], row.maxFraudScore),
            *first,
            _far_sum(stats[10], row.amountFar),
            _far_sum(stats[11], row.scoreFar),
            fired,
        )

    @staticmethod
    def _emit(name: str, start: int, stats: tuple, kind: str, cause: tuple[int, int, int]) -> Row:
        count, *parts, highest = stats[:6]
        batch_id, partition, offset = cause
        return Row(
            key=name,
            windowStart=start,
            eventCount=count,
            **dict(zip(PARTS, parts, strict=True)),
            maxFraudScore=highest,
            amountFar=_limbs(stats[10]),
            scoreFar=_limbs(stats[11]),
            sampleEventId=stats[9],
            kind=kind,
            batch_id=batch_id,
            partition=partition,
            offset=offset,
        )


def exact_emissions(stamped: DataFrame, key: Column, spec: WindowSpec = MINUTE) -> DataFrame:
    """Statistics per emission, in the columns of `emissions.window_emissions`."""
    rows = stamped.select(
        F.pmod(F.hash(key), F.lit(KEY_BUCKETS)).alias("bucket"),
        key.alias("key"),
        window_start(spec).alias("windowStart"),
        is_closed(spec).alias("closed"),
        F.col("batch_id").cast("bigint").alias("batch_id"),
        "partition",
        "offset",
        "event_ts",
        "eventId",
        F.lit(1).cast("bigint").alias("eventCount"),
        *[term.cast(sum_kind(name)).alias(name) for name, term in zip(PARTS, sum_parts(), strict=True)],
        F.greatest(F.lit(0.0), F.col("mlFraudScore")).alias("maxFraudScore"),
        *[F.when(S.is_far(F.col(c)), F.col(c)).alias(name) for name, c in (("amountFar", "amount"), ("scoreFar", "mlFraudScore"))],
    )
    life = spec.size_ms + spec.out_of_orderness_ms + spec.allowed_lateness_ms
    emitted = (
        rows.mapInPandas(_sum_open_rows, _PARTIAL)
        .withWatermark("event_ts", f"{life} milliseconds")
        .groupBy("bucket", "windowStart")
        .transformWithState(
            statefulProcessor=WindowEmitter(spec.allowed_lateness_ms),
            outputStructType=T._parse_datatype_string(_OUTPUT),
            outputMode="append",
            timeMode="EventTime",
        )
    )
    return emitted.select(
        "key",
        "windowStart",
        (F.col("windowStart") + spec.size_ms).alias("windowEnd"),
        "eventCount",
        *totals(F.col("amountFar"), F.col("scoreFar")),
        "maxFraudScore",
        "sampleEventId",
        "kind",
        "batch_id",
        "partition",
        "offset",
    )

"""Reference data kept as a log of changes."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.functions.expressions import computed_once, position
from riskstream.schemas import PROFILE, PROFILE_CHANGE

DELETE = "d"
_CORRUPT = "_corrupt"


def read_changes(log: DataFrame) -> DataFrame:
    """Change records from a log of JSON values. Left out are tombstones (null
    values), records that are no JSON or have a field that does not fit its type,
    and images, other than deletes, that lack a column: they must not take the
    place of a good image."""
    names = {"op": "__op", "source_ts_ms": "__source_ts_ms"}
    wire = ", ".join(
        f"{names.get(f.name, f.name)} {f.dataType.simpleString()}" for f in PROFILE_CHANGE.fields
    )
    texts = log.filter(F.col("value").isNotNull()).select("partition", "offset", "value")
    read = F.from_json(F.col("value").cast("string"), f"{wire}, {_CORRUPT} string", {"columnNameOfCorruptRecord": _CORRUPT})
    rows = computed_once(texts, {"r": read}).filter(F.col(f"r.{_CORRUPT}").isNull())
    fields = [F.col(f"r.{names.get(f.name, f.name)}").alias(f.name) for f in PROFILE_CHANGE.fields]
    whole = reduce(and_, [F.col(f).isNotNull() for f in PROFILE.fieldNames()])
    kept = F.col("merchant_id").isNotNull() & (F.col("op").eqNullSafe(DELETE) | whole)
    return rows.select("partition", "offset", *fields).filter(kept)


def change_place(changes: DataFrame) -> Column:
    """Source time, then place in the log, as one fixed-width number. Changes
    without a time come before all others."""
    time = F.coalesce(F.col("source_ts_ms"), F.lit(-(1 << 63)).cast("bigint")).cast("decimal(19,0)")
    return time * F.lit(str(1 << 63)).cast("decimal(19,0)") + position(changes.drop("topic")).cast("decimal(19,0)")


def current_state(changes: DataFrame, key: str = "merchant_id", fields: list[str] | None = None) -> DataFrame:
    """The last image per key, by source time and place in the log; keys whose last
    change is a delete are gone.

    The places are folded in hash maps, before the shuffle as well, so a key with
    very many changes sends one row per task. The images are then looked up by
    key and place, which are unique in a log.
    """
    fields = fields or PROFILE.fieldNames()
    placed = changes.withColumn("_place", change_place(changes))
    last = placed.groupBy(key).agg(F.max("_place").alias("_place"))
    images = placed.join(last, [key, "_place"])
    return images.filter(F.coalesce(F.col("op") != DELETE, F.lit(True))).select(*fields)


def upsert(
    current: DataFrame, incoming: DataFrame, now: Column, key: str = "merchant_id", stamp: str = "updated_at"
) -> DataFrame:
    """Insert new keys and overwrite the values of known ones, stamping `now`.
    Two incoming rows for one key are an error, as in a database statement."""
    times = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("_times"))
    once = F.when(F.col("_times") == 1, F.col(key)).otherwise(
        F.raise_error(F.concat(F.lit("more than one incoming row for key "), F.col(key)))
    )
    new = incoming.withColumn(stamp, now).join(times, key).withColumn(key, once).select(*current.columns)
    return current.join(times, key, "left_anti").unionByName(new)

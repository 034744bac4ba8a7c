"""Reference data folded from its change log in increments."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.operators.changelog import DELETE, change_place, read_changes
from riskstream.schemas import PROFILE


@dataclass(frozen=True)
class Snapshot:
    """The last image of every key, deletes included, up to the highest offset that was read of each partition."""

    number: int
    images: DataFrame
    marks: dict[int, int]

    def state(self) -> DataFrame:
        """The keys that are there, as `changelog.current_state` gives them."""
        return self.images.filter(F.coalesce(F.col("op") != DELETE, F.lit(True))).select(*PROFILE.fieldNames())


def load(spark: SparkSession, folder: str) -> Snapshot | None:
    """The last complete snapshot: the one whose marks were written."""
    try:
        marks = spark.read.parquet(f"{folder}/marks")
    except AnalysisException:
        return None
    number = marks.agg(F.max("number")).first()[0]
    if number is None:
        return None
    last = {r["partition"]: r["offset"] for r in marks.filter(F.col("number") == number).collect()}
    return Snapshot(number, spark.read.parquet(f"{folder}/images-{number}"), last)


def after(log: DataFrame, marks: dict[int, int]) -> DataFrame:
    """The records beyond the marks, as bounds on partition and offset that a reader can skip files by."""
    if not marks:
        return log
    known = [(F.col("partition") == p) & (F.col("offset") > o) for p, o in sorted(marks.items())]
    return log.filter(reduce(or_, known) | ~F.col("partition").isin(*marks))


def advance(log: DataFrame, folder: str) -> Snapshot | None:
    """Fold what the log has gained into a new snapshot in `folder`; None if there never was a record.

    Images are written first and marks, in one commit, last: a run that dies between is done again. A
    delete keeps its row, so that a change with an older source time that comes later does not bring its key back.
    """
    spark = log.sparkSession
    before = load(spark, folder)
    tail = after(log, before.marks if before else {})
    gained = {r["partition"]: r["high"] for r in tail.groupBy("partition").agg(F.max("offset").alias("high")).collect()}
    if not gained:
        return before
    changes = read_changes(tail)
    changes = changes.withColumn("place", change_place(changes)).drop("partition", "offset", "source_ts_ms")
    if before:
        changes = before.images.unionByName(changes)
    last = changes.groupBy("merchant_id").agg(F.max("place").alias("place"))
    number = before.number + 1 if before else 1
    changes.join(last, ["merchant_id", "place"]).write.mode("overwrite").parquet(f"{folder}/images-{number}")
    marks = {**(before.marks if before else {}), **gained}
    rows = spark.createDataFrame([(number, p, o) for p, o in marks.items()], "number int, partition int, offset bigint")
    rows.coalesce(1).write.mode("append").parquet(f"{folder}/marks")
    return load(spark, folder)

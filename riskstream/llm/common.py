"""What the operators share: text forms, the shared folder, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word of the space-separated kind, as a Java regular expression. bytes.split() without arguments gives the same words.
WORD = r"[^\x20\x09-\x0D]+"


def whole(text: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else unchanged."""
    return F.translate(text, UPPER, UPPER.lower())


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session, else a folder in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch").rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a table in the shared folder: computed once, and safe from lost executors."""
    path = f"{shared_folder(df.sparkSession)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """df with 0, 1, 2, ... in the given order, without bringing all rows to one task.

    Rows are dealt by range; what one task has is numbered there, and the
    numbers of the tasks before it are added from a table with a row per task.
    """
    dealt = df.repartitionByRange(*order).withColumn("_task", F.spark_partition_id())
    dealt = written(dealt, label)
    starts = dealt.groupBy("_task").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    starts = starts.select("_task", F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_task").orderBy(*order)) - 1
    return dealt.withColumn("_own", own).join(starts, "_task").withColumn(name, F.col("_own") + F.col("_before")).drop("_task", "_own", "_before")


def schema_of(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


def rows_of(batches: Iterable[pa.RecordBatch], step: int = 64) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples, a few at a time so that long texts don't pile up."""
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, step).columns), strict=True)


class Rows:
    """Collects rows for an Arrow schema and gives them out as batches of bounded size."""

    def __init__(self, schema: pa.Schema, most: int = 20_000, most_bytes: int = 8_000_000):
        self.schema, self.most, self.most_bytes = schema, most, most_bytes
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, row: tuple, size: int = 0) -> None:
        self.rows.append(row)
        self.bytes += size

    def full(self) -> bool:
        return len(self.rows) >= self.most or self.bytes >= self.most_bytes

    def take(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) if self.rows else [()] * len(self.schema)
        self.rows, self.bytes = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, self.schema, strict=True)], schema=self.schema)

"""Exact deduplication by 128-bit content hash, with the bytes of equal hashes compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import lower_ascii, whole, written


def md5_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def text_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", key: Callable[[Column], Column] = md5_key
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical after lower-casing A-Z; of equal
    texts the row with the largest doc_id stays (keep_id, the smallest stable
    choice the contract names). Null texts count as empty. A null doc_id is
    smaller than any other; if a group has no other, keep_id is null and its
    rows are kept. Rows that repeat both the largest id and the text are the
    same document and are all marked as kept; deduplicate() keeps one of them.
    An empty table gives no rows; other columns are ignored.

    Texts are grouped by (hash, text): this compares bytes, and copies collapse
    in the tasks that read them, so that a hot group sends a row per task. A
    hash that holds one text only, which is nearly all, is then enough to find
    a row's group; rows of a hash with several texts are matched by their text.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), lower_ascii(whole(text)).alias("norm"))
    base = base.withColumn("key", key(F.col("norm")))
    groups = base.groupBy("key", "norm").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    by_key = groups.groupBy("key").agg(
        F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    by_key = written(by_key, "text-keys")
    rows = base.withColumn("text_sha256", F.sha2("norm", 256))
    found = rows.drop("norm").join(by_key.filter("texts = 1"), "key").drop("key", "texts")
    collided = by_key.filter("texts > 1").select("key")
    if not collided.isEmpty():
        apart = groups.join(collided, "key", "left_semi")
        found = found.unionByName(rows.join(apart, ["key", "norm"]).drop("key", "norm"))
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: one row of each group of equal texts.

    Rows and texts are compared as in text_classes(); of rows with the same id
    and text, one stays.
    """
    rows = docs.select(F.struct("*").alias("doc"), F.col(doc_id).cast("long").alias("id"), lower_ascii(whole(text)).alias("norm"))
    rows = rows.withColumn("key", md5_key(F.col("norm")))
    kept = rows.groupBy("key", "norm").agg(F.max("id").alias("id"))
    kept = written(kept.select("key", "id"), "kept-texts")
    stays = rows.join(kept, (rows.key == kept.key) & rows.id.eqNullSafe(kept.id), "left_semi")
    # Copies of one row (same id and text) meet by their hash; there are few of them, as ids are near unique.
    repeated = stays.groupBy("key", "id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _one_of_each(stays, repeated, docs.columns)


def _one_of_each(stays: DataFrame, repeated: DataFrame, columns: list[str]) -> DataFrame:
    repeated = written(repeated, "repeated-rows")
    if repeated.isEmpty():
        return stays.select("doc.*")
    hit = (stays.key == repeated.key) & stays.id.eqNullSafe(repeated.id)
    single = stays.join(repeated, hit, "left_anti")
    twice = stays.join(repeated, hit, "left_semi").groupBy("key", "id", "norm").agg(F.any_value("doc").alias("doc"))
    return single.select("doc.*").unionByName(twice.select("doc.*"))

"""Joins of a large table with a lookup table, and cutting of lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
# what a value and a row take besides the text of a value
_VALUE_BYTES, _ROW_BYTES = 16, 32


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster: spark.checkpoint.dir, else one in the warehouse."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Compute a small result once and keep it where a lost executor cannot take it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def size_in_bytes(df: DataFrame) -> int:
    """About what the rows take in memory, from one sum over them."""
    texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + _VALUE_BYTES for c in df.columns]
    row = sum(texts, F.lit(_ROW_BYTES)).cast("bigint")
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: list[str],
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join facts with a lookup table that has one row per key.

    The lookup is computed once and measured. Up to `broadcast_bytes` it is
    broadcast, and the facts are not shuffled. Beyond, both sides shuffle: on the
    key, and for hot keys on a salt as well, see _salted(). All ways give the
    same rows. A stream of facts cannot be counted; beyond the limit it is
    joined on the key alone.
    """
    lookup = materialize(lookup)
    if size_in_bytes(lookup) <= broadcast_bytes:
        return facts.join(F.broadcast(lookup), key, how)
    if facts.isStreaming:
        return facts.join(lookup, key, how)
    return _salted(facts, lookup, key, spread_by, how)


def _salted(facts: DataFrame, lookup: DataFrame, key: str, spread_by: list[str], how: str) -> DataFrame:
    """A key, or null, is hot if it has more rows than a shuffle partition should.
    There are fewer such keys than partitions, so their list is broadcast. A hot
    key gets as many salts as partitions that its rows would fill: a hash of
    `spread_by` for a fact, and a copy of the lookup row for each."""
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = materialize(facts.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_rows")))
    share = max(1.0, (counts.agg(F.sum("_rows")).first()[0] or 0) / partitions)
    hot = counts.filter(F.col("_rows") > share)
    hot = F.broadcast(hot.select("_hot", F.ceil(F.col("_rows") / share).cast("int").alias("_salts")))

    def with_salts(df: DataFrame) -> DataFrame:
        return df.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left").drop("_hot")

    salts = F.coalesce("_salts", F.lit(1))
    salted = with_salts(facts).withColumn("_salt", F.pmod(F.xxhash64(*spread_by), salts).cast("int"))
    copies = with_salts(lookup).withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted.drop("_salts").join(copies.drop("_salts"), [key, "_salt"], how).drop("_salt")

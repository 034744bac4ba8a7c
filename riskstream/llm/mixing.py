"""Mixing of sources to target weights by repetition rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import WORD, numbered, whole, written

WEIGHTS = (1, 2, 3)
MOST_TIMES = 3


def word_count(text: str) -> Column:
    return F.regexp_count(F.col(text).cast("string"), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """source, source_size, target for a table of (source, size).

    Sources in code point order, null last, weigh weights[0], weights[1], ...,
    repeating. They share the sum of all sizes by weight; no target exceeds
    most_times its source's size, and the excess is shared again by weight
    among the others until none is above. Each round is one sum over the table
    of sources, which is never brought to one place.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(totals, [F.col("source").asc_nulls_last()], "place", "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = written(ranked.select("source", "source_size", weight.cast("long").alias("weight")), "source-weights")
    cap = F.col("source_size") * most_times
    everything = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"]
    weights_open = sources.agg(F.sum("weight").alias("n")).first()["n"]
    left, full = everything, 0
    while True:
        share = F.lit(float(left)) * F.col("weight") / F.lit(float(weights_open or 1))
        above = cap < share
        row = sources.agg(
            F.count_if(above).alias("full"),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)).alias("held"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"),
        ).first()
        if row["full"] == full:
            return sources.select("source", "source_size", F.least(cap.cast("double"), share).alias("target"))
        left, weights_open, full = everything - row["held"], row["open"], row["full"]


def draw(doc_id: str, text: str, seed: int) -> Column:
    """A number in [0, 1) that depends on the seed and the id only (on the text, where the id is null)."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text:"), F.md5(whole(text))))
    digits = F.substring(F.md5(F.concat(F.lit(f"mix:{seed}:"), name)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 52)


def _copies(rate: Column, number: Column) -> Column:
    return (F.floor(rate) + F.when(number < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def mix_plan(
    docs: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, copies, taken.

    size is the number of words (null text: 0). A source's repetition rate is
    target / source_size; each document is taken floor(rate) times, plus once
    more with the fraction as probability, decided by a hash of its id, so
    reruns and retried tasks agree. Rows that repeat an id share its draw, and
    rows without an id draw by their text. Sources without words have rate 0.
    An empty table gives no rows; other columns are ignored.
    """
    sizes = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.coalesce(word_count(text), F.lit(0)).alias("size"), draw(doc_id, text, seed).alias("number"),
    )
    sizes = written(sizes, "mix-sizes")
    targets = source_targets(sizes, weights, most_times).withColumnRenamed("source", "name")
    rows = sizes.join(targets, sizes.source.eqNullSafe(targets.name))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumn("copies", _copies(rate, F.col("number")))
    return rows.select("doc_id", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix(
    docs: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """The mixed corpus: the documents with all their columns, each as often as mix_plan() takes it."""
    sizes = docs.select(F.col(source).cast("string").alias("source"), F.coalesce(word_count(text), F.lit(0)).alias("size"))
    targets = source_targets(sizes, weights, most_times).withColumnRenamed("source", "name")
    rows = docs.select(F.struct("*").alias("doc"), F.col(source).cast("string").alias("source"), draw(doc_id, text, seed).alias("number"))
    rows = rows.join(targets, rows.source.eqNullSafe(targets.name))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = _copies(rate, F.col("number"))
    return rows.filter(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), copies))).select("doc.*")

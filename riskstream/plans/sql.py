"""The per-minute aggregate as SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream import config as cfg
from riskstream.config import MINUTE, WindowSpec
from riskstream.functions import sums as S
from riskstream.operators.aggregates import has_far_terms

# Differs on purpose from the DataFrame aggregate: groups are made of the raw
# values, only nulls are replaced in the printed key, and SUM and AVG skip nulls.
# Sums are made of fixed-width parts, see `sums`, and put together at the end.
_NEAR_SQL = """
  SELECT window(event_ts, '{size}') AS w, country, category, merchantId, count(*) AS n,
         sum({near_amount}) AS amountNear, sum({odd_amount}) AS amountOdd, count(amount) AS amounts,
         sum({near_score}) AS scoreNear, sum({odd_score}) AS scoreOdd, count(mlFraudScore) AS scores{more}
  FROM {{transactions}}
  GROUP BY window(event_ts, '{size}'), country, category, merchantId
"""
_FAR_SQL = """
  SELECT window(event_ts, '{size}') AS w, country, category, merchantId, {far_amount} AS amountFar, {far_score} AS scoreFar
  FROM {{transactions}}
  WHERE {is_far_amount} OR {is_far_score}
  GROUP BY window(event_ts, '{size}'), country, category, merchantId
"""
_PARTS = "n, amountNear, amountOdd, amounts, scoreNear, scoreOdd, scores, amountFar, scoreFar"
_HEAD = """
SELECT '{aggregate_type}' AS aggregateType,
       concat_ws('|', coalesce(near.country, '{country}'), coalesce(near.category, '{category}'),
                 coalesce(near.merchantId, '{merchant}')) AS key,
       near.w.start AS windowStart,
       near.w.end AS windowEnd,
       {parts}
FROM ({near}) AS near
"""
_NO_FAR = ", CAST(NULL AS array<decimal(38,0)>) AS amountFar, CAST(NULL AS array<decimal(38,0)>) AS scoreFar"
_JOIN = """LEFT JOIN ({far}) AS far
  ON near.w = far.w AND near.country <=> far.country AND near.category <=> far.category AND near.merchantId <=> far.merchantId
"""


def _near(column: str) -> str:
    return f"CASE WHEN abs({column}) < {S.NEAR!r}D THEN CAST({column} AS {S.TERM}) WHEN abs({column}) < double('Infinity') THEN 0 END"


def _odd(column: str) -> str:
    return f"CASE WHEN NOT abs({column}) < double('Infinity') THEN {column} END"


def _is_far(column: str) -> str:
    high, end = f"{S.NEAR!r}D", "double('Infinity')"
    return f"({column} >= {high} AND {column} < {end} OR {column} <= -{high} AND {column} > -{end})"


def _far(column: str) -> str:
    """The limbs of the far terms of a column, summed, as an array."""
    limbs = []
    for place in range(S.FAR_LIMBS):
        rest = f"abs({column})" + (f" % double('{2.0 ** (S.LIMB_BITS * (place + 1))!r}')" if place < S.FAR_LIMBS - 1 else "")
        part = f"floor(({rest}) / double('{2.0 ** (S.LIMB_BITS * place)!r}'))"
        signed = f"CAST(CASE WHEN {column} < 0 THEN -{part} ELSE {part} END AS decimal(28,0))"
        limbs.append(f"CAST(sum(CASE WHEN {_is_far(column)} THEN {signed} END) AS decimal(38,0))")
    return f"CASE WHEN count_if({_is_far(column)}) > 0 THEN array({', '.join(limbs)}) END"


def sql_aggregates(tx: DataFrame, spec: WindowSpec = MINUTE) -> DataFrame:
    """A table sums its far terms, if it has any, apart and joins them; a stream, which has one aggregate, beside the near ones."""
    joined = not tx.isStreaming and has_far_terms(tx)
    far = {"far_amount": _far("amount"), "far_score": _far("mlFraudScore")}
    more = f", {far['far_amount']} AS amountFar, {far['far_score']} AS scoreFar" if tx.isStreaming else "" if joined else _NO_FAR
    near = _NEAR_SQL.format(
        size=spec.size, near_amount=_near("amount"), odd_amount=_odd("amount"),
        near_score=_near("mlFraudScore"), odd_score=_odd("mlFraudScore"), more=more,
    )
    text = _HEAD.format(
        aggregate_type=cfg.SQL_AGGREGATE_TYPE, country=cfg.UNKNOWN_COUNTRY, category=cfg.UNKNOWN_CATEGORY,
        merchant=cfg.UNKNOWN_MERCHANT, parts=_PARTS, near=near,
    )
    if joined:
        text += _JOIN.format(
            far=_FAR_SQL.format(size=spec.size, is_far_amount=_is_far("amount"), is_far_score=_is_far("mlFraudScore"), **far)
        )
    found = tx.sparkSession.sql(text, transactions=tx)
    amount = S.total(F.col("amountNear"), F.col("amountOdd"), F.col("amountFar"))
    score = S.total(F.col("scoreNear"), F.col("scoreOdd"), F.col("scoreFar"))

    def mean(total: str, count: str) -> Column:
        return F.when(F.col(count) > 0, F.col(total) / F.col(count))

    return found.withColumn("_amount", amount).withColumn("_score", score).select(
        "aggregateType",
        "key",
        "windowStart",
        "windowEnd",
        F.col("n").alias("eventCount"),
        F.round("_amount", 2).alias("totalAmount"),
        F.round(mean("_amount", "amounts"), 2).alias("avgAmount"),
        F.round(mean("_score", "scores"), 4).alias("avgFraudScore"),
    )

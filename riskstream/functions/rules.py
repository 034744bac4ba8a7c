"""Fraud rules as boolean columns. Nulls and NaN never satisfy a limit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskstream import config as cfg
from riskstream.config import DEFAULT_THRESHOLDS, RiskThresholds
from riskstream.functions.expressions import equals_ignore_case


def reaches(value: Column, limit: float | int) -> Column:
    """value >= limit; Spark sorts NaN above all numbers, so it is shut out here."""
    return F.coalesce((value >= F.lit(limit)) & ~F.isnan(value), F.lit(False))


def may_be_high_risk(limits: RiskThresholds = DEFAULT_THRESHOLDS) -> Column:
    """True for every risky transaction, and for some others. Made of plain
    comparisons only, which file readers can take over."""
    least_score = min(limits.high_score, limits.failed_score)
    return (F.col("mlFraudScore") >= least_score) | (
        (F.col("amount") >= limits.high_amount) & (F.col("ipRisk") >= limits.high_ip_risk)
    )


def is_high_risk(limits: RiskThresholds = DEFAULT_THRESHOLDS, multiplier: Column | None = None) -> Column:
    """One transaction is risky by itself. A multiplier above 1 makes score and
    amount weigh more, as a merchant profile asks for."""
    score, amount, ip_risk = F.col("mlFraudScore"), F.col("amount"), F.col("ipRisk")
    if multiplier is not None:
        score, amount = score * multiplier, amount * multiplier
    risky_score = reaches(score, limits.high_score)
    risky_amount = reaches(amount, limits.high_amount) & reaches(ip_risk, limits.high_ip_risk)
    risky_failure = (
        equals_ignore_case(F.col("paymentStatus"), "FAILED")
        & reaches(score, limits.failed_score)
        & reaches(ip_risk, limits.failed_ip_risk)
    )
    return risky_score | risky_amount | risky_failure


def is_burst(count: Column, total: Column, limits: RiskThresholds = DEFAULT_THRESHOLDS) -> Column:
    return reaches(count, limits.burst_count) | reaches(total, limits.burst_amount)


def is_merchant_anomaly(
    count: Column, total: Column, avg_score: Column, limits: RiskThresholds = DEFAULT_THRESHOLDS
) -> Column:
    busy = reaches(count, limits.merchant_count)
    expensive = reaches(total, limits.merchant_amount)
    risky = reaches(count, limits.merchant_score_count) & reaches(avg_score, limits.merchant_score)
    return busy | expensive | risky


def is_replayable(error_type: Column) -> Column:
    return F.coalesce(error_type.isin(*cfg.REPLAYABLE_ERRORS), F.lit(False))

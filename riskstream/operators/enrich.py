"""Transactions joined with merchant risk profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.config import DEFAULT_THRESHOLDS, RiskThresholds
from riskstream.operators.alerts import high_risk_alerts
from riskstream.plans.lookup import BROADCAST_BYTES, lookup_join


def with_profiles(tx: DataFrame, profiles: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Left join by merchant; a merchant without profile has multiplier 1. A stream
    is joined with the profiles of its start."""
    lookup = profiles.select(
        F.col("merchant_id").alias("merchantId"), "risk_tier", "risk_multiplier", "manual_review_required"
    )
    joined = lookup_join(tx, lookup, "merchantId", ["eventId"], "left", broadcast_bytes)
    return joined.withColumn("risk_multiplier", F.coalesce(F.col("risk_multiplier").cast("double"), F.lit(1.0)))


def profiled_high_risk_alerts(enriched: DataFrame, limits: RiskThresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """High-risk alerts with score and amount weighed by the merchant's multiplier."""
    return high_risk_alerts(enriched, limits, multiplier=F.col("risk_multiplier"))

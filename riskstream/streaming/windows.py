"""Windowed results of a stream with Spark's own watermarks.

Two of the three ways to treat rows that come after a window's close:

- corrections: a new full value whenever a window changes (update mode), until
  the newest event is out-of-orderness + lateness past its end;
- final: one value per window, at that point (append mode).

The third, one result at the close and one per later row, is in `exact`.
Each function takes a stream of transactions and returns a streaming frame; the
output mode of the sink selects corrections or final results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskstream.config import DEFAULT_THRESHOLDS, MINUTE, RiskThresholds, WindowSpec
from riskstream.operators.aggregates import country_category_aggregates
from riskstream.operators.alerts import merchant_anomaly_alerts, user_burst_alerts
from riskstream.plans.sql import sql_aggregates

FINAL, CORRECTIONS = "append", "update"


def _in_time(tx: DataFrame, delay: str) -> DataFrame:
    return tx.withWatermark("event_ts", delay) if tx.isStreaming else tx


def stream_aggregates(tx: DataFrame, spec: WindowSpec = MINUTE) -> DataFrame:
    return country_category_aggregates(_in_time(tx, spec.full_delay), spec)


def stream_user_bursts(
    tx: DataFrame, spec: WindowSpec = MINUTE, limits: RiskThresholds = DEFAULT_THRESHOLDS
) -> DataFrame:
    return user_burst_alerts(_in_time(tx, spec.full_delay), spec, limits)


def stream_merchant_anomalies(
    tx: DataFrame, spec: WindowSpec = MINUTE, limits: RiskThresholds = DEFAULT_THRESHOLDS
) -> DataFrame:
    return merchant_anomaly_alerts(_in_time(tx, spec.full_delay), spec, limits)


def stream_sql_aggregates(tx: DataFrame, spec: WindowSpec = MINUTE) -> DataFrame:
    """No allowed lateness here: a window is done at the on-time watermark."""
    return sql_aggregates(_in_time(tx, spec.on_time_delay), spec)

"""The three fraud alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream import config as cfg
from riskstream.config import DEFAULT_THRESHOLDS, MINUTE, RiskThresholds, WindowSpec
from riskstream.functions import expressions as E
from riskstream.functions import rules as R
from riskstream.operators.aggregates import window_stats
from riskstream.plans.lookup import materialize
from riskstream.schemas import ALERT


def high_risk_alerts(
    tx: DataFrame,
    limits: RiskThresholds = DEFAULT_THRESHOLDS,
    multiplier: Column | None = None,
    random_ids: bool = False,
) -> DataFrame:
    """One alert per transaction that is risky by itself, late ones included."""
    kind = F.lit(cfg.ALERT_HIGH_RISK)
    if multiplier is None:
        tx = tx.filter(R.may_be_high_risk(limits))
    return tx.filter(R.is_high_risk(limits, multiplier)).select(
        E.alert_id(kind, F.col("userId"), F.col("eventTime"), F.col("eventId"), random_ids).alias("alertId"),
        kind.alias("alertType"),
        F.lit(cfg.SEVERITY_CRITICAL).alias("severity"),
        F.col("userId").alias("key"),
        F.lit(cfg.REASON_HIGH_RISK).alias("reason"),
        F.col("eventTime").alias("windowStart"),
        F.col("eventTime").alias("windowEnd"),
        F.col("eventTime").alias("eventTime"),
        F.col("mlFraudScore").alias("metricValue"),
        F.col("eventId").alias("sampleEventId"),
    )


def burst_records(
    stats: DataFrame, *extra: str, limits: RiskThresholds = DEFAULT_THRESHOLDS, random_ids: bool = False
) -> DataFrame:
    """Statistics per user that reach the burst limits, as alerts."""
    count, total = F.col("eventCount"), F.col("totalAmount")
    reason = F.concat(
        F.lit("user window exceeded count or amount threshold; count="),
        count.cast("string"),
        F.lit(", totalAmount="),
        E.two_digits(total),
    )
    return _window_alerts(
        stats.filter(R.is_burst(count, total, limits)),
        cfg.ALERT_USER_BURST,
        R.reaches(total, limits.burst_amount),
        reason,
        F.greatest(total, F.col("maxFraudScore")),
        extra,
        random_ids,
    )


def anomaly_records(
    stats: DataFrame, *extra: str, limits: RiskThresholds = DEFAULT_THRESHOLDS, random_ids: bool = False
) -> DataFrame:
    """Statistics per merchant that reach the anomaly limits, as alerts."""
    count, total = F.col("eventCount"), F.col("totalAmount")
    average = E.ratio(F.col("totalFraudScore"), count)
    reason = F.concat(
        F.lit("merchant window anomaly; count="),
        count.cast("string"),
        F.lit(", totalAmount="),
        E.two_digits(total),
        F.lit(", avgFraudScore="),
        E.four_digits(average),
    )
    return _window_alerts(
        stats.filter(R.is_merchant_anomaly(count, total, average, limits)),
        cfg.ALERT_MERCHANT,
        R.reaches(average, limits.merchant_score),
        reason,
        F.greatest(total, average),
        extra,
        random_ids,
    )


def _window_alerts(
    stats: DataFrame,
    alert_type: str,
    critical: Column,
    reason: Column,
    metric: Column,
    extra: tuple[str, ...],
    random_ids: bool,
) -> DataFrame:
    kind = F.lit(alert_type)
    return stats.select(
        E.alert_id(kind, F.col("key"), F.col("windowStart"), F.col("sampleEventId"), random_ids).alias("alertId"),
        kind.alias("alertType"),
        F.when(critical, cfg.SEVERITY_CRITICAL).otherwise(cfg.SEVERITY_WARN).alias("severity"),
        "key",
        reason.alias("reason"),
        "windowStart",
        "windowEnd",
        F.col("windowEnd").alias("eventTime"),
        metric.alias("metricValue"),
        "sampleEventId",
        *extra,
    )


def with_first_event(stats: DataFrame, tx: DataFrame) -> DataFrame:
    """Resolve `samplePosition` to the eventId at that position of the log.

    Positions are unique, as they hold the topic, so the join has no hot key, and
    only the columns of a position are read again. Every position comes from the
    table itself, so an inner join loses nothing and lets Spark send the few
    statistics that alert to the table. Callers filter the statistics first.
    """
    ids = tx.select(E.position(tx).alias("samplePosition"), F.col("eventId").alias("sampleEventId"))
    return stats.join(ids, "samplePosition").drop("samplePosition")


def _burst(limits: RiskThresholds) -> Column:
    return R.is_burst(F.col("eventCount"), F.col("totalAmount"), limits)


def _anomaly(limits: RiskThresholds) -> Column:
    count, total = F.col("eventCount"), F.col("totalAmount")
    return R.is_merchant_anomaly(count, total, E.ratio(F.col("totalFraudScore"), count), limits)


def _window_keys() -> dict[str, Column]:
    """Whose windows raise alerts."""
    return {"user": F.col("userId"), "merchant": E.merchant_key()}


def _alerting_stats(tx: DataFrame, key: Column, spec: WindowSpec, rule: Column) -> DataFrame:
    if tx.isStreaming:
        return window_stats(tx, key, spec, first_event="id").filter(rule)
    return with_first_event(window_stats(tx, key, spec, first_event="position").filter(rule), tx)


def user_burst_alerts(
    tx: DataFrame,
    spec: WindowSpec = MINUTE,
    limits: RiskThresholds = DEFAULT_THRESHOLDS,
    random_ids: bool = False,
) -> DataFrame:
    stats = _alerting_stats(tx, F.col("userId"), spec, _burst(limits))
    return burst_records(stats, limits=limits, random_ids=random_ids)


def merchant_anomaly_alerts(
    tx: DataFrame,
    spec: WindowSpec = MINUTE,
    limits: RiskThresholds = DEFAULT_THRESHOLDS,
    random_ids: bool = False,
) -> DataFrame:
    stats = _alerting_stats(tx, E.merchant_key(), spec, _anomaly(limits))
    return anomaly_records(stats, limits=limits, random_ids=random_ids)


def fraud_alerts(
    tx: DataFrame,
    spec: WindowSpec = MINUTE,
    limits: RiskThresholds = DEFAULT_THRESHOLDS,
    random_ids: bool = False,
) -> DataFrame:
    """All alerts of a bounded table. A stream runs one query per kind instead.

    Users and merchants are summed in one aggregate, with a row for each of both per
    transaction, and the first events of all window alerts are looked up at once.
    """
    keys = F.array(*[F.struct(F.lit(kind).alias("kind"), key.alias("key")) for kind, key in _window_keys().items()])
    stats = window_stats(tx.withColumn("_keyed", F.explode(keys)), F.col("_keyed"), spec, first_event="position")
    stats = stats.select(F.col("key.kind").alias("_kind"), F.col("key.key").alias("key"), *[c for c in stats.columns if c != "key"])
    stats = stats.filter(F.when(F.col("_kind") == "user", _burst(limits)).otherwise(_anomaly(limits)))
    found = materialize(with_first_event(stats, tx))
    windows = burst_records(found.filter("_kind = 'user'"), limits=limits, random_ids=random_ids).unionByName(
        anomaly_records(found.filter("_kind = 'merchant'"), limits=limits, random_ids=random_ids)
    )
    single = high_risk_alerts(tx, limits, random_ids=random_ids)
    return single.select(*ALERT.fieldNames()).unionByName(windows.select(*ALERT.fieldNames()))

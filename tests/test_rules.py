import pytest
from pyspark.sql import functions as F

from riskstream.operators import alerts

from riskstream.config import RiskThresholds
from riskstream.functions import rules as R

NAN = float("nan")


@pytest.mark.parametrize(
    ("score", "amount", "ip_risk", "status", "expected"),
    [
        (0.95, 20.0, 10, "APPROVED", True),
        (0.92, 20.0, 10, "APPROVED", True),
        (0.9199, 20.0, 10, "APPROVED", False),
        (0.2, 1500.0, 90, "APPROVED", True),
        (0.2, 1000.0, 80, "APPROVED", True),
        (0.2, 1000.0, 79, "APPROVED", False),
        (0.2, 999.99, 80, "APPROVED", False),
        (0.2, 20.0, 10, "APPROVED", False),
        (0.85, 20.0, 70, "FAILED", True),
        (0.85, 20.0, 70, "failed", True),
        (0.85, 20.0, 70, "Failed", True),
        (0.85, 20.0, 70, None, False),
        (0.85, 20.0, 69, "FAILED", False),
        (0.8499, 20.0, 70, "FAILED", False),
        (NAN, NAN, 100, "FAILED", False),
        (None, None, None, None, False),
    ],
)
def test_high_risk(spark, score, amount, ip_risk, status, expected):
    row = spark.createDataFrame(
        [(score, amount, ip_risk, status)], "mlFraudScore double, amount double, ipRisk int, paymentStatus string"
    )
    assert row.select(R.is_high_risk()).first()[0] is expected


def test_high_risk_weighed_by_multiplier(spark):
    rows = spark.createDataFrame(
        [(0.6, 20.0, 10, "APPROVED", 1.7), (0.6, 20.0, 10, "APPROVED", 1.0), (0.95, 20.0, 10, "APPROVED", 0.9)],
        "mlFraudScore double, amount double, ipRisk int, paymentStatus string, m double",
    )
    assert [r[0] for r in rows.select(R.is_high_risk(multiplier=F.col("m"))).collect()] == [True, False, False]


@pytest.mark.parametrize(
    ("count", "total", "expected"),
    [(5, 100.0, True), (1, 3000.0, True), (4, 2999.99, False), (1, NAN, False), (5, NAN, True)],
)
def test_burst(spark, count, total, expected):
    assert spark.range(1).select(R.is_burst(F.lit(count), F.lit(total))).first()[0] is expected


@pytest.mark.parametrize(
    ("count", "total", "avg", "expected"),
    [
        (25, 100.0, 0.1, True),
        (2, 15000.0, 0.1, True),
        (5, 100.0, 0.72, True),
        (4, 14999.99, 0.71, False),
        (4, 100.0, 0.99, False),
        (24, 14999.99, 0.7199, False),
        (24, NAN, NAN, False),
    ],
)
def test_merchant_anomaly(spark, count, total, avg, expected):
    rule = R.is_merchant_anomaly(F.lit(count), F.lit(total), F.lit(avg))
    assert spark.range(1).select(rule).first()[0] is expected


def test_replayable(spark):
    rows = spark.createDataFrame(
        [("PARSE_OR_VALIDATION_ERROR",), ("LATE_EVENT",), ("POISON_PILL",), (None,)], "e string"
    )
    assert [r[0] for r in rows.select(R.is_replayable(F.col("e"))).collect()] == [True, True, False, False]


def test_thresholds_can_be_tuned(spark):
    limits = RiskThresholds(burst_count=2)
    assert spark.range(1).select(R.is_burst(F.lit(2), F.lit(1.0), limits)).first()[0] is True


def test_two_topics_give_one_alert_per_user(spark):
    """Rows of two topics may have the same partition and offset."""
    rows = [(topic, 0, 0, f"e-{user}", user, 5_000.0) for topic, user in (("transactions.raw", "u"), ("transactions.replay", "v"))]
    tx = spark.createDataFrame(rows, "topic string, partition int, offset bigint, eventId string, userId string, amount double")
    tx = tx.withColumns({"mlFraudScore": F.lit(0.1), "event_ts": F.timestamp_millis(F.lit(60_000))})
    found = alerts.user_burst_alerts(tx).collect()
    assert sorted((r.key, r.sampleEventId) for r in found) == [("u", "e-u"), ("v", "e-v")]


def test_burst_limit_is_not_reached_by_rounding(spark):
    rows = [("e", "u", 0, 0, 2999.9999997)]
    tx = spark.createDataFrame(rows, "eventId string, userId string, partition int, offset bigint, amount double")
    tx = tx.withColumns({"mlFraudScore": F.lit(0.1), "event_ts": F.timestamp_millis(F.lit(60_000))})
    assert alerts.user_burst_alerts(tx).count() == 0

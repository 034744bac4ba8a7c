import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from riskstream.functions import expressions as E


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    ("text", "blank"),
    [(None, True), ("", True), ("  ", True), ("\t\n ", True), (" ", True), (" ", False), ("x", False), (" x ", False)],
)
def test_blank(spark, text, blank):
    assert value(spark, E.is_blank(F.lit(text).cast("string"))) is blank


@pytest.mark.parametrize(
    ("number", "expected"), [(1.005, 1.0), (2.675, 2.68), (-0.005, 0.0), (0.125, 0.13), (1e300, 92233720368547758.07)]
)
def test_round_half_up(spark, number, expected):
    assert value(spark, E.round_half_up(F.lit(number))) == pytest.approx(expected, abs=1e-9)


def test_round_half_up_of_nan_is_zero(spark):
    assert value(spark, E.round_half_up(F.lit(float("nan")))) == 0.0


def test_ratio_of_nothing_is_zero(spark):
    assert value(spark, E.ratio(F.lit(3.0), F.lit(0))) == 0.0


def test_keys(spark):
    rows = spark.createDataFrame(
        [(None, None, None), (" ", "", "\t"), ("KR", "gaming", "m")], "country string, category string, merchantId string"
    )
    got = rows.select(E.aggregate_key(), E.merchant_key(), E.coalesced_key()).collect()
    assert [tuple(r) for r in got] == [
        ("UNKNOWN|uncategorized|merchant-unknown", "merchant-unknown", "UNKNOWN|uncategorized|merchant-unknown"),
        ("UNKNOWN|uncategorized|merchant-unknown", "merchant-unknown", " ||\t"),
        ("KR|gaming|m", "m", "KR|gaming|m"),
    ]


def test_alert_id_is_stable_or_random(spark):
    args = (F.lit("T"), F.lit("k"), F.lit(5), F.lit("e"))
    assert value(spark, E.alert_id(*args)) == value(spark, E.alert_id(*args))
    assert value(spark, E.alert_id(*args, random=True)) != value(spark, E.alert_id(*args, random=True))


def test_position_orders_by_partition_then_offset(spark):
    rows = spark.createDataFrame([(1, 0), (0, 5), (0, 4)], "partition int, offset bigint")
    got = rows.withColumn("p", E.position(rows)).orderBy("p").collect()
    assert [(r.partition, r.offset) for r in got] == [(0, 4), (0, 5), (1, 0)]


def test_position_tells_topics_apart(spark):
    rows = spark.createDataFrame(
        [("transactions.replay", 0, 0), ("transactions.raw", 0, 0), ("transactions.raw", 1, 0)], "topic string, partition int, offset bigint"
    )
    assert rows.select(E.position(rows)).distinct().count() == 3
    other = rows.withColumn("topic", F.lit("alerts.fraud"))
    with pytest.raises(PySparkException):
        other.select(E.position(other)).collect()


def test_position_refuses_what_does_not_fit(spark):
    rows = spark.createDataFrame([(0, 1 << 44)], "partition int, offset bigint")
    with pytest.raises(PySparkException):
        rows.select(E.position(rows)).collect()


def test_event_timestamp_out_of_range_is_null(spark):
    assert value(spark, E.event_timestamp(F.lit(2**63 - 1))) is None
    assert value(spark, F.unix_millis(E.event_timestamp(F.lit(1_760_000_000_123)))) == 1_760_000_000_123

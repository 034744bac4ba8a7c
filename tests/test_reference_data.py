import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from riskstream.operators import changelog, enrich
from riskstream.plans.lookup import lookup_join, size_in_bytes
from riskstream.sources.logs import text_log

PROFILE = '{"merchant_id":"%s","risk_tier":"%s","risk_multiplier":%s,"manual_review_required":%s,"updated_at":"2026-06-22T10:00:00Z","__op":"%s","__source_ts_ms":%d}'
CHANGES = [
    PROFILE % ("tea-house", "MEDIUM", "1.310", "false", "r", 100),
    PROFILE % ("book-barn", "LOW", "0.455", "true", "r", 100),
    PROFILE % ("kiosk-9", "HIGH", "2.250", "true", "r", 100),
    PROFILE % ("tea-house", "HIGH", "1.625", "true", "u", 340),
    PROFILE % ("kiosk-9", "HIGH", "2.250", "true", "d", 340),
    # equal times: the later place in the log wins
    PROFILE % ("ferry", "LOW", "0.750", "false", "u", 340),
    PROFILE % ("ferry", "MEDIUM", "1.125", "false", "u", 340),
    # damaged images do not take the place of a good one
    PROFILE % ("tea-house", "LOW", '"abc"', "false", "u", 900),
    PROFILE % ("tea-house", "LOW", "123456789.5", "false", "u", 900),
    '{"merchant_id":"tea-house","risk_tier":"LOW","__op":"u","__source_ts_ms":900}',
    '{"merchant_id":"tea-house","risk_tier":',
    None,
    # a delete needs no image
    PROFILE % ("gone", "LOW", "1.0", "false", "r", 100),
    '{"merchant_id":"gone","__op":"d","__source_ts_ms":200}',
]


@pytest.fixture
def changes(spark):
    rows = [(0, i, v) for i, v in enumerate(CHANGES)]
    return changelog.read_changes(
        text_log(spark.createDataFrame(rows, "partition int, offset bigint, value string"), "merchant_risk_profiles")
    )


def tiers(df):
    return {r.merchant_id: (r.risk_tier, float(r.risk_multiplier)) for r in df.collect()}


def test_last_change_wins_and_deletes_remove(changes):
    assert changes.count() == 9
    assert tiers(changelog.current_state(changes)) == {
        "tea-house": ("HIGH", 1.625),
        "book-barn": ("LOW", 0.455),
        "ferry": ("MEDIUM", 1.125),
    }


def test_upsert(spark, changes):
    incoming = spark.createDataFrame(
        [("book-barn", "HIGH", True), ("new-stall", "LOW", False)],
        "merchant_id string, risk_tier string, manual_review_required boolean",
    ).withColumn("risk_multiplier", F.lit(2).cast("decimal(6,3)"))
    now = F.timestamp_millis(F.lit(1000))
    merged = changelog.upsert(changelog.current_state(changes), incoming, now)
    assert tiers(merged) == {
        "tea-house": ("HIGH", 1.625),
        "book-barn": ("HIGH", 2.0),
        "ferry": ("MEDIUM", 1.125),
        "new-stall": ("LOW", 2.0),
    }
    stamped = merged.filter(F.unix_millis("updated_at") == 1000)
    assert sorted(r.merchant_id for r in stamped.collect()) == ["book-barn", "new-stall"]


def test_upsert_refuses_two_rows_for_a_key(changes):
    current = changelog.current_state(changes)
    twice = current.unionByName(current).drop("updated_at")
    with pytest.raises(PySparkException):
        changelog.upsert(current, twice, F.current_timestamp()).collect()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_is_the_same_both_ways(spark, how):
    facts = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50).alias("k")
    )
    lookup = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    small = lookup_join(facts, lookup, "k", ["id"], how)
    large = lookup_join(facts, lookup, "k", ["id"], how, broadcast_bytes=5)
    assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0
    assert large.columns == small.columns


def test_hot_keys_alone_get_salts(spark):
    facts = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"))
    joined = lookup_join(facts, spark.range(4000).select(F.col("id").alias("k"), F.lit(1).alias("v")), "k", ["id"], broadcast_bytes=5)
    assert joined.count() == 4000 and joined.agg(F.sum("v")).first()[0] == 4000
    assert size_in_bytes(facts) > 4000 * 8


def test_latest_place_in_the_log_wins(spark):
    rows = [("a", None, 0, 9, "u", 1), ("a", 5, 1, 2, "u", 2), ("a", 5, 1, 3, "u", 3), ("a", 5, 0, 8, "u", 4), ("b", None, 0, 1, "u", 5), ("c", -7, 0, 2, "u", 6), ("c", 2**62, 0, 0, "u", 7)]
    log = spark.createDataFrame(rows, "merchant_id string, source_ts_ms bigint, partition int, offset bigint, op string, v int")
    got = changelog.current_state(log, fields=["merchant_id", "v"]).collect()
    assert sorted(map(tuple, got)) == [("a", 3), ("b", 5), ("c", 7)]


def test_profiles_scale_the_rules(spark, changes):
    tx = spark.createDataFrame(
        [("e1", "u", "tea-house", 0.6, 1.0), ("e2", "u", "book-barn", 0.95, 1.0), ("e3", "u", None, 0.95, 1.0)],
        "eventId string, userId string, merchantId string, mlFraudScore double, amount double",
    ).withColumns({"ipRisk": F.lit(1), "paymentStatus": F.lit("APPROVED"), "eventTime": F.lit(5).cast("bigint")})
    enriched = enrich.with_profiles(tx, changelog.current_state(changes))
    assert {r.eventId: r.risk_multiplier for r in enriched.collect()} == {"e1": 1.625, "e2": 0.455, "e3": 1.0}
    assert {r.sampleEventId for r in enrich.profiled_high_risk_alerts(enriched).collect()} == {"e1", "e3"}

"""What the physical plans must look like to hold at scale."""

import tempfile

import pytest
from pyspark.sql import functions as F

from riskstream.catalog import inputs as I
from riskstream.catalog.queries import QUERIES
from riskstream.functions import expressions as E
from riskstream.operators import aggregates, alerts, emissions, late, parse
from riskstream.plans.lookup import lookup_join
from riskstream.plans.pipeline import analyze_log
from riskstream.sources.logs import merge_topics

BATCH = sorted(name for name in QUERIES if not name.startswith("stream_"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark, sf_dir):
    folder = tempfile.mkdtemp(prefix="run-plans-")
    return analyze_log(I.raw_log(spark, sf_dir), folder).transactions


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize(
    "name",
    [
        "aggregates_minute",
        "aggregates_daily",
        "user_bursts_minute",
        "merchant_anomalies_daily",
        "user_window_stats",
        "sql_aggregates_minute",
        "aggregate_emissions",
        "burst_emissions",
        "anomaly_emissions",
        "window_emissions",
        "topic_totals",
        "merchant_profiles",
        "merchant_profiles_after_upsert",
    ],
)
def test_aggregates_hash(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "HashAggregate" in text and "SortAggregate" not in text


@pytest.mark.parametrize("name", ["aggregate_emissions", "burst_emissions", "anomaly_emissions", "window_emissions"])
def test_emissions_read_the_events_twice_at_most(spark, sf_dir, name):
    assert plan(QUERIES[name](spark, sf_dir)).count("FileScan") <= 2


def test_partial_aggregation_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["aggregates_minute"](spark, sf_dir))
    assert text.count("Exchange") == 1
    assert text.index("Exchange") < text.index("partial_count")


def test_records_are_read_once(spark, sf_dir):
    frame = parse.valid_transactions(parse.parse_transactions(I.raw_log(spark, sf_dir))).filter("amount > 5")
    assert plan(frame).count("from_json(StructField(eventId,StringType") == 1


def test_filters_and_columns_reach_the_files(landed):
    text = plan(alerts.high_risk_alerts(landed))
    assert "GreaterThanOrEqual(mlFraudScore,0.85)" in text
    assert "accepted" in text.split("PartitionFilters")[1][:200]
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "deviceId" not in schema and "rawValue" not in schema and "country" not in schema


def test_aggregate_reads_only_its_columns(landed):
    text = plan(aggregates.country_category_aggregates(landed))
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    for name in ("eventId", "userId", "currency", "deviceId", "rawValue", "ipRisk"):
        assert name not in schema


@pytest.mark.parametrize("name", ["transactions_with_profiles", "profiled_high_risk_alerts"])
def test_profiles_are_computed_once(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "BroadcastHashJoin" in text and text.count("FileScan") == 1 and "from_json" not in text


def test_large_lookup_is_not_broadcast(spark):
    facts = spark.range(1000).withColumn("k", F.col("id") % 10)
    lookup = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("v")).repartition(3)
    assert "_salt" in plan(lookup_join(facts, lookup, "k", ["id"], broadcast_bytes=5))
    assert "_salt" not in plan(lookup_join(facts, lookup, "k", ["id"]))


def test_merged_topics_have_distinct_partitions(spark):
    rows = spark.createDataFrame(
        [("a", 0, 1), ("b", 0, 1), ("a", 1, 1), ("c", 0, 1)], "topic string, partition int, offset bigint"
    )
    got = {(r.topic, r.partition) for r in merge_topics(rows, "a", "b").collect()}
    assert got == {("a", 0), ("b", 1), ("a", 2)}


def test_hot_group_of_later_rows_is_cut_into_blocks(spark, sf_dir):
    stamped = late.stamp_watermark(I.batched(spark, sf_dir), I.LATE_SPEC)
    text = plan(emissions.window_emissions(stamped, E.merchant_key(), I.LATE_SPEC))
    assert "_block" in text

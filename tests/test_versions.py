import random

import pytest
from pyspark.sql import functions as F

from riskstream.operators import changelog, snapshots, versions
from riskstream.schemas import PROFILE_CHANGE
from riskstream.sources.logs import text_log

TIERS = ["LOW", "MEDIUM", "HIGH"]


@pytest.fixture(scope="module")
def case():
    """Merchants with many versions, one hot; equal times, changes without time, deletes, negative and far times."""
    rng = random.Random(6)
    changes = []
    for offset in range(300):
        merchant = rng.choice(["hot", "hot", "hot", *[f"m{i}" for i in range(8)]])
        at = rng.choice([None, rng.randint(-50, 1000), rng.randint(0, 100_000)])
        changes.append((merchant, rng.choice(TIERS), offset / 100, rng.random() < 0.5, rng.choice("ucd"), at, offset % 2, offset))
    events = []
    for i in range(900):
        merchant = rng.choice(["hot", "hot", "hot", None, "none", *[f"m{i}" for i in range(8)]])
        events.append((f"e{i}", merchant, rng.choice([rng.randint(-100, 1100), rng.randint(0, 120_000)])))
    return changes, events


def expected(changes, events):
    out = {}
    for event, merchant, time in events:
        own = [c for c in changes if c[0] == merchant and (c[5] is None or c[5] <= time)]
        last = max(own, key=lambda c: (c[5] is not None, c[5] or 0, c[6], c[7]), default=None)
        out[event] = (last[1], last[2], last[3]) if last and last[4] != "d" else (None, 1.0, None)
    return out


@pytest.mark.parametrize(("block", "share"), [(versions.BLOCK_MS, versions.SHARE), (100, 3), (7, 10)])
def test_profile_as_of_the_event(spark, case, block, share):
    changes, events = case
    schema = "merchant_id string, risk_tier string, risk_multiplier double, manual_review_required boolean, op string, source_ts_ms bigint, partition int, offset bigint"
    change_rows = spark.createDataFrame(changes, schema).withColumn("risk_multiplier", F.col("risk_multiplier").cast(PROFILE_CHANGE["risk_multiplier"].dataType))
    tx = spark.createDataFrame(events, "eventId string, merchantId string, eventTime bigint").repartition(3)
    found = versions.with_profiles_as_of(tx, change_rows, block, share).collect()
    assert len(found) == len(events)
    assert {r.eventId: (r.risk_tier, r.risk_multiplier, r.manual_review_required) for r in found} == expected(changes, events)


def change(merchant, tier, op, at):
    return (
        f'{{"merchant_id":"{merchant}","risk_tier":"{tier}","risk_multiplier":1.5,"manual_review_required":false,'
        f'"updated_at":"2026-06-22T10:00:00Z","__op":"{op}","__source_ts_ms":{at}}}'
    )


def log_of(spark, rows):
    return text_log(spark.createDataFrame(rows, "partition int, offset bigint, value string"), "merchant_risk_profiles")


def test_snapshots_equal_a_full_fold(spark, tmp_path):
    """Increments with deletes, changes of an older time, a new partition, an empty one and a run that died half way."""
    rng = random.Random(2)
    rows = [(i % 2, i // 2, change(f"m{rng.randrange(9)}", rng.choice(TIERS), rng.choice("uuucd"), rng.randrange(50))) for i in range(120)]
    rows += [(2, i, change(f"m{rng.randrange(12)}", "LOW", "u", rng.randrange(80))) for i in range(20)] + [(0, 500, None)]
    folder, seen = str(tmp_path / "snapshots"), []
    assert snapshots.advance(log_of(spark, [(0, 0, None)]).limit(0), folder) is None
    for part in (rows[:40], rows[40:41], [], rows[41:120], rows[120:]):
        seen += part
        if len(seen) == 120:
            log_of(spark, seen).write.parquet(f"{folder}/images-3")
        found = snapshots.advance(log_of(spark, seen), folder)
        full = changelog.current_state(changelog.read_changes(log_of(spark, seen)))
        assert sorted(map(tuple, found.state().collect())) == sorted(map(tuple, full.select(*found.state().columns).collect()))
    assert found.number == 4 and found.marks == {0: 500, 1: 59, 2: 19}


def test_only_the_tail_is_read(spark, tmp_path):
    log_of(spark, [(p, o, None) for p in (0, 1) for o in range(50)]).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    tail = snapshots.after(log, {0: 39, 1: 44})
    assert "GreaterThan(offset,39)" in tail._jdf.queryExecution().executedPlan().toString()
    assert tail.count() == 15


def test_profiles_change_while_a_stream_runs(spark, tmp_path):
    schema = "merchant_id string, risk_tier string, risk_multiplier decimal(6,3), manual_review_required boolean, op string, source_ts_ms bigint, partition int, offset bigint"
    known = spark.createDataFrame([], schema)
    rows = spark.range(2).select(
        F.concat(F.lit("e"), F.col("id").cast("string")).alias("eventId"), F.lit("u").alias("userId"), F.lit("m").alias("merchantId"),
        (F.lit(100) + F.col("id")).alias("eventTime"), F.lit(600.0).alias("amount"), F.lit(0.5).alias("mlFraudScore"), F.lit(90).alias("ipRisk"), F.lit("OK").alias("paymentStatus"),
    )
    source = str(tmp_path / "events")
    counts = []
    for at in (None, 101):
        rows.coalesce(1).write.mode("append").parquet(source)
        if at:
            known = spark.createDataFrame([("m", "HIGH", 2, True, "u", at, 0, 0)], schema.replace("decimal(6,3)", "int"))
        current = known
        stream = spark.readStream.schema(rows.schema).parquet(source)
        query = versions.start_profiled_alerts(stream, lambda: current, str(tmp_path / "alerts"), str(tmp_path / "checkpoint"), available_now=True)  # noqa: B023
        query.awaitTermination()
        found = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "alerts"))
        counts.append(sorted(r.sampleEventId for r in found.collect()))
    assert counts == [[], ["e1"]]

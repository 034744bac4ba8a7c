"""Sums against whole numbers and fractions of Python, which are exact."""

import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from riskstream.functions import sums as S
from riskstream.operators.aggregates import window_stats
from riskstream.operators.emissions import window_emissions
from riskstream.plans.sql import sql_aggregates

MOST = 1.7976931348623157e308


def expected(terms):
    """Near terms count with twelve decimal places, far ones as they are; rounded once."""
    terms = [t for t in terms if t is not None]
    odd = [t for t in terms if not math.isfinite(t)]
    if odd or not terms:
        return sum(odd) if odd else None
    exact = sum(Fraction(int(t)) if abs(t) >= 2**53 else Fraction(Decimal(repr(t)).quantize(Decimal("1e-12"))) for t in terms)
    try:
        return float(exact)
    except OverflowError:
        return math.inf if exact > 0 else -math.inf


def cases():
    rng = random.Random(8)
    yield from [
        [0.1] * 10, [1e-7] * 4, [2e9 + 0.1, 0.2, -2e9, 1e12, 0.3, None], [1.0, math.inf, 2.0], [None], [math.inf, -math.inf], [math.nan, 1e300],
        [1e16, 1e300, 1e-7], [1e300, -1e300, 1e-7], [1e300, 1e16, -1e300, 0.25], [2.0**53, 0.5], [2.0**53, 0.5, 1e-12], [2.0**54, 2.0, 1e-12], [2.0**54, 2.0],
        [2.0**54, 6.0], [-(2.0**54), -2.0, -1e-12], [MOST, MOST], [-MOST, -MOST, 5.0], [MOST, MOST, -MOST], [MOST] * 3 + [-MOST] * 3 + [0.75], [2.0**60, -1.0],
        [2.0**120, -(2.0**60)], [2.0**120, 2.0**67, 1.0], [2.0**120, 2.0**67], [1e22, 1e-12], [2.0**83, 0.5, -0.5], [9e15, 9e15, 0.1],
    ]
    for _ in range(60):
        terms = [rng.choice([1, 1, 1, -1]) * rng.random() * 10.0 ** rng.uniform(-9, rng.choice([3, 17, 40, 308])) for _ in range(rng.randint(1, 30))]
        yield terms + [-t for t in terms if rng.random() < 0.3]


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def test_total_of_every_finite_double(spark):
    every = list(cases())
    rng = random.Random(2)
    rows = [(i, t) for i, terms in enumerate(every) for t in rng.sample(terms, len(terms))]
    df = spark.createDataFrame(rows, "i int, x double").repartition(5)
    x = F.col("x")
    limbs = [limb.alias(f"far{n}") for n, limb in enumerate(S.far_sums(x))]
    sums = df.groupBy("i").agg(S.near_sum(x).alias("near"), S.odd_sum(x).alias("odd"), *limbs)
    assert "HashAggregate" in sums._jdf.queryExecution().executedPlan().toString()
    far = S.far_array([F.col(f"far{n}") for n in range(S.FAR_LIMBS)])
    found = dict(sums.select("i", S.total(F.col("near"), F.col("odd"), far)).collect())
    wrong = {i: (terms, found[i], expected(terms)) for i, terms in enumerate(every) if not same(found[i], expected(terms))}
    assert not wrong


@pytest.fixture
def payments(spark):
    amounts = [("a", 1e16), ("a", 1e300), ("a", 1e-7), ("b", 12.5), ("b", 2.0**53), ("b", 0.5), ("c", 3.0), (None, 1e20), (None, 0.25)]
    rows = [(f"e{i}", user, amount, -1e18 if user == "c" else 0.5, i) for i, (user, amount) in enumerate(amounts)]
    df = spark.createDataFrame(rows, "eventId string, userId string, amount double, mlFraudScore double, offset bigint")
    return df.select(
        "*", F.lit(0).alias("partition"), F.lit("C1").alias("country"), F.col("userId").alias("category"), F.lit("m").alias("merchantId"),
        F.timestamp_millis(F.lit(1000)).alias("event_ts"), F.lit(1000).cast("bigint").alias("eventTime"),
    )


def totals(payments):
    groups = {}
    for r in payments.collect():
        groups.setdefault(r.userId, []).append(r)
    return {user: (expected([r.amount for r in rows]), expected([r.mlFraudScore for r in rows])) for user, rows in groups.items()}


def test_batch_and_sql(spark, payments):
    for rows in (payments, payments.orderBy(F.desc("offset")).repartition(3)):
        found = window_stats(rows, F.col("userId"), first_event="position").collect()
        assert {r.key: (r.totalAmount, r.totalFraudScore) for r in found} == totals(payments)
        found = {r.key.split("|")[1]: r.totalAmount for r in sql_aggregates(rows).collect()}
        assert found == {user or "uncategorized": round(amount, 2) for user, (amount, _) in totals(payments).items()}


@pytest.mark.parametrize("far", [True, False])
def test_emissions(payments, far):
    """The first row of each user comes before the close, the others after it, one by one."""
    rows = payments if far else payments.withColumn("amount", F.least("amount", F.lit(7.5))).withColumn("mlFraudScore", F.lit(0.5))
    stamped = rows.withColumn("batch_id", F.col("offset")).withColumn("watermark", F.when(F.col("offset") % 3 > 0, 70_000).otherwise(0))
    sums = {}
    for r in stamped.orderBy("offset").collect():
        if r.offset % 3:
            sums[r.offset] = expected([x.amount for x in stamped.collect() if x.userId == r.userId and (x.offset <= r.offset or not x.offset % 3)])
    found = {r.offset: r.totalAmount for r in window_emissions(stamped, F.col("userId")).collect() if r.kind == "REFIRE" and r.key}
    assert found == {k: v for k, v in sums.items() if k < 7}


def test_stream_modes(spark, payments, tmp_path):
    """One stream with far terms, in update and in append mode, and the row by row mode."""
    from riskstream.streaming.exact import exact_emissions, use_disk_state

    use_disk_state(spark)
    last = payments.limit(1).withColumn("event_ts", F.timestamp_millis(F.lit(10_000_000))).withColumn("eventTime", F.lit(10_000_000).cast("bigint"))
    rows = payments.filter("userId is not null").unionByName(last.withColumn("userId", F.lit("last")))
    rows.withColumn("batch_id", F.lit(0)).withColumn("watermark", F.lit(0).cast("bigint")).coalesce(1).write.parquet(str(tmp_path / "rows"))
    source = spark.readStream.schema(spark.read.parquet(str(tmp_path / "rows")).schema).parquet(str(tmp_path / "rows"))
    stats = window_stats(source.withWatermark("event_ts", "40 seconds"), F.col("userId"), first_event="id")
    frames = {"append": (stats, "append"), "update": (stats, "update"), "exact": (exact_emissions(source, F.col("userId")), "append")}
    want = {user: total for user, total in totals(payments).items() if user}
    for name, (frame, mode) in frames.items():
        query = frame.writeStream.format("memory").queryName(f"far_{name}").outputMode(mode).option("checkpointLocation", str(tmp_path / name))
        started = query.trigger(availableNow=True).start()
        started.awaitTermination()
        found = {r.key: (r.totalAmount, r.totalFraudScore) for r in spark.table(f"far_{name}").collect() if r.key != "last"}
        assert found == want, name

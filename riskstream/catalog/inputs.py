"""Inputs of the registered queries, all derived from the whole `events` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream import config as cfg
from riskstream.config import DEFAULT_TOPICS, RiskThresholds, WindowSpec
from riskstream.functions.expressions import JSON_WRITE, event_timestamp
from riskstream.operators.contracts import DEFAULTS
from riskstream.operators.evolution import published
from riskstream.schemas import TRANSACTION, TRANSACTION_FIELDS
from riskstream.sources.events import raw_log_from_events, read_events, transactions_from_events

# instants that stand for "now" in checked queries
OBSERVED_AT = 1_735_689_600_000
BATCH_EVENTS = 100
# limits that the sparse test events reach within a minute
LOW_LIMITS = RiskThresholds(merchant_count=3, merchant_amount=19_000.0, merchant_score_count=1, merchant_score=0.9)
DAY_MS, HOUR_MS = 86_400_000, 3_600_000

# wide window and delays, to match the sparse test events
LATE_SPEC = WindowSpec(size_ms=DAY_MS, out_of_orderness_ms=HOUR_MS, allowed_lateness_ms=12 * HOUR_MS)
# the same for a log that arrives in a few large batches
JOB_SPEC = WindowSpec(size_ms=DAY_MS, out_of_orderness_ms=HOUR_MS, allowed_lateness_ms=48 * HOUR_MS)
JOB_BATCHES = 3


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the tables hold UTC times without zone
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return read_events(spark, sf_dir)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(events(spark, sf_dir)).drop("event_id")


def far_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions, with amounts that are multiples of 2**960 in one of 50 and of 2**54 in another."""
    n = F.col("event_id")
    amount = F.when(n % 50 == 0, (n % 7 + 1) * 2.0**960).when(n % 50 == 1, (n % 9) * 2.0**54).otherwise(F.col("amount"))
    return transactions_from_events(events(spark, sf_dir)).withColumn("amount", amount).drop("event_id")


def transaction_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same transactions, read as a stream of files."""
    schema = events(spark, sf_dir).schema
    # a pattern, because a stream takes a folder or a pattern but no single file
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    return transactions_from_events(stream).drop("event_id")


#: Events per task at most, once they are spread; as JSON records they are some 20 times the table's bytes.
ROWS_PER_TASK = 250_000


def spread(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """A small file comes as one partition, and would be parsed by one task. Partitions
    are split by compressed bytes, so a large table has too few for the records made
    of it: there are a partition per core at least, and one per `rows_per_task` rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = max(cores, -(-df.count() // rows_per_task))
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_log_from_events(spread(events(spark, sf_dir)), DEFAULT_TOPICS.raw).drop("event_id")


def arriving_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log with the number of the batch in which a record arrives. A part
    comes on the replay topic, some records 30 hours late and a few 10 days."""
    rows, n = spread(events(spark, sf_dir)), F.col("event_id")
    delay = F.when(n % 149 == 0, 10 * 24).when(n % 13 == 0, 30).otherwise(0)
    rows = rows.withColumn("ts", F.col("ts") - F.make_interval(hours=delay))
    log = raw_log_from_events(rows, DEFAULT_TOPICS.raw)
    last = JOB_BATCHES - 1
    batch = F.least(F.floor(n * JOB_BATCHES / max(1, rows.count())), F.lit(last))
    topic = F.when(n % 7 == 0, DEFAULT_TOPICS.replay).otherwise(F.col("topic"))
    return log.withColumn("topic", topic).withColumn("batch_id", batch).drop("event_id")


def batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions in numbered batches; some come 8 hours late, a few 10 days."""
    n = F.col("event_id")
    delay = F.when(n % 149 == 0, 10 * DAY_MS).when(n % 11 == 0, 8 * HOUR_MS).otherwise(0)
    tx = transactions_from_events(events(spark, sf_dir))
    return (
        tx.withColumn("batch_id", F.floor(n / BATCH_EVENTS))
        .withColumn("eventTime", F.col("eventTime") - delay)
        .withColumn("event_ts", event_timestamp(F.col("eventTime")))
        .drop("event_id")
    )


def quarantine_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a quarantine record, damaged in one of sixteen ways."""
    n = F.col("event_id")
    case = n % 16
    tx = transactions_from_events(spread(events(spark, sf_dir)))
    changed = {
        "amount": F.when(case == 0, -F.col("amount")).otherwise(F.col("amount")),
        "eventId": F.when(case == 2, "").otherwise(F.col("eventId")),
        "userId": F.when(case == 15, "  ").otherwise(F.col("userId")),
    }
    text = F.to_json(F.struct(*[changed.get(c, F.col(c)).alias(c) for c in TRANSACTION_FIELDS]), JSON_WRITE)

    def joined(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    head = joined('{"eventId":"evt-', n, '","userId":"', F.col("userId"), '"')
    raw = (
        F.when(case == 1, F.substring(text, 1, 30))
        .when(case == 3, joined(head, ',"amount":null}'))
        .when(case == 4, joined(head, ',"amount":"abc"}'))
        .when(case == 5, joined("[", n, "]"))
        .when(case == 6, n.cast("string"))
        .when(case == 7, "")
        .when(case == 9, joined(head, ',"amount":', F.col("amount"), ',"traceId":"t-', n, '","attempt":', n % 5, "}"))
        .when(case == 10, joined(head, ',"amount":"', F.col("amount"), '","ipRisk":"', F.col("ipRisk"), '"}'))
        .when(case == 12, joined('{"mlFraudScore":', F.col("mlFraudScore"), "}"))
        .when(case == 13, joined(head, ',"ipRisk":null}'))
        .when(case == 14, joined(head, ',"country":{"code":"C1"}}'))
        .otherwise(text)
    )
    record = F.to_json(
        F.struct(
            F.when(case == 11, "POISON_PILL").otherwise(cfg.ERROR_PARSE).alias("errorType"),
            F.lit(cfg.REASON_MALFORMED).alias("reason"),
            F.lit(DEFAULT_TOPICS.raw).alias("sourceTopic"),
            F.lit(DEFAULT_TOPICS.replay).alias("replayTopic"),
            raw.alias("rawValue"),
            F.col("eventTime").alias("observedAt"),
        ),
        JSON_WRITE,
    )
    value = F.when(case == 8, joined("broken ", n)).otherwise(record)
    return tx.select(
        F.lit(DEFAULT_TOPICS.dlq).alias("topic"),
        F.lit(0).alias("partition"),
        n.alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(None).cast("binary").alias("key"),
        F.encode(value, "UTF-8").alias("value"),
    )


def damaged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a raw record, written in one of twenty-four ways, most of them odd."""
    tx = transactions_from_events(spread(events(spark, sf_dir)))
    n, time = F.col("event_id"), F.col("eventTime").cast("string")
    case, amount = n % 24, F.concat((n % 1000).cast("string"), F.lit(".5"))

    def joined(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    def record(rest=',"ipRisk":35', event_id=joined('"evt-', n, '"'), user='"u"', event_time=time, amount=amount):
        return joined('{"eventId":', event_id, ',"userId":', user, ',"eventTime":', event_time, ',"amount":', amount, rest, "}")

    odd = {
        1: record(',"ipRisk":"35"', event_time=joined('"', time, '"'), amount=joined('"', amount, '"')),
        2: record(',"ipRisk":35.7'),
        3: record(',"ipRisk":"35.7"'),
        4: joined('{"eventId":"evt-', n, '","userId":"u","eventTime":', time, "}"),
        5: record(amount="null"),
        6: record(amount='"abc"'),
        7: record(event_id='{"x":1}'),
        8: record(',"country":["KR"]'),
        9: record(event_id=n),
        10: joined(record(), " trailing"),
        11: record(joined(',"eventId":"again-', n, '"')),
        12: joined('{"EVENTID":"evt-', n, '","userId":"u","eventTime":', time, "}"),
        13: joined("[", record(), "]"),
        14: F.lit(""),
        15: record(event_time=joined(time, ".75")),
        16: record(event_time=joined('"', time, '.75"')),
        17: record(',"ipRisk":3000000000'),
        18: record(amount='""'),
        19: record(',"added":{"a":[1]}'),
        20: F.translate(record(), '"', "'"),
        21: record(user='" "', amount=joined("-", amount)),
        22: record(amount="true"),
        23: record(event_id=joined('"{x', n, '"')),
    }
    value = record()
    for which, text in odd.items():
        value = F.when(case == which, text).otherwise(value)
    return tx.select(
        F.lit(DEFAULT_TOPICS.raw).alias("topic"),
        F.lit(0).alias("partition"),
        n.alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(None).cast("binary").alias("key"),
        F.encode(value, "UTF-8").alias("value"),
    )


def activity_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of three topics in one table."""
    tx = transactions_from_events(events(spark, sf_dir))
    alerts = tx.select(
        F.lit(DEFAULT_TOPICS.alerts).alias("topic"),
        "partition",
        "offset",
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.encode("userId", "UTF-8").alias("key"),
        F.encode("eventId", "UTF-8").alias("value"),
    )
    return raw_log(spark, sf_dir).unionByName(quarantine_log(spark, sf_dir)).unionByName(alerts)


def committed_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of each raw partition is read, but partition 2 has no commit."""
    rows = raw_log(spark, sf_dir).filter("partition < 2")
    return rows.groupBy("topic", "partition").agg(F.floor(F.max("offset") / 2).alias("offset"))


def profile_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a change of the profile of one of 40 merchants."""
    n = F.col("event_id")
    tx = transactions_from_events(spread(events(spark, sf_dir)))
    merchant = F.when(n % 3 == 0, "shop-busy").otherwise(F.concat(F.lit("shop-"), n % 40))
    image = F.struct(
        merchant.alias("merchant_id"),
        F.get(F.array(F.lit("LOW"), F.lit("MEDIUM"), F.lit("HIGH")), (n % 7 % 3).cast("int")).alias("risk_tier"),
        ((n % 1500 + 500) / 1000).cast("decimal(6,3)").alias("risk_multiplier"),
        (n % 5 == 0).alias("manual_review_required"),
        F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("updated_at"),
        F.when(n % 97 == 0, "d").otherwise("u").alias("__op"),
        (F.col("eventTime") - F.col("eventTime") % HOUR_MS).alias("__source_ts_ms"),
    )
    return tx.select(
        F.lit(DEFAULT_TOPICS.profiles).alias("topic"),
        "partition",
        "offset",
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.encode(merchant, "UTF-8").alias("key"),
        F.encode(F.to_json(image, JSON_WRITE), "UTF-8").alias("value"),
    )


def supplier_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New profiles for one merchant per supplier."""
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    return supplier.select(
        F.concat(F.lit("shop-"), F.col("s_suppkey")).alias("merchant_id"),
        F.when(F.col("s_acctbal") < 0, "HIGH").otherwise("LOW").alias("risk_tier"),
        ((F.col("s_suppkey") % 1000 + 700) / 1000).cast("decimal(6,3)").alias("risk_multiplier"),
        (F.col("s_acctbal") < 0).alias("manual_review_required"),
    )


def contract_texts() -> dict[int, str]:
    """Version → published text of a contract of transactions: an early one with fewer fields, a whole amount and
    another name for the user, the one in use, and a later one without channel and with a terminal."""
    own = list(TRANSACTION.fields)
    defaults = DEFAULTS["transactions.raw-value"]
    early = [f for f in own if f.name not in ("currency", "ipRisk", "mlFraudScore")]
    early = [T.StructField("user", f.dataType, f.nullable) if f.name == "userId" else f for f in early]
    early = [T.StructField(f.name, T.LongType(), f.nullable) if f.name == "amount" else f for f in early]
    version = T.StructField("schemaVersion", T.IntegerType(), False)
    later = [*[f for f in own if f.name != "channel"], T.StructField("terminal", T.StringType(), True), version]
    return {
        1: published("Payment", T.StructType(early)),
        2: published("Payment", T.StructType([*own, version]), defaults, {"userId": ("user",)}),
        3: published("Payment", T.StructType(later), defaults),
    }


def versioned_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, version, value: every event as a record of one of three versions of its contract. One in 50 names a
    version that is not there, one in 47 lacks its id, one in 43 has an amount that is no number."""
    rows = transactions_from_events(events(spark, sf_dir))
    n = F.col("event_id")
    number = (n % 3 + 1).cast("int")
    amount = F.when(n % 43 == 0, F.lit('"much"')).when(number == 1, F.floor("amount").cast("string"))
    amount = F.coalesce(amount, F.to_json(F.struct("amount"), JSON_WRITE).substr(F.lit(11), F.length(F.to_json(F.struct("amount"))) - 11))
    ident = F.when(n % 47 != 0, F.col("eventId")).alias("eventId")
    plain = ["merchantId", "category", "eventTime", "country", "deviceId", "paymentStatus"]
    whole = ["userId", *plain, "currency", "mlFraudScore", "ipRisk"]
    members = (
        F.when(number == 1, F.to_json(F.struct(ident, F.col("userId").alias("user"), *plain, "channel"), JSON_WRITE))
        .when(number == 2, F.to_json(F.struct(ident, *whole, "channel", F.lit(2).alias("schemaVersion")), JSON_WRITE))
        .otherwise(F.to_json(F.struct(ident, *whole, F.concat(F.lit("t-"), "deviceId").alias("terminal"), F.lit(3).alias("schemaVersion")), JSON_WRITE))
    )
    value = F.concat(F.lit('{"amount":'), amount, F.lit(","), F.substring(members, 2, 1 << 30))
    return rows.select("event_id", F.when(n % 50 == 0, 9).otherwise(number).alias("version"), value.alias("value"))

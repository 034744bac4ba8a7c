"""Payment transactions derived from a table of generic events.

The `events` table has event_id, ts, user_id, event_type, value and props (JSON
with a number k). The mapping is deterministic, so that results can be checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.functions.expressions import JSON_WRITE, event_timestamp
from riskstream.schemas import TRANSACTION_FIELDS

EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
LOG_PARTITIONS = 3

_FIELDS = {
    "eventId": "concat('evt-', event_id)",
    "userId": "concat('user-', user_id)",
    "merchantId": """CASE WHEN event_id % 19 = 0 THEN NULL
        WHEN event_id % 29 = 0 THEN '  '
        WHEN event_id % 23 < 3 THEN 'shop-busy'
        ELSE concat('shop-', CAST(get_json_object(props, '$.k') AS INT) % 30) END""",
    "category": "CASE WHEN event_id % 31 <> 0 THEN event_type END",
    "eventTime": "unix_millis(CAST(ts AS TIMESTAMP))",
    "amount": "round(value * 20, 2)",
    "currency": "'USD'",
    "country": """CASE WHEN event_id % 37 = 0 THEN NULL
        WHEN event_id % 41 = 0 THEN 'UNKNOWN'
        ELSE concat('C', user_id % 6) END""",
    "channel": "concat('channel-', event_id % 4)",
    "deviceId": "concat('unit-', event_id % 300)",
    "mlFraudScore": "(event_id * 37) % 100 / 100D",
    "paymentStatus": "CASE event_id % 8 WHEN 3 THEN 'FAILED' WHEN 7 THEN 'failed' ELSE 'APPROVED' END",
    "ipRisk": "CAST((event_id * 53) % 101 AS INT)",
    "partition": f"CAST(event_id % {LOG_PARTITIONS} AS INT)",
    "offset": f"event_id div {LOG_PARTITIONS}",
}

# how some fields are damaged in the raw log
_DAMAGED = {
    "eventId": "CASE WHEN event_id % 139 = 0 THEN '' ELSE eventId END",
    "userId": "CASE WHEN event_id % 163 = 0 THEN ' ' ELSE userId END",
    "eventTime": "CASE WHEN event_id % 157 = 0 THEN 0L ELSE eventTime END",
    "amount": "CASE WHEN event_id % 151 = 0 THEN -amount ELSE amount END",
}


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def transactions_from_events(events: DataFrame) -> DataFrame:
    """One transaction per event, with log lineage (partition, offset)."""
    fields = events.selectExpr(*[f"{sql} AS {name}" for name, sql in _FIELDS.items()], "event_id")
    return fields.withColumn("event_ts", event_timestamp(F.col("eventTime")))


def raw_log_from_events(events: DataFrame, topic: str) -> DataFrame:
    """The same transactions as a log of JSON texts, with some bad records."""
    members = ", ".join(f"{_DAMAGED.get(name, name)} AS {name}" for name in TRANSACTION_FIELDS)
    texts = transactions_from_events(events).select(
        "event_id", "partition", "offset", "userId", F.to_json(F.expr(f"struct({members})"), JSON_WRITE).alias("text")
    )
    return texts.selectExpr(
        f"'{topic}' AS topic",
        "partition",
        "offset",
        "CAST(NULL AS TIMESTAMP) AS timestamp",
        f"encode({_DAMAGED['userId']}, 'UTF-8') AS key",
        "encode(CASE WHEN event_id % 137 = 0 THEN substring(text, 1, 30) ELSE text END, 'UTF-8') AS value",
        "event_id",
    )

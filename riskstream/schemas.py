"""Record schemas of the engine, as Spark struct types."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_STRING, _LONG, _INT, _DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_TIMESTAMP = T.TimestampType()

TRANSACTION = _struct(
    ("eventId", _STRING, False),
    ("userId", _STRING, False),
    ("merchantId", _STRING, True),
    ("category", _STRING, True),
    ("eventTime", _LONG, False),
    ("amount", _DOUBLE, False),
    ("currency", _STRING, True),
    ("country", _STRING, True),
    ("channel", _STRING, True),
    ("deviceId", _STRING, True),
    ("mlFraudScore", _DOUBLE, False),
    ("paymentStatus", _STRING, True),
    ("ipRisk", _INT, False),
)

ALERT = _struct(
    ("alertId", _STRING, False),
    ("alertType", _STRING, False),
    ("severity", _STRING, False),
    ("key", _STRING, False),
    ("reason", _STRING, False),
    ("windowStart", _LONG, False),
    ("windowEnd", _LONG, False),
    ("eventTime", _LONG, False),
    ("metricValue", _DOUBLE, False),
    ("sampleEventId", _STRING, True),
)

AGGREGATE = _struct(
    ("aggregateType", _STRING, False),
    ("key", _STRING, False),
    ("windowStart", _LONG, False),
    ("windowEnd", _LONG, False),
    ("eventCount", _LONG, False),
    ("totalAmount", _DOUBLE, False),
    ("avgAmount", _DOUBLE, False),
    ("avgFraudScore", _DOUBLE, False),
)

SQL_AGGREGATE = _struct(
    ("aggregateType", _STRING, True),
    ("key", _STRING, True),
    ("windowStart", _TIMESTAMP, True),
    ("windowEnd", _TIMESTAMP, True),
    ("eventCount", _LONG, True),
    ("totalAmount", _DOUBLE, True),
    ("avgAmount", _DOUBLE, True),
    ("avgFraudScore", _DOUBLE, True),
)

DLQ = _struct(
    ("errorType", _STRING, False),
    ("reason", _STRING, False),
    ("sourceTopic", _STRING, True),
    ("replayTopic", _STRING, True),
    ("rawValue", _STRING, False),
    ("observedAt", _LONG, False),
)

PROFILE = _struct(
    ("merchant_id", _STRING, False),
    ("risk_tier", _STRING, False),
    ("risk_multiplier", T.DecimalType(6, 3), False),
    ("manual_review_required", T.BooleanType(), False),
    ("updated_at", _TIMESTAMP, False),
)

# one change of a profile row: the image after the change, its kind and source time
PROFILE_CHANGE = T.StructType(
    [T.StructField(f.name, f.dataType, True) for f in PROFILE.fields]
    + [T.StructField("op", _STRING, True), T.StructField("source_ts_ms", _LONG, True)]
)

# one record of a partitioned log, in the layout of Spark's Kafka source
LOG = _struct(
    ("topic", _STRING, False),
    ("partition", _INT, False),
    ("offset", _LONG, False),
    ("timestamp", _TIMESTAMP, True),
    ("key", T.BinaryType(), True),
    ("value", T.BinaryType(), True),
)

TRANSACTION_FIELDS = TRANSACTION.fieldNames()
TEXT_FIELDS = [f.name for f in TRANSACTION.fields if isinstance(f.dataType, T.StringType)]
LINEAGE_FIELDS = ["topic", "partition", "offset"]

"""The registered queries as SQL text for another engine (DuckDB dialect)."""

from __future__ import annotations

from riskstream.catalog import inputs as I
from riskstream.config import RiskThresholds, WindowSpec

_SIZES = {"minute": 60_000, "day": I.DAY_MS}

# the transactions of riskstream.sources.events
_TX = """
tx AS (
  SELECT event_id, user_id,
    'evt-' || event_id AS "eventId",
    'user-' || user_id AS "userId",
    CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 29 = 0 THEN '  '
         WHEN event_id % 23 < 3 THEN 'shop-busy'
         ELSE 'shop-' || (CAST(json_extract(props, '$.k') AS INT) % 30) END AS "merchantId",
    CASE WHEN event_id % 31 <> 0 THEN event_type END AS category,
    epoch_us(ts) // 1000 AS "eventTime",
    round(value * 20, 2) AS amount,
    'USD' AS currency,
    CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 41 = 0 THEN 'UNKNOWN'
         ELSE 'C' || (user_id % 6) END AS country,
    'channel-' || (event_id % 4) AS channel,
    'unit-' || (event_id % 300) AS "deviceId",
    ((event_id * 37) % 100) / 100.0::DOUBLE AS "mlFraudScore",
    CASE event_id % 8 WHEN 3 THEN 'FAILED' WHEN 7 THEN 'failed' ELSE 'APPROVED' END AS "paymentStatus",
    CAST((event_id * 53) % 101 AS INT) AS "ipRisk",
    CAST(event_id % 3 AS INT) AS "partition",
    event_id // 3 AS "offset"
  FROM events
)"""

_FIELDS = [
    "eventId", "userId", "merchantId", "category", "eventTime", "amount", "currency", "country",
    "channel", "deviceId", "mlFraudScore", "paymentStatus", "ipRisk",
]
_COLS = ", ".join(f'"{f}"' for f in _FIELDS)


def _json(fields: list[str], prefix: str = "") -> str:
    return "CAST(to_json({" + ", ".join(f"'{f}': {prefix}\"{f}\"" for f in fields) + "}) AS VARCHAR)"


# the raw log: overridden fields, then its JSON text
def _raw_log(source: str) -> str:
    return f"""
raw AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 139 = 0 THEN '' ELSE "eventId" END AS "eventId",
    CASE WHEN event_id % 163 = 0 THEN ' ' ELSE "userId" END AS "userId",
    CASE WHEN event_id % 157 = 0 THEN 0 ELSE "eventTime" END AS "eventTime",
    CASE WHEN event_id % 151 = 0 THEN -amount ELSE amount END AS amount)
  FROM {source}
),
log AS (
  SELECT *, CASE WHEN event_id % 137 = 0 THEN substr(json_text, 1, 30) ELSE json_text END AS raw_value,
    CASE WHEN event_id % 137 = 0 THEN 'malformed JSON'
         WHEN trim("eventId") = '' THEN 'eventId is required'
         WHEN trim("userId") = '' THEN 'userId is required'
         WHEN "eventTime" <= 0 THEN 'eventTime must be epoch millis'
         WHEN amount < 0 THEN 'amount must be non-negative' END AS reason
  FROM (SELECT *, {_json(_FIELDS)} AS json_text FROM raw)
)"""


_RAW = _raw_log("tx")

_REJECTED = f"""
rejected AS (
  SELECT 'PARSE_OR_VALIDATION_ERROR' AS "errorType", reason,
    'transactions.raw,transactions.replay' AS "sourceTopic", 'transactions.replay' AS "replayTopic",
    raw_value AS "rawValue", {I.OBSERVED_AT}::BIGINT AS "observedAt"
  FROM log WHERE reason IS NOT NULL
)"""


def _blank(column: str, fallback: str) -> str:
    return f"CASE WHEN {column} IS NULL OR trim({column}) = '' THEN '{fallback}' ELSE {column} END"


_MERCHANT = _blank('"merchantId"', "merchant-unknown")
_KEY = (
    f"{_blank('country', 'UNKNOWN')} || '|' || {_blank('category', 'uncategorized')} || '|' || {_MERCHANT}"
)
_SQL_KEY = (
    "coalesce(country, 'UNKNOWN') || '|' || coalesce(category, 'uncategorized') || '|' || "
    "coalesce(\"merchantId\", 'merchant-unknown')"
)


def _sum(column: str, window: str = "") -> str:
    """The plain sum of the decimal values; the tables have at most two places."""
    return f"CAST(sum(CAST({column} AS DECIMAL(28, 4))){window} AS DOUBLE)"


def _half_up(expr: str) -> str:
    return f"floor(({expr}) * 100.0 + 0.5) / 100.0"


def _decimal_round(expr: str, digits: int) -> str:
    return f"ROUND(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,17)), {digits})"


def _fixed(expr: str, digits: int) -> str:
    return f"CAST(CAST({_decimal_round(expr, digits)} AS DECIMAL(38,{digits})) AS VARCHAR)"


def _stats(source: str, key: str, size: int) -> str:
    return f"""
  SELECT {key} AS "key", "eventTime" - "eventTime" % {size} AS "windowStart",
    "eventTime" - "eventTime" % {size} + {size} AS "windowEnd",
    count(*) AS "eventCount",
    {_sum('amount')} AS "totalAmount",
    {_sum('"mlFraudScore"')} AS "totalFraudScore",
    greatest(0.0::DOUBLE, max("mlFraudScore")) AS "maxFraudScore",
    arg_min("eventId", "partition" * (1::HUGEINT << 44) + "offset") AS "sampleEventId"
  FROM {source} GROUP BY ALL"""


def _aggregate(stats: str, extra: str = "") -> str:
    return f"""
  SELECT 'COUNTRY_CATEGORY_1M' AS "aggregateType", "key", "windowStart", "windowEnd", "eventCount",
    {_half_up('"totalAmount"')} AS "totalAmount",
    {_half_up('"totalAmount" / "eventCount"')} AS "avgAmount",
    {_half_up('"totalFraudScore" / "eventCount"')} AS "avgFraudScore"{extra}
  FROM {stats}"""


def _alert_id(kind: str, key: str, start: str, sample: str) -> str:
    return f"sha256('{kind}|' || {key} || '|' || {start} || '|' || {sample})"


def _high_risk(source: str, multiplier: str = "1.0") -> str:
    return f"""
  SELECT {_alert_id('HIGH_RISK_TRANSACTION', '"userId"', '"eventTime"', '"eventId"')} AS "alertId",
    'HIGH_RISK_TRANSACTION' AS "alertType", 'CRITICAL' AS severity, "userId" AS "key",
    'single event exceeded fraud rule threshold' AS reason,
    "eventTime" AS "windowStart", "eventTime" AS "windowEnd", "eventTime" AS "eventTime",
    "mlFraudScore" AS "metricValue", "eventId" AS "sampleEventId"
  FROM {source}
  WHERE "mlFraudScore" * {multiplier} >= 0.92
     OR (amount * {multiplier} >= 1000 AND "ipRisk" >= 80)
     OR (upper("paymentStatus") = 'FAILED' AND "mlFraudScore" * {multiplier} >= 0.85 AND "ipRisk" >= 70)"""


def _bursts(stats: str, extra: str = "") -> str:
    return f"""
  SELECT {_alert_id('USER_PAYMENT_BURST', '"key"', '"windowStart"', '"sampleEventId"')} AS "alertId",
    'USER_PAYMENT_BURST' AS "alertType",
    CASE WHEN "totalAmount" >= 3000 THEN 'CRITICAL' ELSE 'WARN' END AS severity, "key",
    'user window exceeded count or amount threshold; count=' || "eventCount" || ', totalAmount='
      || {_fixed('"totalAmount"', 2)} AS reason,
    "windowStart", "windowEnd", "windowEnd" AS "eventTime",
    greatest("totalAmount", "maxFraudScore") AS "metricValue", "sampleEventId"{extra}
  FROM {stats} WHERE "eventCount" >= 5 OR "totalAmount" >= 3000"""


def _anomalies(stats: str, extra: str = "", limits: RiskThresholds = RiskThresholds()) -> str:
    return f"""
  SELECT {_alert_id('MERCHANT_ANOMALY', '"key"', '"windowStart"', '"sampleEventId"')} AS "alertId",
    'MERCHANT_ANOMALY' AS "alertType",
    CASE WHEN avg_score >= {limits.merchant_score} THEN 'CRITICAL' ELSE 'WARN' END AS severity, "key",
    'merchant window anomaly; count=' || "eventCount" || ', totalAmount=' || {_fixed('"totalAmount"', 2)}
      || ', avgFraudScore=' || {_fixed('avg_score', 4)} AS reason,
    "windowStart", "windowEnd", "windowEnd" AS "eventTime",
    greatest("totalAmount", avg_score) AS "metricValue", "sampleEventId"{extra}
  FROM (SELECT *, "totalFraudScore" / "eventCount" AS avg_score FROM {stats})
  WHERE "eventCount" >= {limits.merchant_count} OR "totalAmount" >= {limits.merchant_amount}
    OR ("eventCount" >= {limits.merchant_score_count} AND avg_score >= {limits.merchant_score})"""


def _sql_aggregate(source: str, size: int) -> str:
    return f"""
  SELECT 'COUNTRY_CATEGORY_MERCHANT_1M_SQL' AS "aggregateType", {_SQL_KEY} AS "key",
    "windowStart", "windowStart" + {size} AS "windowEnd", "eventCount",
    CAST({_decimal_round('total', 2)} AS DOUBLE) AS "totalAmount",
    CAST({_decimal_round('total / "eventCount"', 2)} AS DOUBLE) AS "avgAmount",
    CAST({_decimal_round('score / "eventCount"', 4)} AS DOUBLE) AS "avgFraudScore"
  FROM (
    SELECT "eventTime" - "eventTime" % {size} AS "windowStart", country, category, "merchantId",
      count(*) AS "eventCount", {_sum('amount')} AS total, {_sum('"mlFraudScore"')} AS score
    FROM {source} GROUP BY ALL)"""


# batches with their watermark, and the place of each row relative to its window
_BATCHED = f"""
batched AS (
  SELECT * REPLACE ("eventTime" - CASE WHEN event_id % 149 = 0 THEN {10 * I.DAY_MS}
      WHEN event_id % 11 = 0 THEN {8 * I.HOUR_MS} ELSE 0 END AS "eventTime"),
    event_id // {I.BATCH_EVENTS} AS batch_id
  FROM tx
)"""


def _stamped(size: int, delay: int, lateness: int, batched: str = _BATCHED) -> str:
    return f"""{batched},
marks AS (
  SELECT batch_id, max(max("eventTime")) OVER (ORDER BY batch_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {delay + 1} AS watermark
  FROM batched GROUP BY batch_id
),
stamped AS (
  SELECT *, "eventTime" - "eventTime" % {size} AS "windowStart",
    coalesce(watermark >= "eventTime" - "eventTime" % {size} + {size - 1}, false) AS closed,
    coalesce(watermark - {lateness} >= "eventTime" - "eventTime" % {size} + {size - 1}, false) AS late
  FROM batched JOIN marks USING (batch_id)
)"""


_LATE_MINUTE = _stamped(60_000, 10_000, 30_000)
_LATE_DAY = _stamped(I.LATE_SPEC.size_ms, I.LATE_SPEC.out_of_orderness_ms, I.LATE_SPEC.allowed_lateness_ms)


def _emissions(key: str, spec: WindowSpec = I.LATE_SPEC) -> str:
    size, delay = spec.size_ms, spec.out_of_orderness_ms
    return f"""
in_time AS (SELECT *, {key} AS "key" FROM stamped WHERE NOT late),
on_time AS (
  SELECT "key", "windowStart", count(*) AS n, sum(CAST(amount AS DECIMAL(28, 4))) AS total,
    sum(CAST("mlFraudScore" AS DECIMAL(28, 4))) AS score,
    greatest(0.0::DOUBLE, max("mlFraudScore")) AS top,
    arg_min("eventId", (batch_id * 1024 + "partition") * (1::HUGEINT << 44) + "offset") AS first_id
  FROM in_time WHERE NOT closed GROUP BY ALL
),
after AS (
  SELECT a.*, row_number() OVER w AS n, sum(CAST(a.amount AS DECIMAL(28, 4))) OVER w AS total,
    sum(CAST(a."mlFraudScore" AS DECIMAL(28, 4))) OVER w AS score,
    max(a."mlFraudScore") OVER w AS top, first_value(a."eventId") OVER w AS first_id
  FROM in_time a WHERE closed
  WINDOW w AS (PARTITION BY "key", "windowStart" ORDER BY batch_id, "partition", "offset" ROWS UNBOUNDED PRECEDING)
),
emitted AS (
  SELECT "key", "windowStart", n, total, score, top, first_id, 'FIRE' AS kind,
    -1::BIGINT AS batch_id, -1::INT AS "partition", -1::BIGINT AS "offset"
  FROM on_time WHERE "windowStart" + {size - 1} <= (SELECT max("eventTime") - {delay + 1} FROM batched)
  UNION ALL
  SELECT a."key", a."windowStart", a.n + coalesce(o.n, 0), a.total + coalesce(o.total, 0),
    a.score + coalesce(o.score, 0), greatest(a.top, coalesce(o.top, 0.0::DOUBLE)), coalesce(o.first_id, a.first_id),
    'REFIRE', a.batch_id, a."partition", a."offset"
  FROM after a LEFT JOIN on_time o ON a."key" = o."key" AND a."windowStart" = o."windowStart"
),
emission_stats AS (
  SELECT "key", "windowStart", "windowStart" + {size} AS "windowEnd", n AS "eventCount",
    CAST(total AS DOUBLE) AS "totalAmount", CAST(score AS DOUBLE) AS "totalFraudScore", top AS "maxFraudScore",
    first_id AS "sampleEventId", kind, batch_id, "partition", "offset"
  FROM emitted
)"""


_CAUSE = ', kind, batch_id, "partition", "offset"'

# the quarantine log of riskstream.catalog.inputs and what becomes of its records
_QUARANTINE = f"""
damaged AS (
  SELECT *, event_id % 16 AS c,
    '{{"eventId":"evt-' || event_id || '","userId":"' || "userId" || '"' AS head
  FROM tx
),
texts AS (
  SELECT *, {_json(_FIELDS)} AS json_text FROM (SELECT * REPLACE (
    CASE WHEN c = 0 THEN -amount ELSE amount END AS amount,
    CASE WHEN c = 2 THEN '' ELSE "eventId" END AS "eventId",
    CASE WHEN c = 15 THEN '  ' ELSE "userId" END AS "userId") FROM damaged)
),
quarantine AS (
  SELECT event_id, c, CASE c
      WHEN 1 THEN substr(json_text, 1, 30)
      WHEN 3 THEN head || ',"amount":null}}'
      WHEN 4 THEN head || ',"amount":"abc"}}'
      WHEN 5 THEN '[' || event_id || ']'
      WHEN 6 THEN CAST(event_id AS VARCHAR)
      WHEN 7 THEN ''
      WHEN 9 THEN head || ',"amount":' || amount || ',"traceId":"t-' || event_id || '","attempt":' || event_id % 5 || '}}'
      WHEN 10 THEN head || ',"amount":"' || amount || '","ipRisk":"' || "ipRisk" || '"}}'
      WHEN 12 THEN '{{"mlFraudScore":' || "mlFraudScore" || '}}'
      WHEN 13 THEN head || ',"ipRisk":null}}'
      WHEN 14 THEN head || ',"country":{{"code":"C1"}}}}'
      ELSE json_text END AS raw_value
  FROM texts
),
docs AS (
  SELECT *, CASE WHEN c <> 8 AND json_valid(raw_value) THEN CAST(raw_value AS JSON) END AS doc FROM quarantine
),
checked AS (
  SELECT *,
    json_type(doc) = 'OBJECT' AS is_object,
    json_type(doc, '$.amount') AS amount_type, json_type(doc, '$.ipRisk') AS ip_type,
    TRY_CAST(json_extract_string(doc, '$.amount') AS DOUBLE) AS amount_value,
    TRY_CAST(json_extract_string(doc, '$.mlFraudScore') AS DOUBLE) AS score_value,
    TRY_CAST(json_extract_string(doc, '$.ipRisk') AS INT) AS ip_value,
    json_type(doc, '$.country') = 'OBJECT' AS nested
  FROM docs
),
problems AS (
  SELECT *, CASE WHEN doc IS NULL THEN NULL
      WHEN NOT is_object THEN 'not a JSON object'
      WHEN nested THEN 'a text field holds an object or a list'
      WHEN amount_type IS NOT NULL AND amount_value IS NULL THEN 'amount is no number'
      WHEN ip_type IS NOT NULL AND ip_value IS NULL THEN 'ipRisk is no integer' END AS problem
  FROM checked
),
tagged AS (
  SELECT *, CASE WHEN problem IS NOT NULL THEN 'unrecoverable' WHEN doc IS NULL THEN 'dropped'
      ELSE 'repaired' END AS status
  FROM problems
)"""


def _text_or(field: str, default: str) -> str:
    value = f"json_extract_string(doc, '$.{field}')"
    return f"CASE WHEN coalesce({value}, '') = '' THEN {default} ELSE {value} END AS \"{field}\""


_REPAIRED = f"""
repaired AS (
  SELECT 0 AS "partition", event_id AS "offset",
    {_text_or('eventId', "'replay-0-' || event_id")},
    {_text_or('userId', "'user-replayed'")},
    {_text_or('merchantId', "'merchant-replayed'")},
    {_text_or('category', "'replay'")},
    {I.OBSERVED_AT}::BIGINT AS "eventTime",
    greatest(coalesce(amount_value, 0.0::DOUBLE), 0.0::DOUBLE) AS amount,
    {_text_or('currency', "'USD'")},
    {_text_or('country', "'UNKNOWN'")},
    {_text_or('channel', "'replay'")},
    {_text_or('deviceId', "'device-replayed'")},
    coalesce(score_value, 0.0::DOUBLE) AS "mlFraudScore",
    {_text_or('paymentStatus', "'REPLAYED'")},
    coalesce(ip_value, 0) AS "ipRisk",
    {I.OBSERVED_AT}::BIGINT AS "replayedFromDlqAt",
    CASE WHEN json_exists(doc, '$.traceId') THEN '{{"traceId":"' || json_extract_string(doc, '$.traceId')
      || '","attempt":' || json_extract_string(doc, '$.attempt') || '}}' ELSE '{{}}' END AS extra,
    event_id, c
  FROM tagged WHERE status = 'repaired'
),
replayed AS (
  SELECT "offset", "userId" AS "key",
    CASE WHEN extra = '{{}}' THEN json_text
         ELSE substr(json_text, 1, length(json_text) - 1) || ',' || substr(extra, 2) END AS "value"
  FROM (SELECT *, {_json([*_FIELDS, "replayedFromDlqAt"])} AS json_text FROM repaired)
)"""

_MERCHANT_OF_CHANGE = "CASE WHEN event_id % 3 = 0 THEN 'shop-busy' ELSE 'shop-' || event_id % 40 END"
_PROFILES = f"""
changes AS (
  SELECT {_MERCHANT_OF_CHANGE} AS merchant_id,
    ['LOW', 'MEDIUM', 'HIGH'][event_id % 7 % 3 + 1] AS risk_tier,
    CAST((event_id % 1500 + 500) / 1000.0 AS DOUBLE) AS risk_multiplier,
    event_id % 5 = 0 AS manual_review_required, "eventTime" AS updated_at,
    CASE WHEN event_id % 97 = 0 THEN 'd' ELSE 'u' END AS op,
    "eventTime" - "eventTime" % {I.HOUR_MS} AS source_ts_ms, "partition", "offset"
  FROM tx
),
profiles AS (
  SELECT merchant_id, risk_tier, risk_multiplier, manual_review_required, updated_at FROM (
    SELECT *, row_number() OVER (PARTITION BY merchant_id
      ORDER BY source_ts_ms DESC, "partition" DESC, "offset" DESC) AS rn FROM changes)
  WHERE rn = 1 AND op <> 'd'
)"""

# what the rules of parsing say to each way in which a record is written
_DAMAGED = """
damaged AS (
  SELECT *,
    CASE WHEN c IN (3, 6, 7, 8, 13, 14, 16, 17, 20, 22) THEN 'malformed JSON'
         WHEN c = 12 THEN 'eventId is required' WHEN c = 21 THEN 'userId is required' END AS reason,
    c NOT IN (13, 14, 20) AS is_record,
    CASE c WHEN 7 THEN '{"x":1}' WHEN 9 THEN event_id::VARCHAR WHEN 11 THEN 'again-' || event_id
           WHEN 12 THEN NULL WHEN 23 THEN '{x' || event_id ELSE 'evt-' || event_id END AS id,
    CASE WHEN c = 21 THEN ' ' ELSE 'u' END AS who,
    CASE WHEN c <> 16 THEN "eventTime" END AS happened,
    CASE WHEN c = 21 THEN -1 ELSE 1 END * CASE WHEN c NOT IN (4, 5, 6, 12, 18, 22) THEN event_id % 1000 + 0.5::DOUBLE END AS paid,
    CASE WHEN c = 8 THEN '["KR"]' END AS land,
    CASE WHEN c NOT IN (3, 4, 8, 11, 12, 17, 19) THEN 35 END AS ip
  FROM (SELECT event_id, event_id % 24 AS c, "eventTime" FROM tx)
)"""

_ACTIVITY = """
activity AS (
  SELECT 'transactions.raw' AS topic, "partition", "offset" FROM tx
  UNION ALL SELECT 'transactions.dlq', 0, event_id FROM tx
  UNION ALL SELECT 'alerts.fraud', "partition", "offset" FROM tx
),
bounds AS (
  SELECT topic, "partition", min("offset") AS low, max("offset") + 1 AS high FROM activity GROUP BY ALL
),
commits AS (
  SELECT 'transactions.raw' AS topic, "partition", max("offset") // 2 AS committed
  FROM tx WHERE "partition" < 2 GROUP BY ALL
),
statistics AS (
  SELECT t.topic, b."partition", CASE WHEN b.high IS NULL THEN 0 ELSE 1 END AS available,
    CASE WHEN high IS NOT NULL THEN greatest(high - low, 0) END AS messages, high AS "logEndOffset",
    CASE WHEN committed IS NOT NULL THEN greatest(high - committed, 0) END AS lag
  FROM (VALUES ('transactions.raw'), ('transactions.replay'), ('transactions.aggregates'),
      ('transactions.aggregates.sql'), ('alerts.fraud'), ('transactions.dlq'), ('merchant_risk_profiles')) t(topic)
    LEFT JOIN bounds b ON b.topic = t.topic
    LEFT JOIN commits c ON c.topic = b.topic AND c."partition" = b."partition"
)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join([_TX, *parts]) + "\n" + select


def _stats_cte(size: int, key: str) -> str:
    return f"\nstats AS ({_stats('tx', key, size)}\n)"


_DAY, _MINUTE = _SIZES["day"], _SIZES["minute"]
_STAT_COLS = '"key", "windowStart", "windowEnd", "eventCount", "totalAmount", "totalFraudScore", "maxFraudScore"'
_ALERT_COLS = (
    '"alertId", "alertType", severity, "key", reason, "windowStart", "windowEnd", "eventTime", "metricValue", '
    '"sampleEventId"'
)
_ALERT_JSON = _json(
    ["alertId", "alertType", "severity", "key", "reason", "windowStart", "windowEnd", "eventTime", "metricValue",
     "sampleEventId"]
)
_AGGREGATE_JSON = _json(
    ["aggregateType", "key", "windowStart", "windowEnd", "eventCount", "totalAmount", "avgAmount", "avgFraudScore"]
)
_USER = '"userId"'
_ENRICHED = """
enriched AS (
  SELECT t.*, p.risk_tier, coalesce(p.risk_multiplier, 1.0::DOUBLE) AS risk_multiplier, p.manual_review_required
  FROM tx t LEFT JOIN profiles p ON p.merchant_id = t."merchantId"
)"""



def _closed_stats(size: int, key: str, delay: int) -> str:
    """Windows that a stream has finished when its input ends."""
    return (
        _stats_cte(size, key)
        + f',\ndone AS (SELECT * FROM stats WHERE "windowEnd" <= (SELECT max("eventTime") - {delay} FROM tx))'
    )


# the log that arrives in batches, as its good rows are landed: partition p of the i-th of two topics becomes 2p + i
_ARRIVING = f"""
delayed AS (
  SELECT * REPLACE ("eventTime" - CASE WHEN event_id % 149 = 0 THEN {10 * I.DAY_MS}
      WHEN event_id % 13 = 0 THEN {30 * I.HOUR_MS} ELSE 0 END AS "eventTime"),
    least(event_id * {I.JOB_BATCHES} // (SELECT greatest(count(*), 1) FROM events), {I.JOB_BATCHES - 1}) AS batch_id
  FROM tx
),{_raw_log("delayed")},
batched AS (
  SELECT * REPLACE (CAST("partition" * 2 + CAST(event_id % 7 = 0 AS INT) AS INT) AS "partition") FROM log WHERE reason IS NULL
)"""
_ARRIVED = _stamped(I.JOB_SPEC.size_ms, I.JOB_SPEC.out_of_orderness_ms, I.JOB_SPEC.allowed_lateness_ms, _ARRIVING)
_RECEIVED = """
received AS (
  SELECT *, CASE WHEN event_id % 7 = 0 THEN 'transactions.replay' ELSE 'transactions.raw' END AS topic FROM log
)"""
_JOB_BATCHES = """
read_parts AS (
  SELECT batch_id, r.topic, r."partition", min(r."offset") AS low, max(r."offset") + 1 AS high, count(*) AS records,
    count(*) FILTER (r.reason IS NOT NULL) AS rejected, count(*) FILTER (s.late) AS late,
    max(r."eventTime") FILTER (r.reason IS NULL) AS highest, any_value(m.watermark) AS watermark
  FROM received r LEFT JOIN (SELECT event_id, late FROM stamped) s USING (event_id) LEFT JOIN marks m USING (batch_id) GROUP BY ALL
),
read_batches AS (
  SELECT batch_id, CAST(NULL AS VARCHAR) AS topic, CAST(NULL AS INTEGER) AS "partition", CAST(NULL AS BIGINT) AS low,
    CAST(NULL AS BIGINT) AS high, CAST(sum(records) AS BIGINT) AS records, CAST(sum(rejected) AS BIGINT) AS rejected,
    CAST(sum(late) AS BIGINT) AS late, max(max(highest)) OVER (ORDER BY batch_id) AS highest, any_value(watermark) AS watermark
  FROM read_parts GROUP BY batch_id
)"""
_ARRIVED_STATS = f"""
in_time AS (SELECT * EXCLUDE ("windowStart") FROM stamped WHERE NOT late),
stats AS ({_stats("in_time", _KEY, _DAY)}
),
given AS (
  SELECT {_KEY} AS "key", "eventTime" - "eventTime" % {_DAY} AS "windowStart", count(DISTINCT batch_id) AS given
  FROM in_time GROUP BY ALL
),
done AS (
  SELECT * FROM stats WHERE "windowEnd" <=
    (SELECT max("eventTime") - {I.JOB_SPEC.out_of_orderness_ms + I.JOB_SPEC.allowed_lateness_ms} FROM batched)
)"""
_LATE_RECORD = (
    "SELECT 'LATE_EVENT' AS \"errorType\", 'event arrived after watermark and allowed lateness' AS reason, "
    "'transactions.raw' AS \"sourceTopic\", 'transactions.replay' AS \"replayTopic\", "
    f'{_json(_FIELDS)} AS "rawValue", {I.OBSERVED_AT}::BIGINT AS "observedAt" FROM stamped WHERE late'
)
_SQL_TIME = "strftime(make_timestamp(\"{0}\" * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS \"{0}\""


_FAR_TX = """
far AS (
  SELECT *, CASE WHEN event_id % 50 = 0 THEN event_id % 7 + 1 ELSE 0 END AS huge,
    CASE WHEN event_id % 50 = 0 THEN 0::DECIMAL(38, 4)
         WHEN event_id % 50 = 1 THEN (event_id % 9)::DECIMAL(10, 0) * 18014398509481984::DECIMAL(20, 0)
         ELSE amount::DECIMAL(28, 4) END AS usual
  FROM tx
)"""
# whole multiples of 2**960 leave no room for the rest of a sum; without them it is exact as a decimal, which its digits hold
_FAR_TOTAL = "CASE WHEN sum(huge) > 0 THEN sum(huge)::DOUBLE * pow(2.0::DOUBLE, 960) ELSE CAST(CAST(sum(usual) AS VARCHAR) AS DOUBLE) END"


def _far_stats(key: str) -> str:
    return f"""
far_stats AS (
  SELECT {key} AS "key", "eventTime" - "eventTime" % {_DAY} AS "windowStart", count(*) AS "eventCount",
    {_FAR_TOTAL} AS "totalAmount", {_sum('"mlFraudScore"')} AS "totalFraudScore", greatest(0.0::DOUBLE, max("mlFraudScore")) AS "maxFraudScore",
    arg_min("eventId", "partition" * (1::HUGEINT << 44) + "offset") AS "sampleEventId"
  FROM far GROUP BY 1, 2
)"""


ORACLE: dict[str, str] = {
    "transactions": _with(select=f'SELECT {_COLS}, "partition", "offset" FROM tx'),
    "parsed_transactions": _with(
        _RAW,
        select=f"SELECT 'transactions.raw' AS topic, \"partition\", \"offset\", {_COLS} FROM log WHERE reason IS NULL",
    ),
    "rejected_records": _with(_RAW, _REJECTED, select="SELECT * FROM rejected"),
    "rejections_by_reason": _with(
        _RAW, _REJECTED, select='SELECT "errorType", reason, count(*) AS records FROM rejected GROUP BY ALL'
    ),
    "parse_matrix": _with(
        _DAMAGED,
        select="SELECT event_id AS \"offset\", reason, "
        + ", ".join(
            f"CASE WHEN reason IS DISTINCT FROM 'malformed JSON' THEN {value} END AS \"{name}\""
            for name, value in {
                "eventId": "id", "userId": "who", "eventTime": "happened", "amount": "coalesce(paid, 0)",
                "mlFraudScore": "0.0::DOUBLE", "ipRisk": "coalesce(ip, 0)::INTEGER",
            }.items()
        )
        + " FROM damaged",
    ),
    "lenient_matrix": _with(
        _DAMAGED,
        select='SELECT event_id AS "offset", id AS "eventId", who AS "userId", happened AS "eventTime", paid AS amount, '
        'NULL::DOUBLE AS "mlFraudScore", land AS country, ip::INTEGER AS "ipRisk" FROM damaged WHERE is_record',
    ),
    "lenient_transactions": _with(
        _RAW, select=f'SELECT "partition", "offset", {_COLS} FROM log WHERE event_id % 137 <> 0'
    ),
    "group_keys": _with(
        select=f'SELECT "eventId", {_KEY} AS "aggregateKey", {_MERCHANT} AS "merchantKey", {_SQL_KEY} AS "sqlKey" FROM tx'
    ),
    "high_risk_alerts": _with(select=_high_risk("tx")),
    "high_risk_alerts_from_raw": _with(
        _RAW, "\nvalid AS (SELECT * FROM log WHERE reason IS NULL)", select=_high_risk("valid")
    ),
    "user_window_stats": _with(_stats_cte(_DAY, _USER), select=f"SELECT {_STAT_COLS} FROM stats"),
    "user_bursts_minute": _with(_stats_cte(_MINUTE, _USER), select=_bursts("stats")),
    "user_bursts_daily": _with(_stats_cte(_DAY, _USER), select=_bursts("stats")),
    "merchant_anomalies_minute": _with(_stats_cte(_MINUTE, _MERCHANT), select=_anomalies("stats")),
    "merchant_anomalies_minute_low_limits": _with(
        _stats_cte(_MINUTE, _MERCHANT), select=_anomalies("stats", limits=I.LOW_LIMITS)
    ),
    "merchant_anomalies_daily": _with(_stats_cte(_DAY, _MERCHANT), select=_anomalies("stats")),
    "fraud_alerts_daily": _with(
        f"\nusers AS ({_stats('tx', _USER, _DAY)}\n)",
        f"\nmerchants AS ({_stats('tx', _MERCHANT, _DAY)}\n)",
        select=f"SELECT {_ALERT_COLS} FROM ({_high_risk('tx')})"
        f" UNION ALL SELECT {_ALERT_COLS} FROM ({_bursts('users')})"
        f" UNION ALL SELECT {_ALERT_COLS} FROM ({_anomalies('merchants')})",
    ),
    "fraud_alerts_of_landed_log": _with(
        _RAW,
        # two topics make one log: partition p of the first one becomes 2p
        """
valid AS (SELECT * REPLACE (CAST("partition" * 2 AS INT) AS "partition") FROM log WHERE reason IS NULL)""",
        f"\nusers AS ({_stats('valid', _USER, _DAY)}\n)",
        f"\nmerchants AS ({_stats('valid', _MERCHANT, _DAY)}\n)",
        select=f"SELECT {_ALERT_COLS} FROM ({_high_risk('valid')})"
        f" UNION ALL SELECT {_ALERT_COLS} FROM ({_bursts('users')})"
        f" UNION ALL SELECT {_ALERT_COLS} FROM ({_anomalies('merchants')})",
    ),
    "fraud_alerts_of_renamed_topics": _with(
        _RAW,
        """
valid AS (SELECT * REPLACE (CAST("partition" * 2 AS INT) AS "partition") FROM log WHERE reason IS NULL)""",
        f"\nusers AS ({_stats('valid', _USER, _DAY)}\n)",
        f"\nmerchants AS ({_stats('valid', _MERCHANT, _DAY)}\n)",
        select=f"SELECT {_ALERT_COLS} FROM ({_high_risk('valid')})"
        f" UNION ALL SELECT {_ALERT_COLS} FROM ({_bursts('users')})"
        f" UNION ALL SELECT {_ALERT_COLS} FROM ({_anomalies('merchants')})",
    ),
    "totals_of_far_amounts": _with(
        _FAR_TX, _far_stats(_USER), select='SELECT "key", "windowStart", "eventCount", "totalAmount", "totalFraudScore" FROM far_stats'
    ),
    "alerts_of_far_amounts": _with(
        _FAR_TX,
        _far_stats(_USER),
        select=f"""
  SELECT {_alert_id('USER_PAYMENT_BURST', '"key"', '"windowStart"', '"sampleEventId"')} AS "alertId",
    CASE WHEN "totalAmount" >= 3000 THEN 'CRITICAL' ELSE 'WARN' END AS severity, "key", "windowStart",
    greatest("totalAmount", "maxFraudScore") AS "metricValue", "sampleEventId"
  FROM far_stats WHERE "eventCount" >= 5 OR "totalAmount" >= 3000""",
    ),
    "sql_totals_of_far_amounts": _with(
        _FAR_TX,
        f"""
raw_stats AS (
  SELECT {_SQL_KEY} AS "key", "eventTime" - "eventTime" % {_DAY} AS "windowStart", count(*) AS "eventCount", {_FAR_TOTAL} AS total
  FROM far GROUP BY country, category, "merchantId", "eventTime" - "eventTime" % {_DAY}
)""",
        select='SELECT "key", "windowStart", "eventCount", CASE WHEN total < 1e15 THEN round(total, 2) ELSE total END AS "totalAmount" FROM raw_stats',
    ),
    "transactions_with_profiles_as_of": _with(
        _PROFILES,
        """
versions AS (
  SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY merchant_id, source_ts_ms ORDER BY "partition" DESC, "offset" DESC) = 1)""",
        select="""
  SELECT "eventId", CASE WHEN op <> 'd' THEN risk_tier END AS risk_tier,
    coalesce(CASE WHEN op <> 'd' THEN risk_multiplier END, 1.0::DOUBLE) AS risk_multiplier,
    CASE WHEN op <> 'd' THEN v.manual_review_required END AS manual_review_required
  FROM tx t ASOF LEFT JOIN versions v ON t."merchantId" = v.merchant_id AND t."eventTime" >= v.source_ts_ms""",
    ),
    "merchant_profiles_in_increments": _with(_PROFILES, select="SELECT * FROM profiles"),
    "alert_json": _with(select=f'SELECT {_ALERT_JSON} AS "value" FROM ({_high_risk("tx")})'),
    "aggregates_minute": _with(_stats_cte(_MINUTE, _KEY), select=_aggregate("stats")),
    "aggregates_daily": _with(_stats_cte(_DAY, _KEY), select=_aggregate("stats")),
    "aggregate_json": _with(
        _stats_cte(_DAY, _KEY), select=f'SELECT {_AGGREGATE_JSON} AS "value" FROM ({_aggregate("stats")})'
    ),
    "sql_aggregates_minute": _with(
        _RAW, "\nread AS (SELECT * FROM log WHERE event_id % 137 <> 0)", select=_sql_aggregate("read", _MINUTE)
    ),
    "sql_aggregates_daily": _with(select=_sql_aggregate("tx", _DAY)),
    "sql_aggregate_json": _with(
        select=f'SELECT {_AGGREGATE_JSON} AS "value" FROM (SELECT * REPLACE ('
        f'{_SQL_TIME.format("windowStart")}, {_SQL_TIME.format("windowEnd")}) FROM ({_sql_aggregate("tx", _DAY)}))'
    ),
    "late_events": _with(
        _LATE_MINUTE, select='SELECT batch_id, "eventId", "eventTime", watermark FROM stamped WHERE late'
    ),
    "late_records": _with(
        _LATE_DAY,
        select=_LATE_RECORD,
    ),
    "aggregates_in_time": _with(
        _LATE_DAY,
        f"\nin_time AS (SELECT * EXCLUDE (\"windowStart\") FROM stamped WHERE NOT late),\nstats AS ({_stats('in_time', _KEY, _DAY)}\n)",
        select=_aggregate("stats"),
    ),
    "window_emissions": _with(_LATE_DAY, _emissions(_MERCHANT), select="SELECT * FROM emission_stats"),
    "aggregate_emissions": _with(_LATE_DAY, _emissions(_KEY), select=_aggregate("emission_stats", _CAUSE)),
    "burst_emissions": _with(_LATE_DAY, _emissions(_USER), select=_bursts("emission_stats", _CAUSE)),
    "anomaly_emissions": _with(_LATE_DAY, _emissions(_MERCHANT), select=_anomalies("emission_stats", _CAUSE)),
    "repair_status": _with(_QUARANTINE, select='SELECT event_id AS "offset", status, problem FROM tagged'),
    "repaired_transactions": _with(_QUARANTINE, _REPAIRED, select="SELECT * EXCLUDE (event_id, c) FROM repaired"),
    "repaired_transactions_of_known_errors": _with(
        _QUARANTINE, _REPAIRED, select='SELECT "offset", "eventId" FROM repaired WHERE c <> 11'
    ),
    "unrecoverable_records": _with(
        _QUARANTINE,
        select='SELECT 0 AS "partition", event_id AS "offset", problem, raw_value AS "rawValue" '
        "FROM tagged WHERE status = 'unrecoverable'",
    ),
    "replay_records": _with(_QUARANTINE, _REPAIRED, select="SELECT * FROM replayed"),
    "replay_first_records": _with(
        _QUARANTINE, _REPAIRED, select='SELECT * FROM replayed ORDER BY "offset" LIMIT 50'
    ),
    "replayed_again": _with(
        _QUARANTINE,
        _REPAIRED,
        select='SELECT "offset", CASE WHEN trim("userId") = \'\' THEN \'userId is required\' END AS reason, '
        '"eventId", "userId", amount, "eventTime", "ipRisk" FROM repaired',
    ),
    "merchant_profiles": _with(_PROFILES, select="SELECT * FROM profiles"),
    "merchant_profiles_after_upsert": _with(
        _PROFILES,
        f"""
incoming AS (
  SELECT 'shop-' || s_suppkey AS merchant_id, CASE WHEN s_acctbal < 0 THEN 'HIGH' ELSE 'LOW' END AS risk_tier,
    CAST((s_suppkey % 1000 + 700) / 1000.0 AS DOUBLE) AS risk_multiplier, s_acctbal < 0 AS manual_review_required,
    {I.OBSERVED_AT}::BIGINT AS updated_at
  FROM supplier
)""",
        select="SELECT * FROM incoming UNION ALL "
        "SELECT * FROM profiles WHERE merchant_id NOT IN (SELECT merchant_id FROM incoming)",
    ),
    "transactions_with_profiles": _with(
        _PROFILES,
        _ENRICHED,
        select='SELECT "eventId", "merchantId", risk_tier, risk_multiplier, manual_review_required FROM enriched',
    ),
    "profiled_high_risk_alerts": _with(_PROFILES, _ENRICHED, select=_high_risk("enriched", "risk_multiplier")),
    "topic_names": _with(_ACTIVITY, select="SELECT DISTINCT topic FROM activity"),
    "topic_statistics": _with(_ACTIVITY, select="SELECT * FROM statistics"),
    "topic_totals": _with(
        _ACTIVITY,
        select="SELECT topic, CAST(sum(messages) AS BIGINT) AS messages, CAST(sum(lag) AS BIGINT) AS lag "
        "FROM statistics WHERE available = 1 GROUP BY topic",
    ),
    "headline_counts": _with(
        _ACTIVITY,
        select="SELECT CAST(sum(messages) FILTER (topic = 'transactions.dlq') AS BIGINT) AS \"dlqMessages\", "
        "CAST(sum(messages) FILTER (topic = 'alerts.fraud') AS BIGINT) AS \"alertMessages\" FROM statistics",
    ),
    "topic_tail": _with(
        _RAW,
        _ACTIVITY,
        select="SELECT 'transactions.raw' AS topic, l.\"partition\", l.\"offset\", l.\"userId\" AS \"key\", "
        "raw_value AS \"value\", json_valid(raw_value) AS \"valueIsJson\" "
        "FROM log l JOIN bounds b ON b.topic = 'transactions.raw' AND b.\"partition\" = l.\"partition\" "
        "WHERE l.\"offset\" >= greatest(b.low, b.high - greatest(1, 20 // 3 + 1)) "
        'ORDER BY l."partition", l."offset" LIMIT 20',
    ),
    "topic_head": _with(
        _QUARANTINE,
        select="SELECT 'transactions.dlq' AS topic, 0 AS \"partition\", event_id AS \"offset\", "
        'CAST(NULL AS VARCHAR) AS "key", "value", json_valid("value") AS "valueIsJson" FROM ('
        "SELECT q.event_id, CASE WHEN q.c = 8 THEN 'broken ' || q.event_id ELSE CAST(to_json({"
        "'errorType': CASE WHEN q.c = 11 THEN 'POISON_PILL' ELSE 'PARSE_OR_VALIDATION_ERROR' END, "
        "'reason': 'malformed JSON', 'sourceTopic': 'transactions.raw', 'replayTopic': 'transactions.replay', "
        "'rawValue': raw_value, 'observedAt': t.\"eventTime\"}) AS VARCHAR) END AS \"value\" "
        'FROM quarantine q JOIN tx t USING (event_id)) ORDER BY "offset" LIMIT 200',
    ),
    "contract_nulls": _with(
        _RAW,
        select="SELECT count(*) AS records, f.field, CAST(0 AS BIGINT) AS nulls FROM log, "
        "(VALUES ('eventId'), ('userId'), ('eventTime'), ('amount')) f(field) WHERE reason IS NULL GROUP BY f.field",
    ),
    "contract_nulls_of_odd_records": _with(
        _DAMAGED,
        select="SELECT count(*) AS records, f.field, count(*) FILTER (CASE f.field WHEN 'eventId' THEN id IS NULL "
        "WHEN 'eventTime' THEN happened IS NULL WHEN 'amount' THEN paid IS NULL ELSE who IS NULL END) AS nulls FROM damaged, "
        "(VALUES ('eventId'), ('userId'), ('eventTime'), ('amount')) f(field) WHERE is_record GROUP BY f.field",
    ),
    "evolved_transactions": _with(
        select=f"SELECT * REPLACE ('USD' AS currency, 0 AS \"ipRisk\"), 't-' || \"deviceId\" AS terminal, "
        f'1 AS "schemaVersion" FROM (SELECT {_COLS} FROM tx)'
    ),
    "transactions_of_versions": _with(
        select="SELECT event_id, " + ", ".join(
            f"CASE WHEN event_id % 50 <> 0 THEN {sql} END AS \"{name}\"" for name, sql in {
                **{f: f'"{f}"' for f in _FIELDS},
                "eventId": 'CASE WHEN event_id % 47 <> 0 THEN "eventId" END',
                "amount": "CASE WHEN event_id % 43 <> 0 THEN CASE event_id % 3 WHEN 0 THEN floor(amount) ELSE amount END END",
                "channel": "CASE WHEN event_id % 3 <> 2 THEN channel END",
                "mlFraudScore": 'CASE event_id % 3 WHEN 0 THEN 0.0 ELSE "mlFraudScore" END',
                "ipRisk": 'CASE event_id % 3 WHEN 0 THEN 0 ELSE "ipRisk" END',
                "schemaVersion": "CAST(CASE event_id % 3 WHEN 0 THEN 1 ELSE event_id % 3 + 1 END AS INTEGER)",
            }.items()
        )
        + ", CASE WHEN event_id % 50 = 0 THEN 'no contract for version 9' "
        "WHEN event_id % 43 = 0 THEN 'malformed JSON, or a field that is not of its type' "
        "WHEN event_id % 47 = 0 THEN 'required field eventId is null' END AS \"contractProblem\" FROM tx"
    ),
    "stream_profiled_high_risk_alerts": _with(
        _PROFILES, _ENRICHED, select=_high_risk("enriched", "risk_multiplier")
    ),
    "stream_aggregates": _with(_closed_stats(_MINUTE, _KEY, 40_000), select=_aggregate("done")),
    "stream_user_bursts": _with(_closed_stats(_DAY, _USER, 40_000), select=_bursts("done")),
    "stream_merchant_anomalies": _with(_closed_stats(_DAY, _MERCHANT, 40_000), select=_anomalies("done")),
    "stream_sql_aggregates": _with(
        select=f'SELECT * FROM ({_sql_aggregate("tx", _MINUTE)}) '
        'WHERE "windowEnd" <= (SELECT max("eventTime") - 10000 FROM tx)'
    ),
    "stream_high_risk_alerts": _with(select=_high_risk("tx")),
    "stream_emissions": _with(_LATE_DAY, _emissions(_MERCHANT), select="SELECT * FROM emission_stats"),
    **{
        name: _with(_LATE_DAY, _emissions(_MERCHANT), select="SELECT * FROM emission_stats")
        for name in ("stream_emissions_in_steps", "stream_emissions_of_state_store")
    },
    **{
        name: _with(_ARRIVED, _emissions(_USER, I.JOB_SPEC), select=_bursts("emission_stats", _CAUSE))
        for name in ("stream_job_exact", "stream_job_carried")
    },
    "stream_job_final": _with(_ARRIVED, _ARRIVED_STATS, select=_aggregate("done")),
    "stream_job_corrections": _with(
        _ARRIVED, _ARRIVED_STATS, select=_aggregate('stats JOIN given USING ("key", "windowStart")', ", given")
    ),
    "stream_job_quarantine": _with(
        _ARRIVED, _REJECTED, select=f"SELECT * FROM rejected UNION ALL ({_LATE_RECORD})"
    ),
    "stream_job_progress": _with(
        _ARRIVED, _RECEIVED, _JOB_BATCHES, select="SELECT * FROM read_parts UNION ALL SELECT * FROM read_batches"
    ),
    "stream_job_lag": _with(
        _ARRIVED,
        _RECEIVED,
        f"""
ends AS (
  SELECT topic, "partition", min("offset") AS low, max("offset") + 1 AS high,
    max("offset") FILTER (batch_id < {I.JOB_BATCHES - 1}) + 1 AS committed FROM received GROUP BY ALL
)""",
        select='''SELECT t.topic, "partition", CASE WHEN high IS NULL THEN 0 ELSE 1 END AS available, high - low AS messages,
  high AS "logEndOffset", high - committed AS lag
FROM (VALUES ('transactions.raw'), ('transactions.replay'), ('transactions.aggregates'),
  ('transactions.aggregates.sql'), ('alerts.fraud'), ('transactions.dlq'), ('merchant_risk_profiles')) t(topic)
LEFT JOIN ends USING (topic)''',
    ),
}

"""Settings of the payment-risk engine: thresholds, windows, topics, fixed texts."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: they must equal what consumers of the topics expect -------

ERROR_PARSE = "PARSE_OR_VALIDATION_ERROR"
ERROR_LATE = "LATE_EVENT"
REPLAYABLE_ERRORS = (ERROR_PARSE, ERROR_LATE)

REASON_MALFORMED = "malformed JSON"
REASON_EVENT_ID = "eventId is required"
REASON_USER_ID = "userId is required"
REASON_EVENT_TIME = "eventTime must be epoch millis"
REASON_AMOUNT = "amount must be non-negative"
REASON_LATE = "event arrived after watermark and allowed lateness"
REASON_HIGH_RISK = "single event exceeded fraud rule threshold"

ALERT_HIGH_RISK = "HIGH_RISK_TRANSACTION"
ALERT_USER_BURST = "USER_PAYMENT_BURST"
ALERT_MERCHANT = "MERCHANT_ANOMALY"
SEVERITY_CRITICAL = "CRITICAL"
SEVERITY_WARN = "WARN"

AGGREGATE_TYPE = "COUNTRY_CATEGORY_1M"
SQL_AGGREGATE_TYPE = "COUNTRY_CATEGORY_MERCHANT_1M_SQL"

UNKNOWN_COUNTRY = "UNKNOWN"
UNKNOWN_CATEGORY = "uncategorized"
UNKNOWN_MERCHANT = "merchant-unknown"

# values that a repaired record gets where the quarantined one has none
REPLAY_DEFAULTS = {
    "userId": "user-replayed",
    "merchantId": "merchant-replayed",
    "category": "replay",
    "currency": "USD",
    "country": "UNKNOWN",
    "channel": "replay",
    "deviceId": "device-replayed",
    "paymentStatus": "REPLAYED",
}
REPLAY_ID_PREFIX = "replay-"
REPLAY_MAX_RECORDS = 50

TAIL_MIN_LIMIT, TAIL_MAX_LIMIT, TAIL_DEFAULT_LIMIT = 1, 200, 20

# largest epoch-millis value that a microsecond timestamp can hold
MAX_EPOCH_MILLIS = 9_223_372_036_854_775


@dataclass(frozen=True)
class RiskThresholds:
    """Limits of the fraud rules. The defaults are the documented ones."""

    high_score: float = 0.92
    high_amount: float = 1_000.0
    high_ip_risk: int = 80
    failed_score: float = 0.85
    failed_ip_risk: int = 70
    burst_count: int = 5
    burst_amount: float = 3_000.0
    merchant_count: int = 25
    merchant_amount: float = 15_000.0
    merchant_score_count: int = 5
    merchant_score: float = 0.72


@dataclass(frozen=True)
class WindowSpec:
    """Tumbling event-time window with its two delays, all in milliseconds."""

    size_ms: int = 60_000
    out_of_orderness_ms: int = 10_000
    allowed_lateness_ms: int = 30_000

    @property
    def size(self) -> str:
        return f"{self.size_ms} milliseconds"

    @property
    def on_time_delay(self) -> str:
        return f"{self.out_of_orderness_ms} milliseconds"

    @property
    def full_delay(self) -> str:
        """How far behind the newest event a window may still change."""
        return f"{self.out_of_orderness_ms + self.allowed_lateness_ms} milliseconds"


MINUTE = WindowSpec()
DAY = WindowSpec(size_ms=86_400_000)


@dataclass(frozen=True)
class Topics:
    raw: str = "transactions.raw"
    replay: str = "transactions.replay"
    aggregates: str = "transactions.aggregates"
    sql_aggregates: str = "transactions.aggregates.sql"
    alerts: str = "alerts.fraud"
    dlq: str = "transactions.dlq"
    profiles: str = "merchant_risk_profiles"

    @property
    def sources(self) -> tuple[str, str]:
        return (self.raw, self.replay)

    @property
    def all(self) -> tuple[str, ...]:
        return (
            self.raw,
            self.replay,
            self.aggregates,
            self.sql_aggregates,
            self.alerts,
            self.dlq,
            self.profiles,
        )


DEFAULT_THRESHOLDS = RiskThresholds()
DEFAULT_TOPICS = Topics()

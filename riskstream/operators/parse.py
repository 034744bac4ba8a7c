"""Raw JSON text to typed transactions, with a reason on every row that fails.

All functions take and return DataFrames, bounded or streaming. The parsed frame
holds good and bad rows alike, told apart by `reason`; the outputs of a source
are filters over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream import config as cfg
from riskstream.config import DEFAULT_TOPICS, Topics
from riskstream.functions import expressions as E
from riskstream.schemas import TEXT_FIELDS, TRANSACTION, TRANSACTION_FIELDS

_CORRUPT = "_corrupt"

# strict JSON: what the parser accepts does not depend on Spark's lenient defaults
JSON_READ = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
    "allowNonNumericNumbers": "false",
    "allowSingleQuotes": "false",
}

_AS_TEXT = T.StructType(
    [T.StructField(name, T.StringType()) for name in TRANSACTION_FIELDS] + [T.StructField(_CORRUPT, T.StringType())]
)
_AS_VARIANT = T.StructType([T.StructField(name, T.VariantType()) for name in TRANSACTION_FIELDS])

NUMBER_KIND = "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"
CONTAINER_KIND = "^(OBJECT|ARRAY)"

# fixed values: the texts for non-finite numbers that are read from JSON strings
_NON_FINITE = "('NaN', 'INF', 'Infinity', '-INF', '-Infinity')"

# The expressions below are SQL text: `_text.x` is the field as text, `_typed.x`
# the field as a variant, which exists for rows marked `_ambiguous` only.


def json_kind(field: str) -> str:
    return f"coalesce(schema_of_variant(_typed.{field}), '')"


def _is_empty(text: str) -> str:
    return f"{text} IS NULL OR trim({text}) = '' OR {text} = 'null'"


def _double(field: str) -> str:
    """0.0 for a missing value, null for one that is no number."""
    text = f"_text.{field}"
    return f"""CASE
        WHEN abs(try_cast({text} AS DOUBLE)) < double('Infinity') THEN try_cast({text} AS DOUBLE)
        WHEN {_is_empty(text)} THEN 0D
        WHEN trim({text}) IN {_NON_FINITE} THEN try_cast({text} AS DOUBLE)
        WHEN {text} IN ('"Infinity"', '"-Infinity"') THEN try_cast(trim(BOTH '"' FROM {text}) AS DOUBLE)
        END"""


def _integer(field: str, kind: str, missing: str = "0") -> str:
    """Null for a value that is no integer. JSON numbers with a fraction or
    exponent are cut off; JSON strings must hold an integer."""
    text = f"_text.{field}"
    return f"""CASE
        WHEN try_cast({text} AS {kind}) IS NOT NULL THEN try_cast({text} AS {kind})
        WHEN {_is_empty(text)} THEN CAST({missing} AS {kind})
        WHEN {json_kind(field)} RLIKE '{NUMBER_KIND}' THEN try_cast(try_cast({text} AS DOUBLE) AS {kind})
        END"""


def _any(*conditions: str) -> str:
    return "coalesce(" + " OR ".join(f"({c})" for c in conditions) + ", false)"


def starts_container(field: str) -> str:
    return f"coalesce(startswith(_text.{field}, '{{') OR startswith(_text.{field}, '['), false)"


def holds_container(*fields: str) -> str:
    """A field is an object or list, unlike a string that only begins like one."""
    return _any(*[f"{json_kind(f)} RLIKE '{CONTAINER_KIND}'" for f in fields])


# Text alone does not tell "35.7" from 35.7, nor "{x" from an object.
_AMBIGUOUS = _any(
    *[starts_container(f) for f in TEXT_FIELDS],
    *[
        f"coalesce(_text.{f.name} IS NOT NULL AND try_cast(_text.{f.name} AS {f.dataType.simpleString()}) IS NULL, false)"
        for f in TRANSACTION.fields
        if isinstance(f.dataType, (T.LongType, T.IntegerType))
    ],
)


def read_fields(rows: DataFrame, ambiguous: str = _AMBIGUOUS) -> DataFrame:
    """Rows with JSON text in `rawValue`, plus the field texts `_text` and a
    `_malformed` flag.

    Each record is read once, as text. A second, typed read (`_typed`) happens
    only for the few records whose texts are ambiguous. The one-element explode
    keeps filters on the fields above the read; pushed below it they would bring
    a second copy of it.
    """
    read = rows.withColumn("_text", F.explode(F.array(F.from_json("rawValue", _AS_TEXT, JSON_READ))))
    flagged = read.withColumn("_malformed", F.expr(f"_text IS NULL OR _text.{_CORRUPT} IS NOT NULL")).withColumn(
        "_ambiguous", F.expr(f"NOT _malformed AND ({ambiguous})")
    )
    return flagged.withColumn("_typed", F.when(F.col("_ambiguous"), F.from_json("rawValue", _AS_VARIANT, JSON_READ)))


def _raw_values(log: DataFrame) -> DataFrame:
    return log.withColumn("rawValue", F.expr("coalesce(CAST(value AS STRING), '')"))


def parse_transactions(log: DataFrame) -> DataFrame:
    """Parse and check a log of JSON texts.

    Result: the columns of the log without key and value, `rawValue`, the
    transaction fields, `event_ts`, and `reason`, which is null for a good row.
    """
    lineage = [c for c in log.columns if c not in ("key", "value")]
    kinds = {f.name: f.dataType.simpleString() for f in TRANSACTION.fields}
    values = {
        name: f"_text.{name}" if kind == "string" else _double(name) if kind == "double" else _integer(name, kind)
        for name, kind in kinds.items()
    }
    parsed = read_fields(_raw_values(log)).select(
        *lineage,
        "rawValue",
        F.expr(f"_malformed OR (_ambiguous AND {holds_container(*TEXT_FIELDS)})").alias("_malformed"),
        *[F.expr(value).alias(name) for name, value in values.items()],
    )
    no_number = _any(*[f"{name} IS NULL" for name, kind in kinds.items() if kind != "string"])
    reason = (
        F.when(F.expr(f"_malformed OR {no_number}"), cfg.REASON_MALFORMED)
        .when(E.is_blank(F.col("eventId")), cfg.REASON_EVENT_ID)
        .when(E.is_blank(F.col("userId")), cfg.REASON_USER_ID)
        .when(~F.col("eventTime").between(1, cfg.MAX_EPOCH_MILLIS), cfg.REASON_EVENT_TIME)
        .when(F.col("amount") < 0, cfg.REASON_AMOUNT)
    )
    return parsed.withColumn("reason", reason).select(
        *lineage,
        "rawValue",
        *TRANSACTION_FIELDS,
        E.event_timestamp(F.col("eventTime")).alias("event_ts"),
        "reason",
    )


def valid_transactions(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).drop("reason", "rawValue")


def rejected_records(
    parsed: DataFrame, observed_at: int | None = None, topics: Topics = DEFAULT_TOPICS
) -> DataFrame:
    """Quarantine records for the rows that failed."""
    return parsed.filter(F.col("reason").isNotNull()).select(
        F.lit(cfg.ERROR_PARSE).alias("errorType"),
        "reason",
        F.lit(",".join(topics.sources)).alias("sourceTopic"),
        F.lit(topics.replay).alias("replayTopic"),
        "rawValue",
        E.now_millis(observed_at).alias("observedAt"),
    )


def read_transactions_leniently(log: DataFrame) -> DataFrame:
    """The source of the SQL aggregate: unreadable records are dropped, unreadable
    fields are null, nothing is checked and nothing is quarantined."""
    lineage = [c for c in log.columns if c not in ("key", "value")]
    columns = []
    for field in TRANSACTION.fields:
        kind, text = field.dataType.simpleString(), f"_text.{field.name}"
        if kind == "string":
            value = text
        elif kind == "double":
            value = f"try_cast({text} AS DOUBLE)"
        else:
            value = _integer(field.name, kind, missing="NULL")
        columns.append(F.expr(value).alias(field.name))
    fields = read_fields(_raw_values(log)).filter("NOT _malformed").select(*lineage, *columns)
    return fields.withColumn("event_ts", E.event_timestamp(F.col("eventTime")))

"""Repair of quarantined records, so that they can be fed back.

Each record of the quarantine log gets one `status`:

- repaired: goes to the replay topic;
- dropped: the record or the text it quarantines is no JSON, or is empty;
- unrecoverable: JSON, but no object, or with a field that no default or cast
  can mend. `problem` says which. These rows are kept for a person to look at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream import config as cfg
from riskstream.functions import expressions as E
from riskstream.functions import rules as R
from riskstream.operators.parse import (
    JSON_READ,
    NUMBER_KIND,
    holds_container,
    json_kind,
    read_fields,
    starts_container,
)
from riskstream.schemas import DLQ, TEXT_FIELDS, TRANSACTION_FIELDS

REPAIRED, DROPPED, UNRECOVERABLE = "repaired", "dropped", "unrecoverable"
REPLAYED_AT = "replayedFromDlqAt"

_CORRUPT = JSON_READ["columnNameOfCorruptRecord"]
_RECORD = T.StructType([T.StructField(f.name, f.dataType) for f in DLQ.fields] + [T.StructField(_CORRUPT, T.StringType())])
_MEMBERS = T.MapType(T.StringType(), T.VariantType())

_DECIMAL_TEXT = r"^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$"
_INTEGER_TEXT = r"^\\s*[+-]?\\d+\\s*$"
# texts of JSON values that count as "no value", unless they are JSON strings
_EMPTY_TEXT = r"^(false|\\[\\]|\\{\\}|-?0+(\\.0*)?([eE].*)?)$"

_NUMBERS = {"amount": _DECIMAL_TEXT, "mlFraudScore": _DECIMAL_TEXT, "ipRisk": _INTEGER_TEXT}

# the records whose field texts do not tell enough, see parse.read_fields
_AMBIGUOUS = " OR ".join(
    [starts_container(f) for f in TEXT_FIELDS]
    + [f"coalesce(_text.{f} RLIKE '{_EMPTY_TEXT}', false)" for f in TEXT_FIELDS]
    + [f"coalesce(NOT _text.{f} RLIKE '{pattern}', false)" for f, pattern in _NUMBERS.items()]
)


def _number(field: str, kind: str) -> str:
    """0 for a missing field; null where the value is null or no number."""
    text, json = f"_text.{field}", json_kind(field)
    return f"""CASE
        WHEN {text} IS NULL AND NOT array_contains(_names, '{field}') THEN CAST(0 AS {kind})
        WHEN {text} RLIKE '{_NUMBERS[field]}' THEN try_cast(trim({text}) AS {kind})
        WHEN {json} = 'BOOLEAN' THEN CAST({text} = 'true' AS {kind})
        WHEN {json} RLIKE '{NUMBER_KIND}' THEN try_cast(try_cast({text} AS DOUBLE) AS {kind})
        END"""


def _is_empty(field: str) -> str:
    text = f"_text.{field}"
    return f"""(coalesce({text}, '') = ''
        OR (_ambiguous AND {json_kind(field)} <> 'STRING' AND {text} RLIKE '{_EMPTY_TEXT}'))"""


def is_one_json(column: str) -> Column:
    """True for a text that is one JSON value and nothing more. Spark's readers
    stop after the first value. What follows it breaks a list around the text, or
    an object around it, unless it is white space."""
    listed = F.from_json(F.concat(F.lit("["), F.col(column), F.lit("]")), "array<string>")
    member = F.from_json(F.concat(F.lit('{"v":'), F.col(column), F.lit("}")), "map<string,string>")
    return F.coalesce((F.size(listed) == 1) & (F.size(member) == 1), F.lit(False))


def repair(dlq_log: DataFrame, now: int | None = None, only_replayable: bool = False) -> DataFrame:
    """Quarantine log (Kafka layout, JSON values) → one row per record with
    partition, offset, `status`, `problem`, the repaired transaction, and `extra`,
    the JSON object of the fields that are not declared.

    `now` (epoch millis) becomes the event time and the replay time.
    """
    log = dlq_log.select("partition", "offset", F.col("value").cast("string").alias("value"))
    read = E.computed_once(log, {"_record": F.from_json("value", _RECORD, JSON_READ), "_strict": is_one_json("value")})
    record = read.selectExpr(
        "partition",
        "offset",
        "_record.errorType AS errorType",
        "_record.rawValue AS rawValue",
        f"_strict AND _record IS NOT NULL AND _record.{_CORRUPT} IS NULL AND coalesce(_record.rawValue, '') <> '' AS _has_text",
    )
    if only_replayable:
        record = record.filter(R.is_replayable(F.col("errorType")))

    # one scan for the names; the members are read only where some are undeclared
    named = read_fields(record, _AMBIGUOUS).withColumn("_names", F.expr("json_object_keys(rawValue)"))
    declared = ", ".join(f"'{name}'" for name in [*TRANSACTION_FIELDS, REPLAYED_AT])
    nested = " OR ".join(f"({holds_container(f)} AND NOT {_is_empty(f)})" for f in TEXT_FIELDS)
    values = E.computed_once(
        named.drop("errorType"),
        {
            "_is_object": F.expr("NOT _malformed AND _names IS NOT NULL"),
            "_one_value": is_one_json("rawValue"),
            "_has_extra": F.expr(f"size(array_except(_names, array({declared}))) > 0"),
            "_nested": F.expr(nested),
            "amount": F.expr(_number("amount", "double")),
            "mlFraudScore": F.expr(_number("mlFraudScore", "double")),
            "ipRisk": F.expr(_number("ipRisk", "int")),
            **{f: F.expr(f"CASE WHEN NOT {_is_empty(f)} THEN _text.{f} END") for f in TEXT_FIELDS},
        },
    )

    def is_finite(field: str) -> Column:
        return F.expr(f"coalesce(abs({field}) < double('Infinity'), false)")

    problem = (
        F.when(~F.col("_has_text"), F.lit(None).cast("string"))
        .when(~F.col("_one_value"), F.lit(None).cast("string"))
        .when(~F.col("_is_object"), F.when(F.try_parse_json("rawValue").isNotNull(), "not a JSON object"))
        .when(F.col("_nested"), "a text field holds an object or a list")
        .when(~is_finite("amount"), "amount is no number")
        .when(~is_finite("mlFraudScore"), "mlFraudScore is no number")
        .when(F.col("ipRisk").isNull(), "ipRisk is no integer")
    )
    status = (
        F.when(F.col("problem").isNotNull(), UNRECOVERABLE)
        .when(F.col("_has_text") & F.col("_one_value") & F.col("_is_object"), REPAIRED)
        .otherwise(DROPPED)
    )
    defaults = {name: F.lit(text) for name, text in cfg.REPLAY_DEFAULTS.items()}
    defaults["eventId"] = F.concat(F.lit(cfg.REPLAY_ID_PREFIX), "partition", F.lit("-"), "offset")
    fields = {
        **{name: F.coalesce(F.col(name), default) for name, default in defaults.items()},
        "eventTime": E.now_millis(now),
        "amount": F.greatest(F.col("amount"), F.lit(0.0)),
    }
    undeclared = F.map_filter(
        F.from_json("rawValue", _MEMBERS, JSON_READ), lambda name, _: ~name.isin(*TRANSACTION_FIELDS, REPLAYED_AT)
    )
    return values.withColumn("problem", problem).select(
        "partition",
        "offset",
        status.alias("status"),
        "problem",
        "rawValue",
        *[fields.get(name, F.col(name)).alias(name) for name in TRANSACTION_FIELDS],
        E.now_millis(now).alias(REPLAYED_AT),
        F.when(F.col("_has_extra"), F.to_json(undeclared)).otherwise("{}").alias("extra"),
    )


def repaired(tagged: DataFrame, already_replayed: DataFrame | None = None) -> DataFrame:
    """The rows to replay; `already_replayed` (partition, offset) leaves out those
    that an earlier run has sent."""
    rows = tagged.filter(F.col("status") == REPAIRED).drop("status", "problem", "rawValue")
    if already_replayed is not None:
        rows = rows.join(already_replayed.select("partition", "offset"), ["partition", "offset"], "left_anti")
    return rows


def unrecoverable(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("status") == UNRECOVERABLE).select("partition", "offset", "problem", "rawValue")


def first_records(rows: DataFrame, max_records: int = cfg.REPLAY_MAX_RECORDS) -> DataFrame:
    """The run limit of the replay: at most this many records, oldest first."""
    return rows.orderBy("partition", "offset").limit(max_records)


def replay_records(rows: DataFrame) -> DataFrame:
    """Repaired rows as (key, value) of the replay topic: compact JSON, with the
    undeclared fields after the declared ones."""
    declared = F.to_json(F.struct(*TRANSACTION_FIELDS, REPLAYED_AT), E.JSON_WRITE)
    extra = F.col("extra")
    joined = F.concat(F.substr(declared, F.lit(1), F.length(declared) - 1), F.lit(","), F.substr(extra, F.lit(2)))
    return rows.select(
        "partition",
        "offset",
        F.col("userId").alias("key"),
        F.when(F.length(extra) > 2, joined).otherwise(declared).alias("value"),
    )

"""Record contracts per topic subject, and checks against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream.schemas import AGGREGATE, ALERT, DLQ, TRANSACTION

# One contract may serve several subjects. `schemaVersion` is part of every
# contract and has a default, so records without it are fine.
CONTRACTS: dict[str, T.StructType] = {
    "transactions.raw-value": TRANSACTION,
    "transactions.replay-value": TRANSACTION,
    "alerts.fraud-value": ALERT,
    "transactions.aggregates-value": AGGREGATE,
    "transactions.dlq-value": DLQ,
}
VERSION_FIELD = T.StructField("schemaVersion", T.IntegerType(), True)

# fixed values: fields that a record may leave out, with what they then mean
DEFAULTS: dict[str, dict] = {
    "transactions.raw-value": {"currency": "USD", "mlFraudScore": 0.0, "ipRisk": 0, "schemaVersion": 1},
    "transactions.replay-value": {"currency": "USD", "mlFraudScore": 0.0, "ipRisk": 0, "schemaVersion": 1},
}
_VERSION_DEFAULT = {"schemaVersion": 1}


class ContractError(ValueError):
    pass


def required_fields(subject: str) -> list[str]:
    with_default = DEFAULTS.get(subject, {})
    return [f.name for f in CONTRACTS[subject].fields if not f.nullable and f.name not in with_default]


def schema_problems(schema: T.StructType, subject: str) -> list[str]:
    """Differences of a schema from its contract that break readers."""
    have = {f.name: f.dataType for f in schema.fields}
    problems = []
    required = set(required_fields(subject))
    for field in [*CONTRACTS[subject].fields, VERSION_FIELD]:
        if field.name not in have:
            if field.name in required:
                problems.append(f"required field {field.name} is missing")
        elif have[field.name] != field.dataType:
            problems.append(
                f"field {field.name} is {have[field.name].simpleString()}, not {field.dataType.simpleString()}"
            )
    return problems


def assert_contract(df: DataFrame, subject: str) -> DataFrame:
    """The frame, if its columns fit the contract. Where the schema lets a required
    field be null, a null in it fails the query that reads it."""
    problems = schema_problems(df.schema, subject)
    if problems:
        raise ContractError(f"{subject}: " + "; ".join(problems))
    unsure = [f for f in df.schema.fields if f.nullable and f.name in required_fields(subject)]
    if not unsure:
        return df
    return df.withColumns({f.name: _not_null(f, subject) for f in unsure})


def _not_null(field: T.StructField, subject: str) -> Column:
    missing = F.raise_error(F.lit(f"{subject}: required field {field.name} is null"))
    return F.coalesce(F.col(field.name), missing.cast(field.dataType))


def evolution_problems(
    new: T.StructType, subject: str, defaults: tuple[str, ...] = ()
) -> list[str]:
    """What makes `new` a breaking successor of the contract: a required field is
    gone, a type changed, or an added field is neither nullable nor defaulted."""
    old = {f.name for f in CONTRACTS[subject].fields} | {VERSION_FIELD.name}
    problems = schema_problems(new, subject)
    for field in new.fields:
        if field.name not in old and not field.nullable and field.name not in defaults:
            problems.append(f"added field {field.name} has no default")
    return problems


def apply_defaults(df: DataFrame, subject: str) -> DataFrame:
    """Add the contract fields that the frame lacks, with their defaults."""
    defaults = {**_VERSION_DEFAULT, **DEFAULTS.get(subject, {})}
    for field in [*CONTRACTS[subject].fields, VERSION_FIELD]:
        if field.name not in df.columns and (field.nullable or field.name in defaults):
            df = df.withColumn(field.name, F.lit(defaults.get(field.name)).cast(field.dataType))
    return df


def null_report(df: DataFrame, subject: str) -> DataFrame:
    """Records and nulls per required field, in one pass over the data."""
    fields = required_fields(subject)
    counts = df.agg(
        F.count(F.lit(1)).alias("records"), *[F.count_if(F.col(f).isNull()).alias(f) for f in fields]
    )
    return counts.select("records", F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("nulls")) for f in fields])))

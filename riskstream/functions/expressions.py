"""Scalar expressions. Everything here is a Column, so it stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream import config as cfg
from riskstream.schemas import TRANSACTION_FIELDS

# null fields are written as JSON null
JSON_WRITE = {"ignoreNullFields": "false"}


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The frame with costly columns added, each evaluated once per row.

    Spark pushes filters down by copying the expressions they use, and merges
    projections in the same way. It does not do so across an explode, here of an
    array of one struct. The struct is made before the explode, in a projection,
    which Spark compiles better than the arguments of a generator.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    made = df.withColumn("_row", row)
    return made.withColumn("_once", F.explode(F.array("_row"))).select(*df.columns, "_once.*")


def is_blank(value: Column) -> Column:
    """Null, empty or made of (Unicode) white space only."""
    # most texts begin with a printable ASCII character and need no pattern match
    printable = (value >= "!") & (value < "\x7f")
    return value.isNull() | (~printable & ~value.rlike(r"\P{javaWhitespace}"))


def or_default(value: Column, fallback: str) -> Column:
    """The value, or the fallback where it is blank."""
    return F.when(is_blank(value), F.lit(fallback)).otherwise(value)


def merchant_key() -> Column:
    return or_default(F.col("merchantId"), cfg.UNKNOWN_MERCHANT)


def aggregate_key() -> Column:
    """country|category|merchant with blanks replaced."""
    return F.concat_ws(
        "|",
        or_default(F.col("country"), cfg.UNKNOWN_COUNTRY),
        or_default(F.col("category"), cfg.UNKNOWN_CATEGORY),
        merchant_key(),
    )


def coalesced_key() -> Column:
    """country|category|merchant of the SQL aggregate: only nulls are replaced."""
    return F.concat_ws(
        "|",
        F.coalesce(F.col("country"), F.lit(cfg.UNKNOWN_COUNTRY)),
        F.coalesce(F.col("category"), F.lit(cfg.UNKNOWN_CATEGORY)),
        F.coalesce(F.col("merchantId"), F.lit(cfg.UNKNOWN_MERCHANT)),
    )


def round_half_up(value: Column) -> Column:
    """Two digits, halves upwards, in binary arithmetic: 1.005 gives 1.0.
    round() works on the decimal digits and would give 1.01. Values beyond what
    a long holds in hundredths give its largest, as rounding to a long does."""
    return F.floor(value * 100.0 + 0.5) / 100.0


def ratio(total: Column, count: Column) -> Column:
    """total / count, and 0.0 for an empty count."""
    return F.when(count == 0, F.lit(0.0)).otherwise(total / count)


def event_timestamp(millis: Column) -> Column:
    """Epoch millis as a timestamp; null where a timestamp cannot hold them."""
    return F.when(millis.between(-cfg.MAX_EPOCH_MILLIS, cfg.MAX_EPOCH_MILLIS), F.timestamp_millis(millis))


def equals_ignore_case(value: Column, literal: str) -> Column:
    return F.upper(F.coalesce(value, F.lit(""))) == literal.upper()


def two_digits(value: Column) -> Column:
    return F.format_string("%.2f", value)


def four_digits(value: Column) -> Column:
    return F.format_string("%.4f", value)


def now_millis(observed_at: int | None) -> Column:
    """A given instant, or the time of the query."""
    if observed_at is None:
        return F.unix_millis(F.current_timestamp())
    return F.lit(observed_at).cast("bigint")


def alert_id(alert_type: Column, key: Column, window_start: Column, sample: Column, random: bool = False) -> Column:
    """Id of an alert. By default the same alert gets the same id on every run,
    so that an at-least-once sink can upsert; random=True gives a fresh UUID."""
    if random:
        return F.expr("uuid()")
    return F.sha2(F.concat_ws("|", alert_type, key, window_start.cast("string"), sample), 256)


def transaction_json() -> Column:
    """The transaction as JSON text, as kept in quarantine records."""
    return F.to_json(F.struct(*TRANSACTION_FIELDS), JSON_WRITE)


# Positions are packed into one BIGINT so that the first event of a group is a
# fixed-width min() and the aggregate stays a hash aggregate.
_OFFSET_BITS = 44
_PARTITION_BITS = 63 - _OFFSET_BITS


def position(rows: DataFrame, topics: tuple[str, ...] = cfg.DEFAULT_TOPICS.sources) -> Column:
    """Arrival position of a log row: partition, place of its topic among `topics` if
    the rows name it, offset. Rows of several topics so have different positions."""
    partition, offset = F.col("partition").cast("bigint"), F.col("offset").cast("bigint")
    if "topic" in rows.columns:
        unknown = F.raise_error(F.concat(F.lit("no position for topic "), F.col("topic"))).cast("bigint")
        place = unknown
        for i, name in enumerate(topics):
            place = F.when(F.col("topic") == name, F.lit(i).cast("bigint")).otherwise(place)
        partition = partition * len(topics) + F.when(F.col("topic").isNull(), F.lit(0).cast("bigint")).otherwise(place)
    fits = (
        partition.between(0, (1 << _PARTITION_BITS) - 1) & offset.between(0, (1 << _OFFSET_BITS) - 1)
    )
    packed = F.shiftleft(partition, _OFFSET_BITS).bitwiseOR(offset)
    return F.when(fits, packed).otherwise(
        F.raise_error(F.lit("log position does not fit 19 bits of partition and 44 bits of offset")).cast("bigint")
    )

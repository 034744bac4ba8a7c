import pytest
from pyspark.errors import PySparkException

from riskstream.operators import contracts, topics
from riskstream.operators.contracts import ContractError
from riskstream.schemas import ALERT, LOG, TRANSACTION
from riskstream.sources import logs, sinks
from pyspark.sql import types as T


@pytest.fixture(scope="module")
def log(spark):
    rows = [("transactions.raw", p, o, None, None, bytearray(b'{"a":1}')) for p in (0, 1) for o in range(10, 30)]
    rows += [("transactions.dlq", 0, o, None, bytearray(b"k"), bytearray(b"text")) for o in range(3)]
    rows += [("unlisted", 0, 0, None, None, None)]
    return spark.createDataFrame(rows, LOG)


@pytest.fixture(scope="module")
def committed(spark):
    return spark.createDataFrame(
        [("transactions.raw", 0, 25), ("transactions.raw", 1, -1), ("transactions.dlq", 0, 99)],
        "topic string, partition int, offset bigint",
    )


def test_statistics(log, committed):
    got = {(r.topic, r.partition): tuple(r)[2:] for r in topics.topic_statistics(log, committed).collect()}
    assert got[("transactions.raw", 0)] == (1, 20, 30, 5)
    assert got[("transactions.raw", 1)] == (1, 20, 30, None)
    assert got[("transactions.dlq", 0)] == (1, 3, 3, 0)
    assert got[("alerts.fraud", None)] == (0, None, None, None)
    assert ("unlisted", 0) not in got and len(got) == 8


def test_totals_and_headline(log, committed):
    statistics = topics.topic_statistics(log, committed)
    assert {tuple(r) for r in topics.topic_totals(statistics).collect()} == {
        ("transactions.raw", 40, 5),
        ("transactions.dlq", 3, 0),
    }
    assert tuple(topics.headline_counts(statistics).first()) == (3, None)


def test_tail(log):
    rows = topics.topic_tail(log, "transactions.raw", limit=6).collect()
    assert [(r.partition, r.offset) for r in rows] == [(0, 26), (0, 27), (0, 28), (0, 29), (1, 26), (1, 27)]
    assert all(r.valueIsJson for r in rows)
    rows = topics.topic_tail(log, "transactions.dlq", limit=2, from_beginning=True).collect()
    assert [(r.offset, r.key, r.value, r.valueIsJson) for r in rows] == [(0, "k", "text", False), (1, "k", "text", False)]


@pytest.mark.parametrize("limit", [0, 201, -1])
def test_tail_limit_is_checked(log, limit):
    with pytest.raises(ValueError, match="between 1 and 200"):
        topics.topic_tail(log, "transactions.raw", limit)


def test_tail_of_unknown_topic(log):
    with pytest.raises(LookupError, match="nowhere"):
        topics.topic_tail(log, "nowhere")


def test_contract_of_a_frame(spark):
    frame = spark.createDataFrame([], TRANSACTION)
    assert contracts.assert_contract(frame, "transactions.raw-value") is frame
    assert contracts.assert_contract(frame.drop("currency", "ipRisk"), "transactions.replay-value")
    with pytest.raises(ContractError, match="userId is missing"):
        contracts.assert_contract(frame.drop("userId"), "transactions.raw-value")
    with pytest.raises(ContractError, match="amount is string, not double"):
        contracts.assert_contract(frame.withColumn("amount", frame.amount.cast("string")), "transactions.raw-value")


def test_contract_evolution():
    def problems(*fields):
        return contracts.evolution_problems(T.StructType([*ALERT.fields, *fields]), "alerts.fraud-value", ("d",))

    assert problems(T.StructField("note", T.StringType(), True)) == []
    assert problems(T.StructField("d", T.StringType(), False)) == []
    assert problems(T.StructField("x", T.StringType(), False)) == ["added field x has no default"]
    less = T.StructType([f for f in ALERT.fields if f.name not in ("reason", "sampleEventId")])
    assert contracts.evolution_problems(less, "alerts.fraud-value") == ["required field reason is missing"]


def test_contract_defaults(spark):
    frame = spark.createDataFrame([("e", "u", 1, 2.0)], "eventId string, userId string, eventTime bigint, amount double")
    row = contracts.apply_defaults(frame, "transactions.raw-value").first()
    assert (row.currency, row.ipRisk, row.mlFraudScore, row.schemaVersion, row.country) == ("USD", 0, 0.0, 1, None)


def test_null_report(spark):
    frame = spark.createDataFrame(
        [("e", None, 1, 2.0), (None, None, 1, 2.0)], "eventId string, userId string, eventTime bigint, amount double"
    )
    got = {r.field: (r.records, r.nulls) for r in contracts.null_report(frame, "transactions.raw-value").collect()}
    assert got == {"eventId": (2, 1), "userId": (2, 2), "eventTime": (2, 0), "amount": (2, 0)}


def test_json_sink_writes_nulls_and_key(spark):
    frame = spark.createDataFrame([("u", None, 1.5)], "userId string, country string, amount double")
    assert sinks.json_values(frame).first().value == '{"userId":"u","country":null,"amount":1.5}'
    assert tuple(sinks.json_values(frame, key="userId").first()) == ("u", '{"userId":"u","country":null,"amount":1.5}')


def test_kafka_options():
    assert logs.kafka_options("host:9092", ("a", "b")) == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "a,b",
        "startingOffsets": "latest",
    }


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_log_files_round_trip(spark, log, tmp_path, fmt):
    log.write.format(fmt).save(str(tmp_path / fmt))
    back = logs.file_table(spark, str(tmp_path / fmt), fmt)
    assert back.exceptAll(log).count() == 0 and back.count() == log.count()


def test_null_in_a_required_field_fails_the_query(spark):
    frame = spark.createDataFrame([("e", None, 1, 2.0)], "eventId string, userId string, eventTime bigint, amount double")
    checked = contracts.assert_contract(frame, "transactions.raw-value")
    assert checked.dtypes == frame.dtypes and checked.select("amount").first().amount == 2.0
    with pytest.raises(PySparkException, match="required field userId is null"):
        checked.collect()

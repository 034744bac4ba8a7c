import math

import pytest

from riskstream.operators import parse
from riskstream.schemas import LOG, TRANSACTION_FIELDS
from riskstream.sources.logs import text_log

GOOD = '{"eventId":"e","userId":"u","eventTime":1760000000000,"amount":42.5%s}'
MALFORMED = "malformed JSON"

# text → reason, and fields of the row that are looked at
CASES = [
    (GOOD % "", None, {"eventId": "e", "amount": 42.5, "mlFraudScore": 0.0, "ipRisk": 0, "merchantId": None}),
    (GOOD % ',"unexpectedNewField":{"a":[1]}', None, {"eventId": "e"}),
    (GOOD % ',"mlFraudScore":0.13', None, {"mlFraudScore": 0.13}),
    ('{"eventId":"e","userId":"u","eventTime":"1760000000000","amount":"42.5"}', None, {"amount": 42.5}),
    ('{"eventId":"e","userId":"u","eventTime":1.76e12,"amount":1}', None, {"eventTime": 1_760_000_000_000}),
    ('{"eventId":"e","userId":"u","eventTime":"1.76e12","amount":1}', MALFORMED, {}),
    (GOOD % ',"ipRisk":35.7', None, {"ipRisk": 35}),
    (GOOD % ',"ipRisk":"35"', None, {"ipRisk": 35}),
    (GOOD % ',"ipRisk":"35.7"', MALFORMED, {}),
    (GOOD % ',"ipRisk":3000000000', MALFORMED, {}),
    (GOOD % ',"ipRisk":true', MALFORMED, {}),
    (GOOD % ',"ipRisk":[1]', MALFORMED, {}),
    ('{"eventId":"e","userId":"u","eventTime":1,"amount":""}', None, {"amount": 0.0}),
    ('{"eventId":"e","userId":"u","eventTime":1,"amount":"abc"}', MALFORMED, {}),
    ('{"eventId":"e","userId":"u","eventTime":1,"amount":true}', MALFORMED, {}),
    ('{"eventId":"e","userId":"u","eventTime":1,"amount":null}', None, {"amount": 0.0}),
    ('{"eventId":"e","userId":"u","eventTime":1}', None, {"amount": 0.0}),
    ('{"eventId":"e","userId":"u","eventTime":1,"amount":NaN}', MALFORMED, {}),
    ('{"eventId":"e","userId":"u","eventTime":1,"amount":"NaN"}', None, {"amount": math.nan}),
    ('{"eventId":"e","userId":"u","eventTime":1,"amount":"nan"}', MALFORMED, {}),
    ('{"eventId":"e","userId":"u","eventTime":1,"amount":1e400}', None, {"amount": math.inf}),
    ('{"eventId":12,"userId":"u","eventTime":1,"amount":1}', None, {"eventId": "12"}),
    ('{"eventId":{"x":1},"userId":"u","eventTime":1,"amount":1}', MALFORMED, {}),
    ('{"eventId":"{x","userId":"u","eventTime":1,"amount":1}', None, {"eventId": "{x"}),
    ('{"eventId":"[1]","userId":"u","eventTime":1,"amount":1}', None, {"eventId": "[1]"}),
    (GOOD % ',"country":["KR"]', MALFORMED, {}),
    (GOOD % "" + " trailing", None, {"eventId": "e"}),
    ('{"eventId":"a","eventId":"b","userId":"u","eventTime":1,"amount":1}', None, {"eventId": "b"}),
    ('{"EVENTID":"a","userId":"u","eventTime":1,"amount":1}', "eventId is required", {}),
    ('[{"eventId":"e"}]', MALFORMED, {}),
    ("null", MALFORMED, {}),
    ("3", MALFORMED, {}),
    ("", MALFORMED, {}),
    ("  ", MALFORMED, {}),
    ('{"eventId": "", "broken": true', MALFORMED, {}),
    ("{'eventId':'e','userId':'u','eventTime':1,'amount':1}", MALFORMED, {}),
    ('{"eventId":"","userId":"","eventTime":0,"amount":-1}', "eventId is required", {}),
    ('{"eventId":"\\t ","userId":"u","eventTime":1,"amount":1}', "eventId is required", {}),
    ('{"eventId":"e","userId":" ","eventTime":0,"amount":-1}', "userId is required", {}),
    ('{"eventId":"e","userId":"u","eventTime":0,"amount":-1}', "eventTime must be epoch millis", {}),
    ('{"eventId":"e","userId":"u","eventTime":-5,"amount":1}', "eventTime must be epoch millis", {}),
    ('{"eventId":"e","userId":"u","eventTime":9223372036854775807,"amount":1}', "eventTime must be epoch millis", {}),
    ('{"eventId":"e","userId":"u","eventTime":99223372036854775807,"amount":1}', MALFORMED, {}),
    ('{"eventId":"e","userId":"u","eventTime":1,"amount":-0.01}', "amount must be non-negative", {}),
    ('{"eventId":"e","userId":"u","eventTime":1,"amount":0}', None, {"amount": 0.0}),
]


def log_of(spark, texts):
    rows = [(0, i, t) for i, t in enumerate(texts)]
    return text_log(spark.createDataFrame(rows, "partition int, offset bigint, value string"), "transactions.raw")


@pytest.fixture(scope="module")
def parsed(spark):
    frame = parse.parse_transactions(log_of(spark, [c[0] for c in CASES]))
    return {r.offset: r for r in frame.collect()}


@pytest.mark.parametrize("number", range(len(CASES)), ids=lambda i: CASES[i][0][:60])
def test_parse(parsed, number):
    text, reason, fields = CASES[number]
    row = parsed[number]
    assert row.reason == reason
    assert row.rawValue == text
    for name, want in fields.items():
        if isinstance(want, float) and math.isnan(want):
            assert math.isnan(row[name])
        else:
            assert row[name] == want


def test_rows_are_split_without_loss(spark):
    frame = parse.parse_transactions(log_of(spark, [c[0] for c in CASES]))
    good, bad = parse.valid_transactions(frame), parse.rejected_records(frame, 7)
    assert good.count() == sum(c[1] is None for c in CASES)
    assert good.count() + bad.count() == len(CASES)
    assert {(r.errorType, r.sourceTopic, r.replayTopic, r.observedAt) for r in bad.collect()} == {
        ("PARSE_OR_VALIDATION_ERROR", "transactions.raw,transactions.replay", "transactions.replay", 7)
    }


def test_null_value_is_rejected(spark):
    log = spark.createDataFrame([("t", 0, 0, None, None, None)], LOG)
    row = parse.parse_transactions(log).first()
    assert (row.reason, row.rawValue) == (MALFORMED, "")


def test_observed_now_by_default(spark):
    frame = parse.rejected_records(parse.parse_transactions(log_of(spark, ["x"])))
    assert frame.first().observedAt > 1_700_000_000_000


def test_lenient_read(spark):
    texts = [
        '{"eventId":"","amount":"abc","eventTime":1.5e3,"ipRisk":"7"}',
        "broken",
        '{"amount":"","country":{"a":1}}',
        '{"eventTime":-60000,"amount":-2,"ipRisk":"7.5"}',
    ]
    rows = parse.read_transactions_leniently(log_of(spark, texts)).orderBy("offset").collect()
    assert [(r.offset, r.eventId, r.amount, r.eventTime, r.ipRisk, r.country, r.mlFraudScore) for r in rows] == [
        (0, "", None, 1500, 7, None, None),
        (2, None, None, None, None, '{"a":1}', None),
        (3, None, -2.0, -60000, None, None, None),
    ]


def test_fields_keep_their_types(spark):
    frame = parse.valid_transactions(parse.parse_transactions(log_of(spark, [GOOD % ""])))
    assert dict(frame.dtypes)["eventTime"] == "bigint"
    assert dict(frame.dtypes)["ipRisk"] == "int"
    assert set(TRANSACTION_FIELDS) <= set(frame.columns)

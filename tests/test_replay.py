import json

import pytest

from riskstream.operators import parse, replay
from riskstream.sources.logs import text_log
from riskstream.sources import sinks

NOW = 1_760_000_000_000


def dlq(raw, error="PARSE_OR_VALIDATION_ERROR"):
    return json.dumps(
        dict(errorType=error, reason="r", sourceTopic="s", replayTopic="t", rawValue=raw, observedAt=1)
    )


def tagged(spark, values, **options):
    rows = [(0, i, v) for i, v in enumerate(values)]
    log = text_log(spark.createDataFrame(rows, "partition int, offset bigint, value string"), "transactions.dlq")
    return replay.repair(log, NOW, **options)


CASES = [
    (dlq('{"eventId":"e","userId":"u","amount":5,"eventTime":1}'), "repaired", {"eventId": "e", "amount": 5.0}),
    (dlq("{}"), "repaired", {"eventId": "replay-0-1", "userId": "user-replayed", "merchantId": "merchant-replayed"}),
    (dlq('{"eventId":"","category":null,"currency":""}'), "repaired", {"category": "replay", "currency": "USD"}),
    (dlq('{"eventId":0,"country":false,"channel":[],"deviceId":{}}'), "repaired",
     {"eventId": "replay-0-3", "country": "UNKNOWN", "channel": "replay", "deviceId": "device-replayed"}),
    (dlq('{"eventId":"0","userId":"false","paymentStatus":"null"}'), "repaired",
     {"eventId": "0", "userId": "false", "paymentStatus": "null"}),
    (dlq('{"userId":"  "}'), "repaired", {"userId": "  "}),
    (dlq('{"eventId":12}'), "repaired", {"eventId": "12"}),
    (dlq('{"amount":-3.5}'), "repaired", {"amount": 0.0}),
    (dlq('{"amount":"42.5","mlFraudScore":" 0.5 ","ipRisk":"35"}'), "repaired",
     {"amount": 42.5, "mlFraudScore": 0.5, "ipRisk": 35}),
    (dlq('{"ipRisk":35.7,"amount":true}'), "repaired", {"ipRisk": 35, "amount": 1.0}),
    (dlq('{"amount":null}'), "unrecoverable", "amount is no number"),
    (dlq('{"amount":"abc"}'), "unrecoverable", "amount is no number"),
    (dlq('{"amount":""}'), "unrecoverable", "amount is no number"),
    (dlq('{"amount":[1]}'), "unrecoverable", "amount is no number"),
    (dlq('{"mlFraudScore":null}'), "unrecoverable", "mlFraudScore is no number"),
    (dlq('{"ipRisk":null}'), "unrecoverable", "ipRisk is no integer"),
    (dlq('{"ipRisk":"35.7"}'), "unrecoverable", "ipRisk is no integer"),
    (dlq('{"country":{"code":"KR"}}'), "unrecoverable", "a text field holds an object or a list"),
    (dlq("[1]"), "unrecoverable", "not a JSON object"),
    (dlq("3"), "unrecoverable", "not a JSON object"),
    (dlq("null"), "unrecoverable", "not a JSON object"),
    (dlq('{"eventId": "", "broken": true'), "dropped", None),
    (dlq(""), "dropped", None),
    (dlq(None), "dropped", None),
    ("broken", "dropped", None),
    ("", "dropped", None),
]


@pytest.fixture(scope="module")
def results(spark):
    return {r.offset: r for r in tagged(spark, [c[0] for c in CASES]).collect()}


@pytest.mark.parametrize("number", range(len(CASES)))
def test_repair(results, number):
    _, status, detail = CASES[number]
    row = results[number]
    assert row.status == status
    if status == "repaired":
        assert row.eventTime == NOW and row.replayedFromDlqAt == NOW
        for name, want in detail.items():
            assert row[name] == want
    else:
        assert row.problem == detail


def test_undeclared_fields_are_kept_with_their_types(spark):
    raw = '{"eventId":"e","userId":"u","trace":{"a":[1,2.5,null]},"n":7,"s":"x","b":true,"replayedFromDlqAt":1}'
    rows = replay.replay_records(replay.repaired(tagged(spark, [dlq(raw)])))
    value = json.loads(rows.first().value)
    assert {k: value[k] for k in ("trace", "n", "s", "b")} == {
        "trace": {"a": [1, 2.5, None]}, "n": 7, "s": "x", "b": True,
    }
    assert value["replayedFromDlqAt"] == NOW
    assert rows.first().key == "u"
    assert ": " not in rows.first().value


def test_limit_counts_repaired_rows_only(spark):
    values = [dlq(""), dlq("{}"), dlq("[1]"), dlq("{}"), dlq("{}")]
    rows = replay.first_records(replay.repaired(tagged(spark, values)), 2)
    assert [r.offset for r in rows.collect()] == [1, 3]


def test_already_replayed_rows_are_left_out(spark):
    done = spark.createDataFrame([(0, 0)], "partition int, offset bigint")
    rows = replay.repaired(tagged(spark, [dlq("{}"), dlq("{}")]), already_replayed=done)
    assert [r.offset for r in rows.collect()] == [1]


def test_only_replayable_errors(spark):
    values = [dlq("{}"), dlq("{}", "LATE_EVENT"), dlq("{}", "POISON_PILL")]
    assert replay.repaired(tagged(spark, values, only_replayable=True)).count() == 2


def test_repaired_records_pass_the_parser(spark):
    bad = [
        '{"eventId":"","userId":"u","eventTime":5,"amount":1}',
        '{"eventId":"e","userId":"","eventTime":5,"amount":1}',
        '{"eventId":"e","userId":"u","eventTime":0,"amount":1}',
        '{"eventId":"e","userId":"u","eventTime":5,"amount":-1}',
        '{"eventId":"e","userId":" ","eventTime":5,"amount":1}',
        '{"eventId": "", "broken": true',
    ]
    rows = [(0, i, v) for i, v in enumerate(bad)]
    log = text_log(spark.createDataFrame(rows, "partition int, offset bigint, value string"), "transactions.raw")
    rejected = parse.rejected_records(parse.parse_transactions(log), 1)
    assert rejected.count() == len(bad)
    values = [r.value for r in sinks.json_values(rejected).collect()]
    fixed = replay.replay_records(replay.repaired(tagged(spark, values)))
    again = parse.parse_transactions(fixed)
    # white space is no missing value to the repair, but blank to the parser
    assert sorted(str(r.reason) for r in again.collect()) == ["None"] * 4 + ["userId is required"]


@pytest.mark.parametrize("raw", ['{"eventId":"a","userId":"u"} trailing', '{"eventId":"a"}{"eventId":"b"}', '{"eventId":"a"},{"eventId":"b"}', '{"eventId":"a"}]'])
def test_text_after_the_json_is_dropped(spark, raw):
    import json

    record = json.dumps({"errorType": "PARSE_OR_VALIDATION_ERROR", "rawValue": raw})
    good = json.dumps({"errorType": "PARSE_OR_VALIDATION_ERROR", "rawValue": '{"eventId":"a"}'})
    rows = [(0, 0, record), (0, 1, good + " junk"), (0, 2, good)]
    log = spark.createDataFrame(rows, "partition int, offset bigint, value string")
    assert [r.status for r in replay.repair(log, 5).orderBy("offset").collect()] == ["dropped", "dropped", "repaired"]

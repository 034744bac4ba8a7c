"""Late events and repeated emissions against a plain, row-by-row account."""

import random

import pytest
from pyspark.sql import functions as F

from riskstream.config import WindowSpec
from riskstream.operators import emissions, late
from riskstream.schemas import TRANSACTION_FIELDS

SPEC = WindowSpec(size_ms=60_000, out_of_orderness_ms=10_000, allowed_lateness_ms=30_000)


def make_rows(seed, count=600, per_batch=15, keys=4, step=2_000, back=90_000):
    rng = random.Random(seed)
    rows, clock = [], 1_000_000
    for i in range(count):
        clock += rng.randint(0, step)
        rows.append(
            dict(
                batch_id=i // per_batch,
                partition=i % 2,
                offset=i // 2,
                eventId=f"e{i}",
                userId=f"u{rng.randrange(keys)}" if rng.random() > 0.4 else "u-hot",
                eventTime=clock - (rng.randint(0, back) if rng.random() < 0.4 else 0),
                amount=rng.randint(0, 9999) / 4.0,
                mlFraudScore=rng.randint(0, 64) / 64.0,
            )
        )
    return rows


def account(rows, key="userId"):
    """What each window emits, told row by row."""
    highest, state, late_ids, out = None, {}, [], []
    batches = {}
    for row in rows:
        batches.setdefault(row["batch_id"], []).append(row)
    for number in sorted(batches):
        mark = None if highest is None else highest - SPEC.out_of_orderness_ms - 1
        for group, win in sorted(state.items()):
            if mark is not None and not win["fired"] and mark >= group[1] + SPEC.size_ms - 1:
                win["fired"] = True
                out.append((group, "FIRE", win["n"], win["total"], win["score"], win["top"], win["first"]))
        for row in sorted(batches[number], key=lambda r: (r["partition"], r["offset"])):
            start = row["eventTime"] // SPEC.size_ms * SPEC.size_ms
            end = start + SPEC.size_ms - 1
            if mark is not None and mark >= end + SPEC.allowed_lateness_ms:
                late_ids.append(row["eventId"])
                continue
            group = (row[key], start)
            win = state.setdefault(group, dict(n=0, total=0.0, score=0.0, top=0.0, first=row["eventId"], fired=False))
            win["n"] += 1
            win["total"] += row["amount"]
            win["score"] += row["mlFraudScore"]
            win["top"] = max(win["top"], row["mlFraudScore"])
            if mark is not None and mark >= end:
                win["fired"] = True
                out.append((group, "REFIRE", win["n"], win["total"], win["score"], win["top"], win["first"]))
        highest = max([r["eventTime"] for r in batches[number]] + ([highest] if highest else []))
    mark = highest - SPEC.out_of_orderness_ms - 1
    for group, win in state.items():
        if not win["fired"] and mark >= group[1] + SPEC.size_ms - 1:
            out.append((group, "FIRE", win["n"], win["total"], win["score"], win["top"], win["first"]))
    return sorted(out), sorted(late_ids)


def frame(spark, rows):
    schema = (
        "batch_id bigint, partition int, offset bigint, eventId string, userId string, eventTime bigint, "
        "amount double, mlFraudScore double"
    )
    return spark.createDataFrame([tuple(r.values()) for r in rows], schema)


def emitted(df):
    return sorted(
        (
            (r.key, r.windowStart),
            r.kind,
            r.eventCount,
            r.totalAmount,
            r.totalFraudScore,
            r.maxFraudScore,
            r.sampleEventId,
        )
        for r in df.collect()
    )


def rounded(out):
    return [(g, k, n, round(t, 6), round(s, 6), m, f) for g, k, n, t, s, m, f in out]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_emissions_and_late_rows(spark, seed):
    rows = make_rows(seed)
    want, want_late = account(rows)
    stamped = late.stamp_watermark(frame(spark, rows), SPEC)
    got_late = sorted(r.eventId for r in late.late_events(stamped, SPEC).collect())
    assert got_late == want_late and want_late
    got = emitted(emissions.window_emissions(stamped, F.col("userId"), SPEC))
    assert sum(k == "REFIRE" for _, k, *_ in want) > 20
    assert rounded(got) == rounded(want)


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = make_rows(4)
    monkeypatch.setattr(emissions, "_BLOCK", 2)
    monkeypatch.setattr(late, "_BLOCK", 3)
    stamped = late.stamp_watermark(frame(spark, rows), SPEC)
    got = emitted(emissions.window_emissions(stamped, F.col("userId"), SPEC))
    assert rounded(got) == rounded(account(rows)[0])


def test_shuffled_watermark_join_gives_the_same(spark):
    rows = frame(spark, make_rows(5))
    broadcast, salted = late.stamp_watermark(rows, SPEC), late.stamp_watermark(rows, SPEC, broadcast_bytes=1)
    key = ["batch_id", "offset", "partition"]
    assert sorted(map(tuple, broadcast.select(*key, "watermark").collect())) == sorted(
        map(tuple, salted.select(*key, "watermark").collect())
    )


def test_first_batch_has_no_watermark(spark):
    stamped = late.stamp_watermark(frame(spark, make_rows(6)), SPEC)
    assert {r.batch_id for r in stamped.filter("watermark IS NULL").collect()} == {0}


def test_rule_is_per_window_not_per_row(spark):
    base = dict(partition=0, userId="u", amount=1.0, mlFraudScore=0.5)
    rows = [
        dict(batch_id=0, offset=0, eventId="newest", eventTime=60_000 + 39_999, **base),
        dict(batch_id=1, offset=1, eventId="in time", eventTime=5_000, **base),
        dict(batch_id=1, offset=2, eventId="newer", eventTime=60_000 + 40_000, **base),
        dict(batch_id=2, offset=3, eventId="late", eventTime=59_999, **base),
    ]
    order = ["batch_id", "partition", "offset", "eventId", "userId", "eventTime", "amount", "mlFraudScore"]
    df = frame(spark, [{k: r[k] for k in order} for r in rows])
    stamped = late.stamp_watermark(df, SPEC)
    assert [r.eventId for r in late.late_events(stamped, SPEC).collect()] == ["late"]


def test_late_record(spark):
    row = dict.fromkeys(TRANSACTION_FIELDS)
    row.update(eventId="e", userId="u", eventTime=5, amount=1.5, mlFraudScore=0.25, ipRisk=3)
    schema = "eventId string, userId string, merchantId string, category string, eventTime bigint, amount double, currency string, country string, channel string, deviceId string, mlFraudScore double, paymentStatus string, ipRisk int"
    got = late.late_records(spark.createDataFrame([tuple(row.values())], schema), 9).first()
    assert got.asDict() == {
        "errorType": "LATE_EVENT",
        "reason": "event arrived after watermark and allowed lateness",
        "sourceTopic": "transactions.raw",
        "replayTopic": "transactions.replay",
        "rawValue": '{"eventId":"e","userId":"u","merchantId":null,"category":null,"eventTime":5,"amount":1.5,'
        '"currency":null,"country":null,"channel":null,"deviceId":null,"mlFraudScore":0.25,"paymentStatus":null,"ipRisk":3}',
        "observedAt": 9,
    }

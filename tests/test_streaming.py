"""Streams fed in known batches, compared with the batch operators."""

import json
import pickle
import tempfile
from decimal import Decimal
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from test_late import SPEC, account, make_rows, rounded

from riskstream.functions import expressions as E
from riskstream.operators import aggregates, alerts, emissions, late
from riskstream.schemas import AGGREGATE, LOG, SQL_AGGREGATE
from riskstream.sources import logs, sinks
from riskstream.streaming import exact, ingest, windows
from riskstream.streaming.job import CORRECTIONS, EXACT, FINAL, RiskJob


def raw_text(row):
    return json.dumps({k: row[k] for k in ("eventId", "userId", "eventTime", "amount", "mlFraudScore")})


def write_batches(spark, rows, folder, numbers=None):
    """One log file per batch; every tenth batch also has a broken record."""
    batches = {}
    for row in rows:
        batches.setdefault(row["batch_id"], []).append(row)
    for number in sorted(batches) if numbers is None else numbers:
        records = [
            ("transactions.raw", r["partition"], r["offset"], None, None, bytearray(raw_text(r), "utf-8"))
            for r in batches[number]
        ]
        if number % 10 == 0:
            records.append(("transactions.replay", 9, number, None, None, bytearray(b'{"eventId": ""')))
        records.append(("other.topic", 0, number, None, None, bytearray(b"ignored")))
        spark.createDataFrame(records, LOG).coalesce(1).write.mode("append").parquet(folder)


def scratch(name):
    return tempfile.mkdtemp(prefix=f"run-{name}-")


def run(query):
    query.awaitTermination(240)
    assert not query.isActive
    assert query.exception() is None


def stats_of(df):
    return sorted(
        ((r.key, r.windowStart), r.kind, r.eventCount, r.totalAmount, r.totalFraudScore, r.maxFraudScore, r.sampleEventId)
        for r in df.collect()
    )


@pytest.fixture(scope="module")
def ingested(spark):
    """Twelve batches through ingest, stopped and started again after five."""
    rows = make_rows(11, count=180, per_batch=15, step=6_000)
    source, root = scratch("source"), scratch("job")
    job = RiskJob(root, SPEC, files_per_batch=5)
    for numbers in (range(5), range(5, 12)):
        write_batches(spark, rows, source, numbers)
        log = logs.file_stream(spark, source, files_per_batch=1)
        run(job.start_ingest(log, observed_at=77, available_now=True))
    return rows, source, job


def test_ingest_lands_every_row_once(spark, ingested):
    rows, _, job = ingested
    _, late_ids = account(rows)
    landed = ingest.landed_table(spark, job.root)
    assert sorted(r.eventId for r in landed.collect()) == sorted({r["eventId"] for r in rows} - set(late_ids))
    assert sorted({(r.eventId, r.batch_id) for r in landed.collect()}) == sorted(
        (r["eventId"], r["batch_id"]) for r in rows if r["eventId"] not in late_ids
    )


def test_ingest_quarantines_bad_and_late_rows(spark, ingested):
    rows, _, job = ingested
    got = ingest.landed_table(spark, job.root, ingest.QUARANTINE).collect()
    late_ids = sorted(json.loads(r.rawValue)["eventId"] for r in got if r.errorType == "LATE_EVENT")
    assert late_ids == account(rows)[1] and late_ids
    assert sum(r.errorType == "PARSE_OR_VALIDATION_ERROR" for r in got) == 2
    assert {r.observedAt for r in got} == {77}


def test_ingest_raises_alerts_for_late_rows_too(spark, ingested):
    rows, _, job = ingested
    got = ingest.landed_table(spark, job.root, ingest.ALERTS)
    want = sorted(r["eventId"] for r in rows if r["mlFraudScore"] >= 0.92)
    assert sorted(r.sampleEventId for r in got.collect()) == want


def test_retried_batch_is_not_written_twice(spark, ingested):
    _, _, job = ingested
    folder = f"{job.root}/{ingest.LANDED}/batch_id=3"
    before = spark.read.parquet(folder).inputFiles()
    ingest.write_once(spark.read.parquet(folder).limit(0), folder)
    assert spark.read.parquet(folder).inputFiles() == before


def test_exact_mode_equals_batch_account(spark, ingested):
    rows, _, job = ingested
    exact.use_disk_state(spark)
    folder = scratch("exact")
    for files in (3, None):  # the second run finds nothing new
        stream = ingest.landed_stream(spark, job.root, files)
        results = exact.exact_emissions(stream, F.col("userId"), SPEC)
        run(sinks.start_file_sink(results, f"{folder}/out", f"{folder}/checkpoint", available_now=True))
    got = stats_of(spark.read.parquet(f"{folder}/out"))
    want, _ = account(rows)
    assert sum(k == "REFIRE" for _, k, *_ in want) > 5
    assert rounded(got) == rounded(want)


def test_exact_mode_equals_batch_operator(spark, ingested):
    _, _, job = ingested
    landed = ingest.landed_table(spark, job.root)
    batch = emissions.window_emissions(landed, F.col("userId"), SPEC)
    assert rounded(stats_of(batch)) == rounded(account(ingested[0])[0])


def test_job_windows_in_both_modes(spark, ingested):
    rows, _, job = ingested
    for query in job.start_windows(spark, available_now=True).values():
        run(query)
    landed = ingest.landed_table(spark, job.root)
    stats = emissions.window_emissions(landed, E.aggregate_key(), SPEC)
    cause = ("kind", "batch_id", "partition", "offset")
    want = aggregates.aggregate_records(stats, *cause)
    got = spark.read.parquet(f"{job.root}/aggregates")
    assert got.select(want.columns).exceptAll(want).count() == 0
    assert want.exceptAll(got.select(want.columns)).count() == 0
    assert job.mode == EXACT
    assert spark.read.parquet(f"{job.root}/user_bursts").count() > 0

    final = RiskJob(scratch("final"), SPEC, mode=FINAL)
    results = final.window_results(ingest.landed_stream(spark, job.root))
    folder = scratch("final-out")
    run(sinks.start_file_sink(results["aggregates"], f"{folder}/out", f"{folder}/cp", available_now=True))
    newest = landed.agg(F.max("eventTime")).first()[0]
    done = aggregates.country_category_aggregates(landed, SPEC).filter(F.col("windowEnd") <= newest - 40_000)
    once = spark.read.parquet(f"{folder}/out")
    assert once.exceptAll(done).count() == 0 and done.exceptAll(once).count() == 0
    assert once.columns == AGGREGATE.fieldNames()


def test_corrections_end_at_the_full_value(spark, ingested):
    _, _, job = ingested
    seen = {}

    def collect(frame, batch_id):
        for row in frame.collect():
            seen.setdefault((row.key, row.windowStart), []).append(row.eventCount)

    stream = windows.stream_aggregates(ingest.landed_stream(spark, job.root, 4), SPEC)
    run(sinks.start_batch_sink(stream, collect, scratch("cp"), windows.CORRECTIONS, available_now=True))
    want = aggregates.country_category_aggregates(ingest.landed_table(spark, job.root), SPEC).collect()
    assert {k: v[-1] for k, v in seen.items()} == {(r.key, r.windowStart): r.eventCount for r in want}
    assert any(len(v) > 1 for v in seen.values())


def test_sql_aggregate_stream(spark, ingested):
    _, source, job = ingested
    run(job.start_sql_aggregates(logs.file_stream(spark, source), available_now=True))
    got = spark.read.parquet(f"{job.root}/sql_aggregates")
    assert got.columns == SQL_AGGREGATE.fieldNames()
    assert dict(got.dtypes)["windowStart"] == "timestamp"
    assert got.count() > 0


def test_late_rows_do_not_change_landed_windows(spark, ingested):
    rows, _, job = ingested
    landed = ingest.landed_table(spark, job.root)
    assert late.late_events(landed, SPEC).count() == 0


def test_outputs_are_published_as_json(spark, ingested):
    _, _, job = ingested
    folder = scratch("publish")
    values = job.topic_values(spark, ingest.QUARANTINE)
    run(sinks.start_file_sink(values, f"{folder}/out", f"{folder}/cp", available_now=True))
    got = [json.loads(r.value) for r in spark.read.parquet(f"{folder}/out").collect()]
    assert len(got) == ingest.landed_table(spark, job.root, ingest.QUARANTINE).count()
    assert set(got[0]) == {"errorType", "reason", "sourceTopic", "replayTopic", "rawValue", "observedAt"}
    assert job.outputs()[ingest.ALERTS][0] == "alerts.fraud"


def test_corrections_to_batch_folders(spark, ingested):
    _, _, job = ingested
    folder = scratch("corrections")
    stream = windows.stream_aggregates(ingest.landed_stream(spark, job.root, 6), SPEC)
    write = sinks.write_batch_folder(f"{folder}/out")
    run(sinks.start_batch_sink(stream, write, f"{folder}/cp", windows.CORRECTIONS, available_now=True))
    out = spark.read.parquet(f"{folder}/out")
    last = out.groupBy("key", "windowStart").agg(F.max_by("eventCount", "batch_id").alias("eventCount"))
    want = aggregates.country_category_aggregates(ingest.landed_table(spark, job.root), SPEC)
    want = want.select("key", "windowStart", "eventCount")
    assert last.exceptAll(want).count() == 0 and want.exceptAll(last).count() == 0


def test_unknown_mode_is_refused(tmp_path):
    with pytest.raises(ValueError, match="mode"):
        RiskJob(str(tmp_path), mode="sometimes")


def test_batch_that_dies_while_writing_is_counted_once(spark, tmp_path):
    folder = f"{tmp_path}/landed/batch_id=0"
    rows = spark.range(0, 40, 1, 4)
    dying = rows.withColumn("id", F.when(F.col("id") < 30, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")))
    sinks.write_once(rows.limit(5), f"{tmp_path}/landed/batch_id=1")
    with pytest.raises(Exception, match="lost"):
        sinks.write_once(dying, folder)
    assert spark.read.parquet(f"{tmp_path}/landed").count() == 5  # nothing of the batch is seen

    # files of an attempt that died before its end, as a killed driver leaves them
    rows.write.mode("overwrite").parquet(f"{tmp_path}/landed/_unfinished/batch_id=0")
    assert spark.read.parquet(f"{tmp_path}/landed").count() == 5
    sinks.write_once(rows, folder)
    sinks.write_once(rows, folder)
    assert spark.read.parquet(f"{tmp_path}/landed").count() == 45

    stream = spark.readStream.schema("id long, batch_id int").parquet(f"{tmp_path}/landed")
    run(sinks.start_file_sink(stream, f"{tmp_path}/out", f"{tmp_path}/cp", available_now=True))
    assert spark.read.parquet(f"{tmp_path}/out").count() == 45


def test_ingest_restarted_after_a_lost_batch(spark):
    """The run dies with a part of its folders written; the batch is tried again."""
    rows, source = make_rows(5, count=60, per_batch=30, step=6_000), scratch("source")
    job = RiskJob(scratch("job"), SPEC)
    write_batches(spark, rows, source)
    kept = sinks.write_once

    def lost(frame, folder):
        if f"/{ingest.LANDED}/" in folder:
            raise OSError("lost")
        kept(frame, folder)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ingest, "write_once", lost)
        log = logs.file_stream(spark, source, files_per_batch=1)
        with pytest.raises(Exception, match="lost"):
            job.start_ingest(log, observed_at=77, available_now=True).awaitTermination(240)
    run(job.start_ingest(logs.file_stream(spark, source, files_per_batch=1), observed_at=77, available_now=True))
    late_ids = account(rows)[1]
    landed = ingest.landed_table(spark, job.root)
    assert sorted(r.eventId for r in landed.collect()) == sorted(r["eventId"] for r in rows if r["eventId"] not in late_ids)
    assert ingest.landed_table(spark, job.root, ingest.QUARANTINE).filter("errorType = 'PARSE_OR_VALIDATION_ERROR'").count() == 1


def test_job_in_corrections_mode(spark, ingested):
    _, _, job = ingested
    corrected = RiskJob(scratch("corrected"), SPEC, mode=CORRECTIONS)
    ingest.landed_table(spark, job.root).write.partitionBy("batch_id").parquet(f"{corrected.root}/{ingest.LANDED}")
    for query in corrected.start_windows(spark, available_now=True).values():
        run(query)
    landed = ingest.landed_table(spark, job.root)
    for name, want in (
        ("aggregates", aggregates.country_category_aggregates(landed, SPEC)),
        ("user_bursts", alerts.user_burst_alerts(landed, SPEC)),
    ):
        given = spark.read.parquet(f"{corrected.root}/{name}")
        value = "eventCount" if name == "aggregates" else "reason"
        last = given.groupBy("key", "windowStart").agg(F.max_by(value, "batch_id").alias(value))
        want = want.select(last.columns)
        assert want.count() > 0
        assert last.exceptAll(want).count() == 0 and want.exceptAll(last).count() == 0


def test_progress_of_ingest(spark, ingested):
    rows, source, job = ingested
    got = job.progress(spark).collect()
    whole = {r.batch_id: r for r in got if r.topic is None}
    parts = [r for r in got if r.topic is not None]
    assert sorted(whole) == list(range(12)) and all(r.partition is None and r.low is None for r in whole.values())
    assert {b: r.records for b, r in whole.items()} == {
        b: sum(r["batch_id"] == b for r in rows) + (b % 10 == 0) for b in range(12)
    }
    for name in ("records", "rejected", "late"):
        assert sum(r[name] for r in parts) == sum(r[name] for r in whole.values())
    assert sum(r.rejected for r in parts) == 2 and sum(r.late for r in parts) == len(account(rows)[1])
    highest = [max(r["eventTime"] for r in rows if r["batch_id"] <= b) for b in range(12)]
    assert [whole[b].highest for b in range(12)] == highest
    assert [whole[b].watermark for b in range(12)] == [None, *(h - SPEC.out_of_orderness_ms - 1 for h in highest[:-1])]
    # partitions as the topics number them
    assert {(r.topic, r.partition) for r in parts} == {("transactions.raw", r["partition"]) for r in rows} | {("transactions.replay", 9)}


def test_lag_follows_what_was_read(spark, ingested):
    rows, source, job = ingested
    log = logs.file_table(spark, source)
    done = {(r.topic, r.partition): r.lag for r in job.lag(log).filter("available = 1").collect()}
    assert set(done.values()) == {0}
    behind = RiskJob(scratch("behind"), SPEC)
    part = scratch("part")
    write_batches(spark, rows, part, range(4))
    run(behind.start_ingest(logs.file_stream(spark, part), observed_at=77, available_now=True))
    newest = {}
    for r in rows:
        at = newest.setdefault(r["partition"], [0, 0])
        at[0] = max(at[0], r["offset"] + 1)
        at[1] = max(at[1], r["offset"] + 1 if r["batch_id"] < 4 else 0)
    raw = behind.lag(log).filter("available = 1 AND topic = 'transactions.raw'").collect()
    assert {r.partition: r.lag for r in raw} == {p: high - read for p, (high, read) in newest.items()}


def test_progress_of_an_empty_batch(spark):
    job, source = RiskJob(scratch("job"), SPEC), scratch("source")
    rows = make_rows(5, count=30, per_batch=30, step=6_000)
    write_batches(spark, rows, source)
    spark.createDataFrame([("other.topic", 0, 99, None, None, bytearray(b"ignored"))], LOG).coalesce(1).write.mode("append").parquet(source)
    run(job.start_ingest(logs.file_stream(spark, source, files_per_batch=1), observed_at=77, available_now=True))
    whole = job.progress(spark).filter("topic IS NULL").orderBy("batch_id").collect()
    assert [r.records for r in whole] == [31, 0]
    assert whole[1].highest == whole[0].highest == max(r["eventTime"] for r in rows)
    assert (whole[1].rejected, whole[1].late) == (0, 0)


def test_progress_of_an_earlier_layout(spark):
    """A job whose first batch was landed with the highest event time alone goes on."""
    job, source = RiskJob(scratch("job"), SPEC), scratch("source")
    rows = make_rows(5, count=60, per_batch=30, step=6_000)
    write_batches(spark, rows, source, [0])
    run(job.start_ingest(logs.file_stream(spark, source), observed_at=77, available_now=True))
    folder = f"{job.root}/{ingest.PROGRESS}/batch_id=0"
    highest = max(r["eventTime"] for r in rows if r["batch_id"] == 0)
    spark.createDataFrame([(highest,)], "highest bigint").coalesce(1).write.mode("overwrite").parquet(folder)
    write_batches(spark, rows, source, [1])
    run(job.start_ingest(logs.file_stream(spark, source), observed_at=77, available_now=True))
    last = job.progress(spark).filter("topic IS NULL AND batch_id = 1").first()
    assert (last.watermark, last.highest) == (highest - SPEC.out_of_orderness_ms - 1, max(r["eventTime"] for r in rows))


def test_exact_mode_keeps_the_keys_of_a_bucket_in_one_state(spark):
    """Many keys of a window cost as many calls to the state as one, and each gives its own results."""
    calls, kept = [], {}

    class Handle:
        def getValueState(self, name, schema):
            return self

        def exists(self):
            calls.append("exists")
            return "value" in kept

        def get(self):
            calls.append("get")
            return kept.get("value")

        def update(self, value):
            calls.append("update")
            kept["value"] = value

        def clear(self):
            calls.append("clear")
            kept.clear()

        def registerTimer(self, at):
            calls.append("timer")

    def given(key, closed, offset):
        values = (key, closed, 0, 0, offset, f"e{offset}", 1, Decimal("1.5"), None, Decimal("0.5"), None, 0.5, None, None)
        return Row(bucket=7, windowStart=60_000, event_ts=None, packed=pickle.dumps(values))

    emitter = exact.WindowEmitter(30_000)
    emitter.init(Handle())
    first = [given(f"u{i}", False, i) for i in range(500)] + [given("u3", True, 1_000), given("u3", True, 900)]
    out = list(emitter.handleInputRows((7, 60_000), iter(first), None))
    assert [(r.key, r.kind, r.eventCount, r.offset, r.sampleEventId) for r in out] == [
        ("u3", "FIRE", 1, -1, "e3"), ("u3", "REFIRE", 2, 900, "e3"), ("u3", "REFIRE", 3, 1_000, "e3"),
    ]
    assert len(calls) <= 5

    expired = lambda at: SimpleNamespace(getExpiryTimeInMs=lambda: at)
    fired = list(emitter.handleExpiredTimer((7, 60_000), None, expired(30_000)))
    assert sorted(r.key for r in fired) == sorted({f"u{i}" for i in range(500)} - {"u3"}) and {r.kind for r in fired} == {"FIRE"}
    late_key = list(emitter.handleInputRows((7, 60_000), iter([given("u500", True, 1_001), given("u8", True, 1_002)]), None))
    assert [(r.key, r.kind, r.eventCount, r.amountExact) for r in late_key] == [
        ("u500", "REFIRE", 1, Decimal("1.5")), ("u8", "REFIRE", 2, Decimal("3.0")),
    ]
    assert list(emitter.handleExpiredTimer((7, 60_000), None, expired(60_000))) == [] and not kept
    assert len(calls) <= 12


def test_exact_mode_sums_rows_of_a_key_before_the_shuffle(spark):
    at = pd.Timestamp("2024-01-01")

    def row(key, offset, closed=False, amount="1.5"):
        plain = dict(bucket=1, key=key, windowStart=0, closed=closed, batch_id=0, partition=0, offset=offset, event_ts=at, eventId=f"e{offset}", eventCount=1)
        return dict(
            plain, amountExact=amount and Decimal(amount), amountOdd=None, scoreExact=Decimal("0.5"), scoreOdd=None,
            maxFraudScore=offset / 10, amountFar=None, scoreFar=None,
        )

    rows = [row("a", 5), row("b", 1), row("a", 2), row("a", 3, closed=True), row("a", 4, amount=None)]
    rows += [row(None, 6), row(None, 7), row(None, 8) | {"windowStart": None}, row("c", 9) | {"windowStart": None}]  # in no window
    frame = pd.DataFrame(rows).astype({"amountOdd": float, "scoreOdd": float, "amountFar": float, "scoreFar": float})
    got = [exact.Partial(*pickle.loads(p)) for part in exact._sum_open_rows(iter([frame])) for p in part["packed"]]
    assert sorted((p.key, p.closed, p.offset, p.eventCount, p.amountExact, p.maxFraudScore) for p in got if p.amountExact is not None) == [
        ("a", False, 2, 2, Decimal("3.0"), 0.5), ("a", True, 3, 1, Decimal("1.5"), 0.3), ("b", False, 1, 1, Decimal("1.5"), 0.1),
    ]
    assert [(p.offset, p.amountOdd, p.amountFar) for p in got if p.amountExact is None] == [(4, None, None)]


def test_exact_mode_with_more_keys_than_buckets(spark, monkeypatch):
    """Keys that share a bucket, over several micro-batches."""
    monkeypatch.setattr(exact, "KEY_BUCKETS", 2)
    exact.use_disk_state(spark)
    rows, source, folder = make_rows(3, count=120, per_batch=30, keys=12, step=6_000), scratch("source"), scratch("exact")
    write_batches(spark, rows, source)
    job = RiskJob(scratch("job"), SPEC)
    run(job.start_ingest(logs.file_stream(spark, source, files_per_batch=1), observed_at=77, available_now=True))
    results = exact.exact_emissions(ingest.landed_stream(spark, job.root, 1), F.col("userId"), SPEC)
    run(sinks.start_file_sink(results, f"{folder}/out", f"{folder}/checkpoint", available_now=True))
    assert rounded(stats_of(spark.read.parquet(f"{folder}/out"))) == rounded(account(rows)[0])


def test_small_batches_land_as_one_file(spark, ingested):
    """A stream that takes a number of landed files at a time takes whole batches, as the results of windows need."""
    _, _, job = ingested
    for batch in range(12):
        assert len(spark.read.parquet(f"{job.root}/{ingest.LANDED}/batch_id={batch}").inputFiles()) <= 1

"""Emissions in steps, with state in tables, against the row-by-row account and the batch operator."""

import pytest
from pyspark.sql import functions as F
from test_late import SPEC, account, emitted, frame, make_rows, rounded
from test_streaming import run, scratch, write_batches

from riskstream.config import RiskThresholds, WindowSpec
from riskstream.operators import alerts, carried, emissions, late
from riskstream.sources import logs
from riskstream.streaming import ingest
from riskstream.streaming.job import CARRIED, RiskJob



def stamped(spark, rows):
    return late.events_in_time(late.stamp_watermark(frame(spark, rows), SPEC), SPEC)


def results(spark, out):
    return rounded(emitted(spark.read.parquet(out)))


@pytest.mark.parametrize("stops", [[39], [0, 7, 8, 20, 39]])
def test_steps_equal_account(spark, tmp_path, stops):
    rows = make_rows(7)
    table = stamped(spark, rows).persist()
    for last in stops:
        carried.advance(table, last, f"{tmp_path}/state", f"{tmp_path}/out", F.col("userId"), SPEC)
    want = rounded(account(rows)[0])
    assert results(spark, f"{tmp_path}/out") == want
    again = carried.advance(table, stops[-1], f"{tmp_path}/state", f"{tmp_path}/out", F.col("userId"), SPEC)  # nothing is new
    assert again.last_batch == 39 and results(spark, f"{tmp_path}/out") == want
    kept = {r.step for r in spark.read.parquet(f"{tmp_path}/state/state").select("step").distinct().collect()}
    assert kept == set(stops[-2:])  # older states are gone


@pytest.mark.parametrize("lost", ["state/step=20", "out/step=20", "marks/step=20"])
def test_step_that_dies_is_done_again(spark, tmp_path, monkeypatch, lost):
    rows = make_rows(8)
    table, write = stamped(spark, rows).persist(), carried.write_once
    folders = f"{tmp_path}/state", f"{tmp_path}/out"
    carried.advance(table, 10, *folders, F.col("userId"), SPEC)

    def dies(df, folder):
        if folder.endswith(lost):
            raise OSError("lost")
        write(df, folder)

    with monkeypatch.context() as patch:
        patch.setattr(carried, "write_once", dies)
        with pytest.raises(OSError, match="lost"):
            carried.advance(table, 20, *folders, F.col("userId"), SPEC)
    assert carried.last_mark(spark, folders[0], SPEC).last_batch == 10
    for last in (20, 39):
        carried.advance(table, last, *folders, F.col("userId"), SPEC)
    assert results(spark, folders[1]) == rounded(account(rows)[0])


def test_far_amounts_from_a_later_step_on(spark, tmp_path):
    rows = make_rows(9)
    for row in rows[200::7]:
        row["amount"] = 1e16 * (1 + row["offset"] % 5) if row["offset"] % 2 else 2.0**900
    table = stamped(spark, rows).persist()
    for last in (5, 12, 25, 39):
        carried.advance(table, last, f"{tmp_path}/state", f"{tmp_path}/out", F.col("userId"), SPEC)
    assert emitted(spark.read.parquet(f"{tmp_path}/out")) == emitted(emissions.window_emissions(table, F.col("userId"), SPEC))


def test_no_rows_and_batches_without_rows(spark, tmp_path):
    rows = make_rows(10, count=60)
    table = stamped(spark, rows).persist()
    folders = f"{tmp_path}/state", f"{tmp_path}/out"
    assert carried.advance(table.limit(0), 0, *folders, F.col("userId"), SPEC) == carried.Mark(0, None, False)
    shifted = table.withColumn("batch_id", F.col("batch_id") + 1)
    for last in (2, 4, 5):
        carried.advance(shifted, last, *folders, F.col("userId"), SPEC)
    assert results(spark, folders[1]) == rounded(account(rows)[0])


def test_other_window_times_are_refused(spark, tmp_path):
    table = stamped(spark, make_rows(10, count=30))
    carried.advance(table, 0, f"{tmp_path}/state", f"{tmp_path}/out", F.col("userId"), SPEC)
    with pytest.raises(ValueError, match="other times"):
        carried.advance(table, 1, f"{tmp_path}/state", f"{tmp_path}/out", F.col("userId"), WindowSpec(size_ms=1000))


def test_many_later_rows_of_one_window(spark, tmp_path):
    """A million rows after the close of one window in one step: no task gets them all."""
    n, first = 1_000_000, 500
    later = spark.range(n).select(
        F.lit(1).cast("long").alias("batch_id"), F.lit(0).alias("partition"), "id", F.lit(100_000).cast("long").alias("watermark")
    )
    before = spark.range(first).select(
        F.lit(0).cast("long").alias("batch_id"), F.lit(0).alias("partition"), (F.col("id") - first).alias("id"), F.lit(None).cast("long").alias("watermark")
    )
    rows = before.union(later).select(
        "batch_id", "partition", (F.col("id") + first).alias("offset"), F.concat(F.lit("e"), "id").alias("eventId"),
        F.lit("hot").alias("userId"), F.lit(60_000).cast("long").alias("eventTime"), F.lit(0.25).alias("amount"),
        F.lit(0.5).alias("mlFraudScore"), "watermark",
    )
    spec = WindowSpec(size_ms=60_000, out_of_orderness_ms=0, allowed_lateness_ms=1_000_000)
    shut = rows.withColumn("watermark", F.when(F.col("watermark").isNotNull(), 130_000))
    for last in (0, 1):
        carried.advance(shut, last, f"{tmp_path}/state", f"{tmp_path}/out", F.col("userId"), spec)
    out = spark.read.parquet(f"{tmp_path}/out").filter("kind = 'REFIRE'")
    good = (F.col("eventCount") == F.col("offset") + 1) & (F.col("totalAmount") == F.col("eventCount") / 4) & (F.col("sampleEventId") == "e-500")
    assert out.agg(F.count(F.lit(1)), F.count_if(good)).first()[:] == (n, n)
    inside = spark.read.parquet(f"{tmp_path}/state/state/step=1").first()
    assert inside.eventCount == n + first


def test_job_goes_on_with_other_limits_and_partitions(spark):
    rows, source = make_rows(11, count=180, per_batch=15, step=6_000), scratch("source")
    job = RiskJob(scratch("carried"), SPEC, mode=CARRIED, files_per_batch=2)
    loose = RiskJob(job.root, SPEC, RiskThresholds(burst_count=2, burst_amount=1.0), mode=CARRIED, files_per_batch=3)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for risk, numbers, shuffles in ((job, range(5), 3), (loose, range(5, 12), 7)):
            write_batches(spark, rows, source, numbers)
            run(risk.start_ingest(logs.file_stream(spark, source, files_per_batch=1), observed_at=77, available_now=True))
            spark.conf.set("spark.sql.shuffle.partitions", shuffles)
            for query in risk.start_windows(spark, True, ("aggregates", "user_bursts")).values():
                run(query)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    landed = ingest.landed_table(spark, job.root)
    cause = ("kind", "batch_id", "partition", "offset")
    stats = emissions.window_emissions(landed, F.col("userId"), SPEC).persist()
    found = spark.read.parquet(f"{job.root}/user_bursts")
    for part, limits in ((found.filter("step < 5"), job.limits), (found.filter("step >= 5"), loose.limits)):
        want = alerts.burst_records(stats, *cause, limits=limits)
        assert part.select(want.columns).exceptAll(want).count() == 0
    # the totals are those of an unbroken run, so what the loose limits let through in the rest is all there
    rest = stats.join(found.filter("step >= 5").select("key", "windowStart", *cause), ["key", "windowStart", *cause], "left_semi")
    assert rest.count() == found.filter("step >= 5").count() > 0
    aggregates = spark.read.parquet(f"{job.root}/aggregates")
    assert aggregates.count() > 0 and aggregates.select("step").distinct().count() > 2

"""Registered queries: name → (spark, folder of tables) → DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.catalog import inputs as I
from riskstream.config import DAY, DEFAULT_TOPICS, MINUTE, REASON_MALFORMED, Topics
from riskstream.functions import expressions as E
from riskstream.operators import aggregates, alerts, changelog, contracts, emissions, enrich, evolution, late, parse, replay, snapshots, topics, versions
from riskstream.plans import pipeline
from riskstream.plans.lookup import ensure_checkpoint_dir
from riskstream.plans.sql import sql_aggregates
from riskstream.schemas import AGGREGATE, ALERT, DLQ, TRANSACTION_FIELDS
from riskstream.sources import logs, sinks
from riskstream.streaming import carried, exact, ingest, job, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _millis(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.unix_millis(name) for name in names})


# --- sources, parsing, expressions


@query
def transactions(spark, sf_dir):
    return I.transactions(spark, sf_dir).drop("event_ts")


@query
def parsed_transactions(spark, sf_dir):
    valid = parse.valid_transactions(parse.parse_transactions(I.raw_log(spark, sf_dir)))
    return valid.select("topic", "partition", "offset", *TRANSACTION_FIELDS)


@query
def rejected_records(spark, sf_dir):
    return parse.rejected_records(parse.parse_transactions(I.raw_log(spark, sf_dir)), I.OBSERVED_AT)


@query
def rejections_by_reason(spark, sf_dir):
    return topics.rejections_by_reason(rejected_records(spark, sf_dir))


@query
def parse_matrix(spark, sf_dir):
    """What the parser says to odd records; fields of malformed ones have no meaning."""
    parsed = parse.parse_transactions(I.damaged_log(spark, sf_dir))
    read = ~F.col("reason").eqNullSafe(REASON_MALFORMED)
    fields = ["eventId", "userId", "eventTime", "amount", "mlFraudScore", "ipRisk"]
    return parsed.select("offset", "reason", *[F.when(read, F.col(name)).alias(name) for name in fields])


@query
def lenient_matrix(spark, sf_dir):
    read = parse.read_transactions_leniently(I.damaged_log(spark, sf_dir))
    return read.select("offset", "eventId", "userId", "eventTime", "amount", "mlFraudScore", "country", "ipRisk")


@query
def lenient_transactions(spark, sf_dir):
    read = parse.read_transactions_leniently(I.raw_log(spark, sf_dir))
    return read.select("partition", "offset", *TRANSACTION_FIELDS)


@query
def group_keys(spark, sf_dir):
    return I.transactions(spark, sf_dir).select(
        "eventId",
        E.aggregate_key().alias("aggregateKey"),
        E.merchant_key().alias("merchantKey"),
        E.coalesced_key().alias("sqlKey"),
    )


# --- alerts


@query
def high_risk_alerts(spark, sf_dir):
    return alerts.high_risk_alerts(I.transactions(spark, sf_dir))


@query
def high_risk_alerts_from_raw(spark, sf_dir):
    valid = parse.valid_transactions(parse.parse_transactions(I.raw_log(spark, sf_dir)))
    return alerts.high_risk_alerts(valid)


@query
def user_window_stats(spark, sf_dir):
    return aggregates.window_stats(I.transactions(spark, sf_dir), F.col("userId"), DAY)


@query
def user_bursts_minute(spark, sf_dir):
    return alerts.user_burst_alerts(I.transactions(spark, sf_dir), MINUTE)


@query
def user_bursts_daily(spark, sf_dir):
    return alerts.user_burst_alerts(I.transactions(spark, sf_dir), DAY)


@query
def merchant_anomalies_minute(spark, sf_dir):
    return alerts.merchant_anomaly_alerts(I.transactions(spark, sf_dir), MINUTE)


@query
def merchant_anomalies_minute_low_limits(spark, sf_dir):
    return alerts.merchant_anomaly_alerts(I.transactions(spark, sf_dir), MINUTE, I.LOW_LIMITS)


@query
def merchant_anomalies_daily(spark, sf_dir):
    return alerts.merchant_anomaly_alerts(I.transactions(spark, sf_dir), DAY)


@query
def fraud_alerts_daily(spark, sf_dir):
    return alerts.fraud_alerts(I.transactions(spark, sf_dir), DAY)


@query
def alert_json(spark, sf_dir):
    return sinks.json_values(high_risk_alerts(spark, sf_dir).select(*ALERT.fieldNames()))


# --- aggregates


@query
def aggregates_minute(spark, sf_dir):
    return aggregates.country_category_aggregates(I.transactions(spark, sf_dir), MINUTE)


@query
def aggregates_daily(spark, sf_dir):
    return aggregates.country_category_aggregates(I.transactions(spark, sf_dir), DAY)


@query
def aggregate_json(spark, sf_dir):
    return sinks.json_values(aggregates_daily(spark, sf_dir).select(*AGGREGATE.fieldNames()))


@query
def sql_aggregates_minute(spark, sf_dir):
    read = parse.read_transactions_leniently(I.raw_log(spark, sf_dir))
    return _millis(sql_aggregates(read, MINUTE), "windowStart", "windowEnd")


@query
def sql_aggregates_daily(spark, sf_dir):
    return _millis(sql_aggregates(I.transactions(spark, sf_dir), DAY), "windowStart", "windowEnd")


@query
def sql_aggregate_json(spark, sf_dir):
    return sinks.json_values(sql_aggregates(I.transactions(spark, sf_dir), DAY))


# --- late events and repeated emissions


def _stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late.stamp_watermark(I.batched(spark, sf_dir), I.LATE_SPEC)


@query
def late_events(spark, sf_dir):
    rows = late.late_events(late.stamp_watermark(I.batched(spark, sf_dir), MINUTE), MINUTE)
    return rows.select("batch_id", "eventId", "eventTime", "watermark")


@query
def late_records(spark, sf_dir):
    return late.late_records(late.late_events(_stamped(spark, sf_dir), I.LATE_SPEC), I.OBSERVED_AT)


@query
def aggregates_in_time(spark, sf_dir):
    in_time = late.events_in_time(_stamped(spark, sf_dir), I.LATE_SPEC)
    return aggregates.country_category_aggregates(in_time, I.LATE_SPEC)


@query
def window_emissions(spark, sf_dir):
    return emissions.window_emissions(_stamped(spark, sf_dir), E.merchant_key(), I.LATE_SPEC)


@query
def aggregate_emissions(spark, sf_dir):
    stats = emissions.window_emissions(_stamped(spark, sf_dir), E.aggregate_key(), I.LATE_SPEC, first_event=False)
    return aggregates.aggregate_records(stats, "kind", "batch_id", "partition", "offset")


@query
def burst_emissions(spark, sf_dir):
    stats = emissions.window_emissions(_stamped(spark, sf_dir), F.col("userId"), I.LATE_SPEC)
    return alerts.burst_records(stats, "kind", "batch_id", "partition", "offset")


@query
def anomaly_emissions(spark, sf_dir):
    stats = emissions.window_emissions(_stamped(spark, sf_dir), E.merchant_key(), I.LATE_SPEC)
    return alerts.anomaly_records(stats, "kind", "batch_id", "partition", "offset")


# --- quarantine repair


def _repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.repair(I.quarantine_log(spark, sf_dir), I.OBSERVED_AT)


@query
def repair_status(spark, sf_dir):
    return _repair(spark, sf_dir).select("offset", "status", "problem")


@query
def repaired_transactions(spark, sf_dir):
    return replay.repaired(_repair(spark, sf_dir))


@query
def repaired_transactions_of_known_errors(spark, sf_dir):
    tagged = replay.repair(I.quarantine_log(spark, sf_dir), I.OBSERVED_AT, only_replayable=True)
    return replay.repaired(tagged).select("offset", "eventId")


@query
def unrecoverable_records(spark, sf_dir):
    return replay.unrecoverable(_repair(spark, sf_dir))


@query
def replay_records(spark, sf_dir):
    return replay.replay_records(replay.repaired(_repair(spark, sf_dir))).select("offset", "key", "value")


@query
def replay_first_records(spark, sf_dir):
    rows = replay.first_records(replay.repaired(_repair(spark, sf_dir)))
    return replay.replay_records(rows).select("offset", "key", "value")


@query
def replayed_again(spark, sf_dir):
    """What the parser says to the replayed records."""
    log = replay.replay_records(replay.repaired(_repair(spark, sf_dir)))
    parsed = parse.parse_transactions(log)
    return parsed.select("offset", "reason", "eventId", "userId", "amount", "eventTime", "ipRisk")


# --- reference data


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.read_changes(I.profile_change_log(spark, sf_dir))


def _profile_columns(df: DataFrame) -> DataFrame:
    return df.withColumn("risk_multiplier", F.col("risk_multiplier").cast("double")).withColumn(
        "updated_at", F.unix_millis("updated_at")
    )


@query
def merchant_profiles(spark, sf_dir):
    return _profile_columns(changelog.current_state(_changes(spark, sf_dir)))


@query
def merchant_profiles_after_upsert(spark, sf_dir):
    current = changelog.current_state(_changes(spark, sf_dir))
    now = F.timestamp_millis(F.lit(I.OBSERVED_AT))
    return _profile_columns(changelog.upsert(current, I.supplier_profiles(spark, sf_dir), now))


@query
def transactions_with_profiles(spark, sf_dir):
    profiles = changelog.current_state(_changes(spark, sf_dir))
    enriched = enrich.with_profiles(I.transactions(spark, sf_dir), profiles)
    return enriched.select("eventId", "merchantId", "risk_tier", "risk_multiplier", "manual_review_required")


@query
def profiled_high_risk_alerts(spark, sf_dir):
    profiles = changelog.current_state(_changes(spark, sf_dir))
    return enrich.profiled_high_risk_alerts(enrich.with_profiles(I.transactions(spark, sf_dir), profiles))


# --- topics and contracts


def _statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.topic_statistics(I.activity_log(spark, sf_dir), I.committed_offsets(spark, sf_dir))


@query
def topic_names(spark, sf_dir):
    return topics.topic_names(I.activity_log(spark, sf_dir))


@query
def topic_statistics(spark, sf_dir):
    return _statistics(spark, sf_dir)


@query
def topic_totals(spark, sf_dir):
    return topics.topic_totals(_statistics(spark, sf_dir))


@query
def headline_counts(spark, sf_dir):
    return topics.headline_counts(_statistics(spark, sf_dir))


@query
def topic_tail(spark, sf_dir):
    return topics.topic_tail(I.activity_log(spark, sf_dir), DEFAULT_TOPICS.raw)


@query
def topic_head(spark, sf_dir):
    return topics.topic_tail(I.activity_log(spark, sf_dir), DEFAULT_TOPICS.dlq, limit=200, from_beginning=True)


@query
def contract_nulls(spark, sf_dir):
    valid = parse.valid_transactions(parse.parse_transactions(I.raw_log(spark, sf_dir)))
    return contracts.null_report(contracts.assert_contract(valid, "transactions.raw-value"), "transactions.raw-value")


@query
def contract_nulls_of_odd_records(spark, sf_dir):
    read = parse.read_transactions_leniently(I.damaged_log(spark, sf_dir))
    return contracts.null_report(read, "transactions.raw-value")


@query
def evolved_transactions(spark, sf_dir):
    """Records of a later writer, without two fields that have defaults and with a new one, under the contract."""
    later = I.transactions(spark, sf_dir).drop("currency", "ipRisk", "event_ts", "partition", "offset")
    later = later.withColumn("terminal", F.concat(F.lit("t-"), "deviceId"))
    subject = "transactions.raw-value"
    problems = contracts.evolution_problems(later.schema, subject)
    if problems:
        raise contracts.ContractError("; ".join(problems))
    whole = contracts.apply_defaults(contracts.assert_contract(later, subject), subject)
    return whole.select(*TRANSACTION_FIELDS, "terminal", "schemaVersion")


@query
def transactions_of_versions(spark, sf_dir):
    """Records of three versions of a contract, read from its published files, under the second one."""
    folder = _scratch(spark)
    evolution.write_contracts(spark, I.contract_texts(), folder)
    found = evolution.read_contracts(spark, folder)
    return evolution.read_versions(I.versioned_log(spark, sf_dir), found, found[2])


# --- everything from one landed parse


@query
def fraud_alerts_of_landed_log(spark, sf_dir):
    return pipeline.analyze_log(I.raw_log(spark, sf_dir), _scratch(spark), DAY).alerts


@query
def fraud_alerts_of_renamed_topics(spark, sf_dir):
    """The same log under topics of other names."""
    named = Topics(raw="my.raw", replay="my.replay")
    log = I.raw_log(spark, sf_dir).withColumn("topic", F.lit(named.raw))
    return pipeline.analyze_log(log, _scratch(spark), DAY, topics=named).alerts


@query
def totals_of_far_amounts(spark, sf_dir):
    """Amounts from cents to 2**963 in one window: sums are exact and rounded once."""
    stats = aggregates.window_stats(I.far_transactions(spark, sf_dir), F.col("userId"), DAY)
    return stats.select("key", "windowStart", "eventCount", "totalAmount", "totalFraudScore")


@query
def alerts_of_far_amounts(spark, sf_dir):
    found = alerts.user_burst_alerts(I.far_transactions(spark, sf_dir), DAY)
    return found.select("alertId", "severity", "key", "windowStart", "metricValue", "sampleEventId")


@query
def sql_totals_of_far_amounts(spark, sf_dir):
    found = sql_aggregates(I.far_transactions(spark, sf_dir), DAY)
    return _millis(found, "windowStart").select("key", "windowStart", "eventCount", "totalAmount")


# --- profiles as of the event, and state folded in increments


@query
def transactions_with_profiles_as_of(spark, sf_dir):
    found = versions.with_profiles_as_of(I.transactions(spark, sf_dir), _changes(spark, sf_dir))
    return found.select("eventId", "risk_tier", "risk_multiplier", "manual_review_required")


@query
def merchant_profiles_in_increments(spark, sf_dir):
    """The log in three increments, each of which reads what the log has gained."""
    log, folder = I.profile_change_log(spark, sf_dir), _scratch(spark)
    last = log.agg(F.max("offset")).first()[0] or 0
    for third in (1, 2, 3):
        found = snapshots.advance(log.filter(F.col("offset") <= last * third // 3), folder)
    return _profile_columns(found.state())


# --- streams: run until the tables are read, then give the sink's table


def _run(results: DataFrame, folder: str | None = None) -> DataFrame:
    spark = results.sparkSession
    folder = folder or _scratch(spark)
    query = sinks.start_file_sink(results, f"{folder}/results", f"{folder}/checkpoint", available_now=True)
    query.awaitTermination()
    return spark.read.schema(results.schema).parquet(f"{folder}/results")


def _scratch(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4()}"


@query
def stream_aggregates(spark, sf_dir):
    return _run(windows.stream_aggregates(I.transaction_stream(spark, sf_dir)))


@query
def stream_user_bursts(spark, sf_dir):
    return _run(windows.stream_user_bursts(I.transaction_stream(spark, sf_dir), DAY))


@query
def stream_merchant_anomalies(spark, sf_dir):
    return _run(windows.stream_merchant_anomalies(I.transaction_stream(spark, sf_dir), DAY))


@query
def stream_sql_aggregates(spark, sf_dir):
    results = windows.stream_sql_aggregates(I.transaction_stream(spark, sf_dir))
    return _millis(_run(results), "windowStart", "windowEnd")


@query
def stream_high_risk_alerts(spark, sf_dir):
    return _run(alerts.high_risk_alerts(I.transaction_stream(spark, sf_dir)))


@query
def stream_profiled_high_risk_alerts(spark, sf_dir):
    profiles = changelog.current_state(_changes(spark, sf_dir))
    rows = enrich.with_profiles(I.transaction_stream(spark, sf_dir), profiles)
    return _run(enrich.profiled_high_risk_alerts(rows))


def _land_stamped(spark, sf_dir) -> str:
    folder = _scratch(spark)
    landed = late.events_in_time(_stamped(spark, sf_dir), I.LATE_SPEC).withColumn("topic", F.lit(DEFAULT_TOPICS.raw))
    landed.select(*ingest.LANDED_SCHEMA.fieldNames()).write.parquet(f"{folder}/{ingest.LANDED}")
    return folder


def _emissions_in_steps(spark, sf_dir, steps: int) -> DataFrame:
    """The emissions of landed rows, whose batches are announced in this many parts, one after the other."""
    folder = _land_stamped(spark, sf_dir)
    landed = ingest.landed_table(spark, folder)
    last = landed.agg(F.max("batch_id")).first()[0] or 0
    for part in range(1, steps + 1):
        spark.range(1).select(F.lit(last * part // steps).alias("batch_id")).coalesce(1).write.mode("append").parquet(f"{folder}/whole")
    batches = spark.readStream.schema("batch_id bigint").option("maxFilesPerTrigger", 1).parquet(f"{folder}/whole")
    read = lambda spark, first, last: landed.filter(F.col("batch_id").between(first, last))
    out = f"{folder}/results"
    query = carried.start_emissions(
        batches, read, f"{folder}/state", out, f"{folder}/checkpoint", E.merchant_key(), I.LATE_SPEC, available_now=True
    )
    query.awaitTermination()
    return spark.read.parquet(out).drop("step")


@query
def stream_emissions(spark, sf_dir):
    """The repeated results of windows, from a stream with state in tables."""
    return _emissions_in_steps(spark, sf_dir, 1)


@query
def stream_emissions_in_steps(spark, sf_dir):
    """The same, with the state carried over several steps."""
    return _emissions_in_steps(spark, sf_dir, 4)


@query
def stream_emissions_of_state_store(spark, sf_dir):
    """The same, with a state per key and window in Spark's state store."""
    exact.use_disk_state(spark)
    folder = _land_stamped(spark, sf_dir)
    rows = ingest.landed_stream(spark, folder)
    return _run(exact.exact_emissions(rows, E.merchant_key(), I.LATE_SPEC), folder)


# --- the whole job: raw records in, results of each mode out


def _finished(*running) -> None:
    for query in running:
        query.awaitTermination()


def _run_job(spark: SparkSession, sf_dir: str, mode: str, *results: str, folder: str | None = None, unread: int = 0) -> str:
    """The folder of a job that ran over the raw log, which arrives in batches, and
    gave the named results. In corrections mode the windows follow every batch, in
    the others they read all batches at the end. The last `unread` batches come after the run."""
    folder = folder or _scratch(spark)
    risk = job.RiskJob(f"{folder}/job", I.JOB_SPEC, mode=mode)
    arriving = I.arriving_log(spark, sf_dir)
    for batch in range(I.JOB_BATCHES):
        arrived = arriving.filter(F.col("batch_id") == batch).drop("batch_id")
        arrived.write.mode("append").parquet(f"{folder}/log")
        if batch >= I.JOB_BATCHES - unread:
            continue
        log = logs.file_stream(spark, f"{folder}/log")
        _finished(risk.start_ingest(log, I.OBSERVED_AT, available_now=True))
        if mode == job.CORRECTIONS:
            _finished(*risk.start_windows(spark, True, results).values())
    if mode != job.CORRECTIONS:
        _finished(*risk.start_windows(spark, True, results).values())
    return risk.root


@query
def stream_job_exact(spark, sf_dir):
    return spark.read.parquet(f"{_run_job(spark, sf_dir, job.EXACT, 'user_bursts')}/user_bursts")


@query
def stream_job_carried(spark, sf_dir):
    """A job that stops after its first batches, and goes on on a new checkpoint with other numbers of partitions."""
    folder = _scratch(spark)
    root = _run_job(spark, sf_dir, job.CARRIED, "user_bursts", folder=folder, unread=1)
    risk = job.RiskJob(root, I.JOB_SPEC, mode=job.CARRIED)
    log = logs.file_stream(spark, f"{folder}/log")
    _finished(risk.start_ingest(log, I.OBSERVED_AT, available_now=True))
    batches = carried.ingested_batches(spark, root)
    emitter = risk.emitters()["user_bursts"]
    rest = carried.start_emissions(
        batches, carried.landed_batches(root), f"{root}/state/user_bursts", f"{root}/user_bursts", f"{folder}/new-checkpoint",
        emitter[0], I.JOB_SPEC, emitter[1], available_now=True,
    )
    _finished(rest)
    return spark.read.parquet(f"{root}/user_bursts").drop("step")


@query
def stream_job_final(spark, sf_dir):
    return spark.read.parquet(f"{_run_job(spark, sf_dir, job.FINAL, 'aggregates')}/aggregates")


@query
def stream_job_corrections(spark, sf_dir):
    """The last value of every window, and how often it was given out."""
    given = spark.read.parquet(f"{_run_job(spark, sf_dir, job.CORRECTIONS, 'aggregates')}/aggregates")
    window = ["key", "windowStart"]
    values = [name for name in AGGREGATE.fieldNames() if name not in window]
    last = F.max_by(F.struct(*values), "batch_id").alias("last")
    return given.groupBy(*window).agg(last, F.count(F.lit(1)).alias("given")).select(*window, "last.*", "given")


@query
def stream_job_quarantine(spark, sf_dir):
    """What the job sets aside: records that cannot be read, and late ones."""
    root = _run_job(spark, sf_dir, job.FINAL)
    return ingest.landed_table(spark, root, ingest.QUARANTINE).select(*DLQ.fieldNames())


@query
def stream_job_progress(spark, sf_dir):
    """Offsets, records and watermark of every batch of the job."""
    return job.RiskJob(_run_job(spark, sf_dir, job.FINAL)).progress(spark)


@query
def stream_job_lag(spark, sf_dir):
    """What a job that stopped before the last batch has yet to read of each topic."""
    folder = _scratch(spark)
    risk = job.RiskJob(_run_job(spark, sf_dir, job.FINAL, folder=folder, unread=1))
    return risk.lag(logs.file_table(spark, f"{folder}/log"))

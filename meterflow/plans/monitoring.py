"""Monitoring reports built on the layers (documented needs beyond the core).

All of them aggregate first and then work on per-batch or per-day rows, whose
number grows with batches, not records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow import fixed
from meterflow.functions.metrics import count_when, rate
from meterflow.schemas import BATCH_KEYS, RECONCILIATION_COLUMNS

RATE_JUMP_LOOKBACK = 7  # batches of the same source before the current one
RATE_JUMP_MIN_INCREASE = 0.02  # absolute increase over the look-back mean that counts as a jump


def reconciliation_trend(recon: DataFrame, metadata: DataFrame) -> DataFrame:
    """Per arrival day: batches by status, counts and the day's reject rate."""
    day = metadata.select(*BATCH_KEYS, F.to_date("arrival_ts").alias("arrival_date"))
    joined = recon.join(day, on=BATCH_KEYS, how="inner")
    status = F.col("reconciliation_status")
    return (
        joined.groupBy("arrival_date")
        .agg(
            F.count(F.lit(1)).alias("batch_count"),
            count_when(status == fixed.RECONCILED).alias("reconciled_batches"),
            count_when(status == fixed.WARNING).alias("warning_batches"),
            count_when(status == fixed.FAILED).alias("failed_batches"),
            F.sum("expected_record_count").cast("bigint").alias("expected_record_count"),
            F.sum("bronze_record_count").alias("bronze_record_count"),
            F.sum("quarantine_count").alias("quarantine_count"),
            rate(F.sum("quarantine_count"), F.sum("bronze_record_count")).alias("reject_rate"),
        )
        .orderBy("arrival_date")
    )


def quality_scorecard(tagged: DataFrame) -> DataFrame:
    """Quality metrics per source and load day (day of ``ingestion_ts``)."""
    rejected = F.col("quality_status") == fixed.STATUS_REJECTED
    return (
        tagged.groupBy("source_system", F.to_date("ingestion_ts").alias("load_date"))
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            count_when(F.col("quality_status") == fixed.STATUS_VALID).alias("valid_records"),
            count_when(rejected).alias("quarantined_records"),
            rate(count_when(rejected), F.count(F.lit(1))).alias("reject_rate"),
            *[count_when(F.col("reject_reason") == r).alias(f"{r.lower()}_count") for r in fixed.RULE_REASONS],
        )
        .orderBy("source_system", "load_date")
    )


def reject_rate_jumps(
    recon: DataFrame,
    metadata: DataFrame,
    lookback: int = RATE_JUMP_LOOKBACK,
    min_increase: float = RATE_JUMP_MIN_INCREASE,
) -> DataFrame:
    """Each batch's reject rate against the mean of the source's previous batches.

    The window runs over the reconciliation table (one row per batch), ordered
    by arrival time. Rates are whole basis points (4 decimals), so the mean is
    taken and rounded half-up in integer arithmetic and does not depend on
    summation order; ``is_jump`` marks a rise of more than ``min_increase``.
    """
    arrival = metadata.select(*BATCH_KEYS, "arrival_ts")
    rows = recon.select(*BATCH_KEYS, "reject_rate").join(arrival, on=BATCH_KEYS, how="inner")
    w = Window.partitionBy("source_system").orderBy("arrival_ts", "batch_id").rowsBetween(-lookback, -1)
    bp = F.round(F.col("reject_rate") * 10000).cast("bigint")
    total, n = F.sum(bp).over(w), F.count(bp).over(w)
    prev_bp = F.when(n > 0, F.floor((total * 2 + n) / (n * 2)).cast("bigint"))
    return rows.select(
        "batch_id",
        "source_system",
        "arrival_ts",
        "reject_rate",
        (prev_bp / 10000.0).alias("previous_avg_reject_rate"),
        F.coalesce(bp - prev_bp > round(min_increase * 10000), F.lit(False)).alias("is_jump"),
    )


def missing_batches(metadata: DataFrame) -> DataFrame:
    """Scheduled daily batches that were never logged.

    Each source is expected once per day between its first and last logged
    day; the schedule (one row per source-day) left-anti joins the log.
    """
    logged = metadata.select("source_system", F.to_date("arrival_ts").alias("expected_date"))
    span = logged.groupBy("source_system").agg(F.min("expected_date").alias("d0"), F.max("expected_date").alias("d1"))
    schedule = span.select(
        "source_system", F.explode(F.sequence("d0", "d1", F.expr("INTERVAL 1 DAY"))).alias("expected_date")
    )
    return schedule.join(logged, on=["source_system", "expected_date"], how="left_anti").orderBy(
        "source_system", "expected_date"
    )


SEQUENCE_ORDER = ["event_ts", "source_system", "cdr_id"]  # total within a subscriber (clean keys are unique)


def sequence_overlaps(clean: DataFrame) -> DataFrame:
    """Events that start before some earlier event of the subscriber has ended.

    Listed with the earlier event that ends last. Events are grouped by subscriber and
    hour, a group that their own columns decide, so a subscriber with a third of all
    records spreads over its hours. Per group the event that ends last is one row; a
    running maximum over these rows (hours of a subscriber, not events) gives what is
    still open when an hour begins, and a window within the hour gives the rest.
    Records are exchanged once, and both uses read that exchange.
    """
    hour = F.date_trunc("hour", "event_ts")
    events = clean.select(
        "subscriber_msisdn",
        *SEQUENCE_ORDER,
        hour.alias("_hour"),
        F.struct(
            F.timestamp_add("SECOND", F.col("duration_sec"), F.col("event_ts")).alias("event_end"), *SEQUENCE_ORDER
        ).alias("_own"),
    )
    group = ["subscriber_msisdn", "_hour"]
    events = events.repartition(*group)  # the one exchange of records; both uses below read it
    earlier = Window.partitionBy("subscriber_msisdn").orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    carry = events.groupBy(*group).agg(F.max("_own").alias("_last")).select(*group, F.max("_last").over(earlier).alias("_carry"))
    before = Window.partitionBy(*group).orderBy(*SEQUENCE_ORDER).rowsBetween(Window.unboundedPreceding, -1)
    within = events.withColumn("_within", F.max("_own").over(before))
    latest = F.greatest("_within", "_carry")
    return (
        within.join(carry.where("_carry IS NOT NULL"), group, "left")
        .select(
            "subscriber_msisdn",
            "source_system",
            "cdr_id",
            "event_ts",
            latest["source_system"].alias("previous_source_system"),
            latest["cdr_id"].alias("previous_cdr_id"),
            latest["event_end"].alias("previous_end_ts"),
        )
        .where(F.col("event_ts") < F.col("previous_end_ts"))
    )


def late_batches(metadata: DataFrame, as_of, sources: list[str] = fixed.SOURCE_SYSTEMS, deadline_hours: int = 24) -> DataFrame:
    """Daily batches due by ``as_of`` that were never logged, with the hours they are late.

    Unlike ``missing_batches`` the schedule runs from the first logged day of any source up to the
    last day whose batch was due (midnight plus ``deadline_hours``), for every source of the list:
    the batch that is late now and a source that has gone silent are listed too.
    """
    logged = metadata.select("source_system", F.to_date("arrival_ts").alias("expected_date"))
    first = logged.agg(F.min("expected_date").alias("d0"))
    due = F.to_date(F.timestamp_add("HOUR", F.lit(-deadline_hours), F.lit(as_of).cast("timestamp")))
    days = first.where(F.col("d0") <= due).select(F.explode(F.sequence("d0", due)).alias("expected_date"))
    schedule = days.select(F.explode(F.array(*[F.lit(s) for s in sources])).alias("source_system"), "expected_date")
    missing = schedule.join(logged, ["source_system", "expected_date"], "left_anti")
    waited = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(F.col("expected_date").cast("timestamp"))
    return missing.withColumn("hours_late", (F.floor(waited / 3600) - deadline_hours).cast("bigint")).orderBy(
        "source_system", "expected_date"
    )


def latest_reconciliation(history: DataFrame, as_of=None) -> DataFrame:
    """Per batch the last run up to ``as_of`` (a timestamp; all runs if None): one aggregate, no window."""
    runs = history if as_of is None else history.where(F.col("reconciliation_ts") <= F.lit(as_of).cast("timestamp"))
    rest = [c for c in RECONCILIATION_COLUMNS if c not in BATCH_KEYS]
    last = F.max_by(F.struct(*rest), F.struct("reconciliation_ts", "run_id")).alias("_last")
    return runs.groupBy(*BATCH_KEYS).agg(last).select(*BATCH_KEYS, "_last.*").select(*RECONCILIATION_COLUMNS)


def status_changes(history: DataFrame) -> DataFrame:
    """Batches whose status differs from that of their run before, with both statuses and reject rates.

    The window is over the runs of one batch: as many rows as it was reconciled.
    """
    runs = Window.partitionBy(*BATCH_KEYS).orderBy("reconciliation_ts", "run_id")
    status, rate_now = F.col("reconciliation_status"), F.col("reject_rate")
    seen = history.withColumns(
        {"previous_status": F.lag(status).over(runs), "previous_reject_rate": F.lag(rate_now).over(runs)}
    )
    return seen.where(F.col("previous_status") != status).select(
        *BATCH_KEYS, "reconciliation_ts", "previous_status", "reconciliation_status", "previous_reject_rate", "reject_rate"
    )

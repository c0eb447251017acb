"""Operational reports over the layer tables.

Dashboard, data-quality and reconciliation-check statements, each a function
of the layer DataFrames. Sorted reports keep their order; top-k reports add a
tie-break so the chosen rows do not depend on partitioning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow import fixed
from meterflow.functions.metrics import count_when, money_sum, rate
from meterflow.operators import reconcile
from meterflow.plans.layerset import LayerSet
from meterflow.schemas import RECONCILIATION_COLUMNS


def _count(df: DataFrame, label_col: str, label: str, value_col: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(value_col)).select(F.lit(label).alias(label_col), value_col)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- layer and quality summaries -----------------------------------------


def _labelled(counts: DataFrame, label_col: str, value_col: str, labels: list[str]) -> DataFrame:
    """One row per column of a one-row table, under the labels given."""
    pairs = [F.struct(F.lit(label).alias(label_col), F.col(c).alias(value_col)) for label, c in zip(labels, counts.columns)]
    return counts.select(F.inline(F.array(*pairs)))


def _by_status(tagged: DataFrame) -> DataFrame:
    """Records, valid and rejected ones, counted in one pass over the tagged records."""
    return tagged.agg(
        F.count(F.lit(1)).alias("all"),
        count_when(F.col("quality_status") == fixed.STATUS_VALID).alias("valid"),
        count_when(F.col("quality_status") == fixed.STATUS_REJECTED).alias("rejected"),
    )


def _by_layer(tagged: DataFrame) -> DataFrame:
    """Rows of bronze, clean, quarantine, hourly and daily usage, counted in one pass over the tagged records.

    Usage has a row for each group of the clean records, so its rows are distinct groups.
    """
    valid = F.col("quality_status") == fixed.STATUS_VALID
    hour = F.struct("event_date", "event_hour", "source_system", "event_type")
    day = F.struct("event_date", "subscriber_msisdn")
    return tagged.agg(
        F.count(F.lit(1)).alias("bronze"),
        count_when(valid).alias("clean"),
        count_when(F.col("quality_status") == fixed.STATUS_REJECTED).alias("quarantine"),
        F.count_distinct(F.when(valid, hour)).alias("hourly"),
        F.count_distinct(F.when(valid, day)).alias("daily"),
    )


def layer_counts(ls: LayerSet) -> DataFrame:
    """Rows of each layer: of the written tables, or in one pass while all are still to be derived."""
    if ls.derived:
        return _labelled(_by_layer(ls.tagged), "metric", "value", fixed.LAYER_COUNT_LABELS)
    records, gold = fixed.LAYER_COUNT_LABELS[:3], zip([ls.hourly, ls.daily], fixed.LAYER_COUNT_LABELS[3:])
    counted = _labelled(_by_status(ls.tagged), "metric", "value", records)
    return _union([counted, *[_count(t, "metric", label, "value") for t, label in gold]])


def gold_layer_counts(ls: LayerSet) -> DataFrame:
    labels = fixed.GOLD_LAYER_COUNT_LABELS
    if ls.derived:
        return _labelled(_by_layer(ls.tagged).select("clean", "hourly", "daily"), "metric", "value", labels)
    tables = [ls.clean, ls.hourly, ls.daily]
    return _union([_count(t, "metric", label, "value") for t, label in zip(tables, labels)])


def valid_vs_quarantined(ls: LayerSet) -> DataFrame:
    labels = [fixed.RECORD_STATUS_VALID, fixed.RECORD_STATUS_QUARANTINED]
    return _labelled(_by_status(ls.tagged).drop("all"), "record_status", "record_count", labels)


def quality_by_source_tagged(tagged: DataFrame) -> DataFrame:
    """``quality_by_source`` while clean and quarantine are still one tagged set: one aggregate, no join."""
    rejected = F.col("quality_status") == fixed.STATUS_REJECTED
    counts = tagged.groupBy("source_system").agg(
        count_when(~rejected).alias("clean_count"),
        count_when(rejected).alias("quarantine_count"),
        F.count(F.lit(1)).alias("total_count"),
    )
    return counts.withColumn("quarantine_rate", rate("quarantine_count", "total_count")).orderBy(
        F.desc("quarantine_rate"), "source_system"
    )


def reject_reasons(quarantine: DataFrame) -> DataFrame:
    return (
        quarantine.groupBy("reject_reason")
        .agg(F.count(F.lit(1)).alias("rejected_record_count"))
        .orderBy(F.desc("rejected_record_count"), "reject_reason")
    )


def quality_status_reason_counts(tagged: DataFrame) -> DataFrame:
    return (
        tagged.groupBy("quality_status", "reject_reason")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("quality_status", "reject_reason")
    )


def source_status_counts(tagged: DataFrame) -> DataFrame:
    return (
        tagged.groupBy("source_system", "quality_status")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("source_system", "quality_status")
    )


def quality_by_source(clean: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Clean and quarantined counts per source (full outer join of two aggregates)."""
    c = clean.groupBy("source_system").agg(F.count(F.lit(1)).alias("clean_count")).alias("c")
    q = quarantine.groupBy("source_system").agg(F.count(F.lit(1)).alias("quarantine_count")).alias("q")
    joined = c.join(q, F.col("c.source_system") == F.col("q.source_system"), "full_outer")
    cc = F.coalesce(F.col("c.clean_count"), F.lit(0).cast("bigint"))
    qc = F.coalesce(F.col("q.quarantine_count"), F.lit(0).cast("bigint"))
    return joined.select(
        F.coalesce(F.col("c.source_system"), F.col("q.source_system")).alias("source_system"),
        cc.alias("clean_count"),
        qc.alias("quarantine_count"),
        (cc + qc).alias("total_count"),
        rate(qc, cc + qc).alias("quarantine_rate"),
    ).orderBy(F.desc("quarantine_rate"), "source_system")


def quarantine_sample(quarantine: DataFrame, n: int = fixed.QUARANTINE_SAMPLE_ROWS) -> DataFrame:
    """Latest quarantined records (top-k; ties broken by source, key and reason)."""
    return quarantine.orderBy(F.desc("reject_ts"), "source_system", "cdr_id", "reject_reason").limit(n)


def quality_metrics(tagged: DataFrame) -> DataFrame:
    """The quality metric set in one row: totals, reject rate and a count per reason."""
    rejected = F.col("quality_status") == fixed.STATUS_REJECTED
    return tagged.agg(
        F.count(F.lit(1)).alias("total_bronze_records"),
        count_when(F.col("quality_status") == fixed.STATUS_VALID).alias("valid_records"),
        count_when(rejected).alias("quarantined_records"),
        count_when(F.col("is_duplicate")).alias("duplicate_records"),
        rate(count_when(rejected), F.count(F.lit(1))).alias("reject_rate"),
        *[count_when(F.col("reject_reason") == r).alias(f"{r.lower()}_count") for r in fixed.RULE_REASONS],
    )


# --- usage reports over gold ---------------------------------------------


def event_type_distribution(hourly: DataFrame) -> DataFrame:
    return (
        hourly.groupBy("event_type")
        .agg(
            F.sum("total_events").alias("total_events"),
            money_sum("total_charge").alias("total_charge"),
            F.sum("total_duration_sec").alias("total_duration_sec"),
        )
        .orderBy(F.desc("total_events"), "event_type")
    )


def hourly_usage_trend(hourly: DataFrame) -> DataFrame:
    return (
        hourly.groupBy("usage_hour")
        .agg(
            F.sum("total_events").alias("total_events"),
            F.sum("total_duration_sec").alias("total_duration_sec"),
            money_sum("total_charge").alias("total_charge"),
        )
        .orderBy("usage_hour")
    )


def top_subscribers(daily: DataFrame, n: int = fixed.TOP_SUBSCRIBERS) -> DataFrame:
    return (
        daily.groupBy("subscriber_msisdn")
        .agg(
            F.sum("voice_call_count").alias("voice_call_count"),
            F.sum("sms_count").alias("sms_count"),
            F.sum("data_session_count").alias("data_session_count"),
            F.sum("roaming_event_count").alias("roaming_event_count"),
            F.sum("total_duration_sec").alias("total_duration_sec"),
            money_sum("total_charge").alias("total_charge"),
        )
        .orderBy(F.desc("total_charge"), "subscriber_msisdn")
        .limit(n)
    )


def top_subscriber_days(daily: DataFrame, n: int = fixed.TOP_SUBSCRIBER_DAYS) -> DataFrame:
    return daily.orderBy(F.desc("total_charge"), "subscriber_msisdn", "usage_date").limit(n)


def hourly_first_rows(hourly: DataFrame, n: int = fixed.HOURLY_PREVIEW_ROWS) -> DataFrame:
    return hourly.orderBy("usage_date", "usage_hour", "source_system", "event_type").limit(n)


def source_usage_summary(hourly: DataFrame) -> DataFrame:
    """Per source; ``unique_subscribers_sum`` adds hourly distinct counts (not a distinct count)."""
    return (
        hourly.groupBy("source_system")
        .agg(
            F.sum("total_events").alias("total_events"),
            F.sum("total_duration_sec").alias("total_duration_sec"),
            money_sum("total_charge").alias("total_charge"),
            F.sum("unique_subscribers").alias("unique_subscribers_sum"),
            F.sum("roaming_events").alias("roaming_events"),
        )
        .orderBy(F.desc("total_events"), "source_system")
    )


def source_unique_subscribers(clean: DataFrame) -> DataFrame:
    """Exact distinct subscribers per source, from clean records."""
    return clean.groupBy("source_system").agg(F.count_distinct("subscriber_msisdn").alias("unique_subscribers"))


def daily_usage_summary(hourly: DataFrame) -> DataFrame:
    return (
        hourly.groupBy("usage_date")
        .agg(
            F.sum("total_events").alias("total_events"),
            F.sum("total_duration_sec").alias("total_duration_sec"),
            money_sum("total_charge").alias("total_charge"),
            F.sum("roaming_events").alias("roaming_events"),
        )
        .orderBy("usage_date")
    )


# --- reconciliation reports ----------------------------------------------


def recon_by_batch(recon: DataFrame) -> DataFrame:
    return recon.select(*RECONCILIATION_COLUMNS[:-1]).orderBy("source_system", "batch_id")


def recon_status_summary(recon: DataFrame) -> DataFrame:
    return reconcile.status_summary(recon).orderBy("reconciliation_status")


def reject_rate_by_source(recon: DataFrame, with_duplicates: bool = False) -> DataFrame:
    sums = [
        F.sum("bronze_record_count").alias("bronze_record_count"),
        F.sum("silver_valid_count").alias("silver_valid_count"),
        F.sum("quarantine_count").alias("quarantine_count"),
    ]
    if with_duplicates:
        sums.append(F.sum("duplicate_count").alias("duplicate_count"))
    return (
        recon.groupBy("source_system")
        .agg(*sums, rate(F.sum("quarantine_count"), F.sum("bronze_record_count")).alias("reject_rate"))
        .orderBy(F.desc("reject_rate"), "source_system")
    )


def recon_exceptions(recon: DataFrame) -> DataFrame:
    return reconcile.exceptions(recon).orderBy("reconciliation_status", "source_system", "batch_id")

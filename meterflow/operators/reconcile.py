"""Batch reconciliation: expected -> bronze -> clean + quarantine, per batch.

Each side is aggregated to one row per batch before any join, so the three
left joins are one-to-one and tiny next to the record tables; AQE picks
broadcast or sort-merge from their measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow import fixed
from meterflow.functions.metrics import count_when, rate
from meterflow.functions.parsing import wall_clock
from meterflow.schemas import BATCH_KEYS, RECONCILIATION_COLUMNS


def bronze_counts(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy(*BATCH_KEYS).agg(F.count(F.lit(1)).alias("bronze_record_count"))


def silver_counts(clean: DataFrame) -> DataFrame:
    return clean.groupBy(*BATCH_KEYS).agg(F.count(F.lit(1)).alias("silver_valid_count"))


def quarantine_counts(quarantine: DataFrame) -> DataFrame:
    """Rejected rows per batch and, of those, rows whose reason is the duplicate rule."""
    return quarantine.groupBy(*BATCH_KEYS).agg(
        F.count(F.lit(1)).alias("quarantine_count"),
        count_when(F.col("reject_reason") == fixed.DUPLICATE_REASON).alias("duplicate_count"),
    )


def reconcile(
    metadata: DataFrame,
    bronze: DataFrame,
    clean: DataFrame,
    quarantine: DataFrame,
    as_of=None,
    threshold: float = fixed.REJECT_RATE_WARNING_THRESHOLD,
) -> DataFrame:
    """One row per logged batch with counts, reject rate and status.

    Batches that landed but were never logged do not appear (see
    ``unregistered_batches``). A logged batch with no records has a NULL rate.
    """
    counts = (
        metadata.select(*BATCH_KEYS, "expected_record_count")
        .join(bronze_counts(bronze), on=BATCH_KEYS, how="left")
        .join(silver_counts(clean), on=BATCH_KEYS, how="left")
        .join(quarantine_counts(quarantine), on=BATCH_KEYS, how="left")
    )
    return _finish(counts, as_of, threshold)


def reconcile_tagged(
    metadata: DataFrame, tagged: DataFrame, as_of=None, threshold: float = fixed.REJECT_RATE_WARNING_THRESHOLD
) -> DataFrame:
    """``reconcile`` when clean and quarantine are still the two halves of one tagged set.

    The four counts per batch come from one aggregate over the tagged records
    (one pass instead of three); the result equals ``reconcile`` over the split.
    """
    rejected = F.col("quality_status") == fixed.STATUS_REJECTED
    counts = tagged.groupBy(*BATCH_KEYS).agg(
        F.count(F.lit(1)).alias("bronze_record_count"),
        count_when(F.col("quality_status") == fixed.STATUS_VALID).alias("silver_valid_count"),
        count_when(rejected).alias("quarantine_count"),
        count_when(rejected & (F.col("reject_reason") == fixed.DUPLICATE_REASON)).alias("duplicate_count"),
    )
    joined = metadata.select(*BATCH_KEYS, "expected_record_count").join(counts, on=BATCH_KEYS, how="left")
    return _finish(joined, as_of, threshold)


def _finish(joined: DataFrame, as_of, threshold: float) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    counts = joined.select(
        *BATCH_KEYS,
        "expected_record_count",
        *[
            F.coalesce(F.col(c), zero).alias(c)
            for c in ["bronze_record_count", "silver_valid_count", "quarantine_count", "duplicate_count"]
        ],
    )
    rated = counts.withColumn("reject_rate", rate("quarantine_count", "bronze_record_count"))
    return (
        with_status(rated, threshold).withColumn("reconciliation_ts", wall_clock(as_of)).select(*RECONCILIATION_COLUMNS)
    )


def with_status(counts: DataFrame, threshold: float = fixed.REJECT_RATE_WARNING_THRESHOLD) -> DataFrame:
    """FAILED on any count mismatch; else WARNING above the threshold; else RECONCILED.

    A batch whose sender announced no count can't be reconciled and is FAILED too. The
    threshold is compared with the rounded rate, strictly.
    """
    mismatch = ~F.col("expected_record_count").eqNullSafe(F.col("bronze_record_count")) | (
        F.col("bronze_record_count") != F.col("silver_valid_count") + F.col("quarantine_count")
    )
    status = (
        F.when(mismatch, F.lit(fixed.FAILED))
        .when(F.col("reject_rate") > threshold, F.lit(fixed.WARNING))
        .otherwise(F.lit(fixed.RECONCILED))
    )
    return counts.withColumn("reconciliation_status", status)


def count_match_check(recon: DataFrame) -> DataFrame:
    """Boolean form of the layer balance per batch."""
    plus = F.col("silver_valid_count") + F.col("quarantine_count")
    return recon.select(
        "batch_id",
        "source_system",
        "expected_record_count",
        "bronze_record_count",
        "silver_valid_count",
        "quarantine_count",
        plus.alias("silver_plus_quarantine"),
        (F.col("bronze_record_count") == plus).alias("is_count_matched"),
        "reject_rate",
        "reconciliation_status",
    )


def count_match_labels(recon: DataFrame) -> DataFrame:
    """Label form of the layer balance per batch."""
    plus = F.col("silver_valid_count") + F.col("quarantine_count")
    return recon.select(
        "batch_id",
        "source_system",
        "expected_record_count",
        "bronze_record_count",
        "silver_valid_count",
        "quarantine_count",
        plus.alias("silver_plus_quarantine"),
        F.when(F.col("bronze_record_count") == plus, F.lit(fixed.COUNT_MATCHED))
        .otherwise(F.lit(fixed.COUNT_NOT_MATCHED))
        .alias("bronze_vs_silver_quarantine_check"),
        "reconciliation_status",
    )


def exceptions(recon: DataFrame) -> DataFrame:
    """Batches needing attention: FAILED or WARNING."""
    return recon.where(F.col("reconciliation_status").isin(fixed.FAILED, fixed.WARNING))


def status_summary(recon: DataFrame) -> DataFrame:
    return recon.groupBy("reconciliation_status").agg(
        F.count(F.lit(1)).alias("batch_count"), F.round(F.avg("reject_rate"), fixed.REJECT_RATE_SCALE).alias("avg_reject_rate")
    )


def unregistered_batches(metadata: DataFrame, bronze: DataFrame) -> DataFrame:
    """Batches that landed in bronze but are missing from the ingestion log (left anti join)."""
    return bronze_counts(bronze).join(metadata.select(*BATCH_KEYS), on=BATCH_KEYS, how="left_anti")


def layer_balance(bronze: DataFrame, clean: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Global check: bronze rows = clean rows + quarantined rows (one row, three counts).

    The three tables are tagged and unioned, then counted in one global
    aggregate (partial per task), instead of joining three scalar results.
    """
    layers = (
        bronze.select(F.lit(0).alias("_layer"))
        .unionByName(clean.select(F.lit(1).alias("_layer")))
        .unionByName(quarantine.select(F.lit(2).alias("_layer")))
    )
    counts = layers.agg(
        count_when(F.col("_layer") == 0).alias("bronze_count"),
        count_when(F.col("_layer") == 1).alias("silver_clean_count"),
        count_when(F.col("_layer") == 2).alias("silver_quarantine_count"),
    )
    return counts.withColumn(
        "is_balanced", F.col("bronze_count") == F.col("silver_clean_count") + F.col("silver_quarantine_count")
    )


def layer_balance_tagged(bronze: DataFrame, tagged: DataFrame) -> DataFrame:
    """``layer_balance`` while clean and quarantine are still the halves of one tagged set: it is tagged once.

    Bronze is counted on its own, so a record lost or multiplied by the tagging shows.
    """
    layers = bronze.select(F.lit(None).cast("string").alias("quality_status"), F.lit(True).alias("_bronze")).unionByName(
        tagged.select("quality_status", F.lit(False).alias("_bronze"))
    )
    counts = layers.agg(
        count_when(F.col("_bronze")).alias("bronze_count"),
        count_when(F.col("quality_status") == fixed.STATUS_VALID).alias("silver_clean_count"),
        count_when(F.col("quality_status") == fixed.STATUS_REJECTED).alias("silver_quarantine_count"),
    )
    return counts.withColumn(
        "is_balanced", F.col("bronze_count") == F.col("silver_clean_count") + F.col("silver_quarantine_count")
    )

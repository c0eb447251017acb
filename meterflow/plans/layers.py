"""Build and write the layer tables; replay batches idempotently.

Order: ingestion log and bronze are written first, so ``ingest_seq`` is fixed
before anything ranks on it; the tagging result is written once
(``silver_cdr_tagged``, per quality status), which cuts the lineage on shared
storage: clean and quarantine are then narrow reads of one partition each,
and a lost executor never sends the job back to the duplicate ranking. Gold
reads the written clean table; reconciliation reads the four written tables,
so it checks what actually landed on storage.

The log is merged per batch: a replay touches the rows of its own batches, and an
announced count, once known, is kept until another announcement replaces it. A
count is never made up from what landed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.operators import quality, reconcile, usage
from meterflow.schemas import BATCH_KEYS, TABLE_SCHEMAS
from meterflow.sources.landing import ingestion_log, read_lines, split_malformed
from meterflow.sources.tables import (
    exists,
    files_of,
    landed,
    merge_layer,
    read_files,
    read_layer,
    read_side,
    replace_partitions,
    write_layer,
)

# What a merge keeps of a logged batch when the new row doesn't know it.
ANNOUNCED = ["arrival_ts", "expected_record_count"]


def write_landing(bronze: DataFrame, metadata: DataFrame, root: str, replay: bool = False) -> None:
    """Write bronze (per batch) and the ingestion log.

    ``replay=True`` replaces only the batches present in ``bronze`` and merges
    the log rows of ``metadata`` into the stored log.
    """
    write_layer(bronze, root, "bronze_cdr_raw", dynamic=replay, rebalance=False)
    if replay:
        merge_layer(metadata, root, "metadata_ingestion_log", BATCH_KEYS, ANNOUNCED)
    else:
        write_layer(metadata, root, "metadata_ingestion_log")


def build_downstream(spark: SparkSession, root: str, as_of=None, rules=None) -> None:
    """Silver, gold and reconciliation from the written bronze and log.

    Duplicate ranking and gold span batches, so these layers are rebuilt whole (a replay that
    touches only what its batches change is ``plans.replay``). Full records move twice, to
    bring a batch together in the tagged table and a day in the clean table.
    """
    bronze = read_layer(spark, root, "bronze_cdr_raw")
    tagged = quality.tag_quality(bronze, rules=rules, as_of=as_of)
    if exists(spark, root, "bronze_cdr_malformed"):
        malformed = quality.tag_malformed(read_side(spark, root, "bronze_cdr_malformed"), as_of)
        tagged = tagged.unionByName(malformed.select(*tagged.columns))
    write_layer(tagged, root, "silver_cdr_tagged")
    tagged = read_layer(spark, root, "silver_cdr_tagged")
    write_layer(quality.clean_records(tagged), root, "silver_cdr_clean")
    write_layer(quality.quarantine_records(tagged, as_of), root, "silver_cdr_quarantine")
    build_gold(spark, root, as_of=as_of)


def build_gold(spark: SparkSession, root: str, as_of=None) -> None:
    """Gold usage and reconciliation from whatever silver tables are under ``root``."""
    clean = read_layer(spark, root, "silver_cdr_clean")
    write_layer(usage.usage_hourly(clean), root, "gold_cdr_usage_hourly")
    write_layer(usage.subscriber_daily(clean), root, "gold_subscriber_usage_daily")
    reconcile_layers(spark, root, as_of=as_of)


def reconcile_layers(spark: SparkSession, root: str, as_of=None) -> None:
    """Reconcile every logged batch from the written log, bronze, clean and
    quarantine tables, and rewrite the reconciliation table. Re-run it after any
    change to a layer: it checks what is on storage. The run joins the history."""
    recon = reconcile.reconcile(
        read_layer(spark, root, "metadata_ingestion_log"),
        landed(spark, root),
        read_layer(spark, root, "silver_cdr_clean"),
        read_layer(spark, root, "silver_cdr_quarantine"),
        as_of=as_of,
    )
    write_layer(recon, root, "gold_reconciliation_daily")
    add_run(read_layer(spark, root, "gold_reconciliation_daily"), root)


def add_run(recon: DataFrame, root: str, run_id: str | None = None) -> str:
    """Add reconciled batches to the history as a run of their own; a run that is repeated by its id replaces itself."""
    run_id = run_id or uuid.uuid4().hex
    write_layer(recon.withColumn("run_id", F.lit(run_id)), root, "reconciliation_history", dynamic=True, rebalance=False)
    return run_id


def write_layers(bronze: DataFrame, metadata: DataFrame, root: str, as_of=None, rules=None, replay=False) -> None:
    """The whole pipeline: landing, then every downstream layer."""
    write_landing(bronze, metadata, root, replay=replay)
    build_downstream(bronze.sparkSession, root, as_of=as_of, rules=rules)


def log_landed(
    bronze: DataFrame, root: str, control: DataFrame | None = None, as_of=None, merge: bool = True
) -> None:
    """Log the batches of ``bronze`` and of ``control``; ``merge`` leaves those logged before.

    A landed batch that nobody announced is logged with a NULL expected count, unless
    the log already has one; its arrival is then its first ingestion.
    """
    landed = bronze.groupBy(*BATCH_KEYS).agg(F.min("ingestion_ts").alias("_first"))
    if control is None:
        control = landed.select(*BATCH_KEYS).limit(0).withColumns(
            {"arrival_ts": F.lit(None).cast("timestamp"), "expected_record_count": F.lit(None).cast("int")}
        )
    announced = control.alias("c").join(landed.alias("l"), BATCH_KEYS, "full")
    announced = announced.withColumn("arrival_ts", F.coalesce("arrival_ts", "_first")).drop("_first")
    log = ingestion_log(announced, bronze, created_ts=as_of)
    if merge:
        merge_layer(log, root, "metadata_ingestion_log", BATCH_KEYS, ANNOUNCED)
    else:
        write_layer(log, root, "metadata_ingestion_log")


def build_from_landing(
    spark: SparkSession, landing: str, root: str, dated: bool = False, replay: bool = False, control: DataFrame | None = None
) -> None:
    """Raw files -> every layer. ``control`` is the senders' announcement per batch
    (``sources.landing.read_control``); a batch without one has no expected count and
    reconciles as FAILED. ``replay`` replaces the batches present in the files."""
    staged = f"{root.rstrip('/')}/_staging/lines-{uuid.uuid4().hex}"
    read_lines(spark, landing, dated=dated).write.parquet(staged)
    records, malformed = split_malformed(spark.read.parquet(staged))
    malformed = malformed.select(*TABLE_SCHEMAS["bronze_cdr_malformed"].fieldNames())
    stale = []
    if replay and exists(spark, root, "bronze_cdr_malformed"):  # a batch that has no malformed line now
        again = [r.batch_id for r in records.select("batch_id").distinct().collect()]
        stale = files_of(read_files(spark, root, "bronze_cdr_malformed").where(F.col("batch_id").isin(again)))
    write_layer(records, root, "bronze_cdr_raw", dynamic=replay, rebalance=False)
    if replay:
        replace_partitions(malformed, root, "bronze_cdr_malformed", stale, rebalance=False)
    else:
        write_layer(malformed, root, "bronze_cdr_malformed", rebalance=False)
    log_landed(landed(spark, root), root, control, merge=replay)
    build_downstream(spark, root)

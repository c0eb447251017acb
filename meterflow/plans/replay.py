"""Replay of batches that touches only what they change.

A redelivered batch can change more than its own partition: a record key that it no
longer has, or now has, decides which copies in other batches are duplicates; those
change their days' clean records, and these the usage of those days. What is affected
is derived step by step, and only that is read and rewritten:

1. keys of the batch, as it was and as it is now;
2. batches that hold one of these keys: the Bloom filters of all batches name the
   candidates (``operators.keyfilter``), the key columns of the candidates decide;
3. the records of the batch and all records with those keys are tagged again;
4. tagged and quarantined records of these batches, clean records and usage of the days
   that their records lie on, the log and the reconciliation of these batches.

Bronze is overwritten last but for the filters. A replay that failed on its way can be
run again: all that it derives comes from the stored bronze and the new delivery, and
each write replaces whole partitions.

The names of batches and the days that are affected pass the driver, as literals that
prune partitions; keys and records don't.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions.parsing import parse_event_ts, wall_clock
from meterflow.operators import keyfilter, quality, reconcile, usage
from meterflow.operators.dedup import DEFAULT_KEY
from meterflow.plans.layers import ANNOUNCED, add_run
from meterflow.schemas import BATCH_KEYS
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

KEY = list(DEFAULT_KEY)
FILTERS = "bronze_key_filters"


def write_key_filters(bronze: DataFrame, root: str, dynamic: bool = False) -> None:
    """Bloom filters of the record keys of each batch; ``dynamic`` leaves those of other batches."""
    write_layer(keyfilter.build(bronze.select(*KEY, "batch_id"), KEY, ["batch_id"]), root, FILTERS, dynamic, rebalance=False)


def _among(column: str, values: list):
    """Membership with NULL as a value."""
    known = [v for v in values if v is not None]
    return F.coalesce(F.col(column).isin(known), F.lit(False)) | (F.col(column).isNull() if None in values else F.lit(False))


def _values(rows: DataFrame, column: str) -> list:
    return [r[0] for r in rows.select(column).distinct().collect()]


def _with_keys(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on the record key; NULL parts are equal."""
    other = keys.select(*[F.col(k).alias(f"_k_{k}") for k in KEY])
    return rows.join(other, reduce(lambda a, b: a & b, [rows[k].eqNullSafe(other[f"_k_{k}"]) for k in KEY]), how)


class _Stage:
    """Intermediate tables beside the layers, in the shared folder of ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/_staging/replay-{uuid.uuid4().hex}"

    def __call__(self, rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.path}/{name}")


def replay_batches(
    fresh: DataFrame, log: DataFrame, root: str, as_of=None, rules: list | None = None, run_ts=None
) -> dict[str, list]:
    """Put the batches of ``fresh`` (bronze rows) in the place of what ``root`` has of them.

    Of ``log``, the rows of these batches and of batches not logged so far (announced, with or
    without records) are merged into the ingestion log. ``run_ts`` is the time of this run in the
    history of reconciliations, ``as_of`` by default. Returns the affected batches and days.
    """
    spark = fresh.sparkSession
    stage = _Stage(spark, root)
    fresh, log = stage(fresh, "fresh"), stage(log, "log")
    stored = read_layer(spark, root, "bronze_cdr_raw")
    own = _values(fresh, "batch_id")
    if not exists(spark, root, FILTERS):
        write_key_filters(stored, root)
    filters = read_layer(spark, root, FILTERS)

    keys = stored.where(_among("batch_id", own)).select(*KEY).union(fresh.select(*KEY)).distinct()
    keys = stage(keys, "keys")
    asked = keyfilter.may_contain(keys, KEY, filters.where(~_among("batch_id", own)), ["batch_id"])
    candidates = _values(asked, "batch_id")
    others = stage(_with_keys(stored.where(_among("batch_id", candidates)), keys, "left_semi"), "others")
    batches = own + _values(others, "batch_id")

    tagged = stage(quality.tag_quality(fresh.unionByName(others), rules=rules, as_of=as_of), "tagged")
    moved = stored.where(_among("batch_id", own)).unionByName(others).unionByName(fresh)
    days = _values(moved.select(F.to_date(parse_event_ts("start_time_raw")).alias("day")), "day")

    _replace_tagged(spark, root, stage, tagged, keys, own, batches, as_of)
    _replace_usage(spark, root, stage, tagged, keys, days)
    logged = read_layer(spark, root, "metadata_ingestion_log")
    news = _values(log.join(logged, BATCH_KEYS, "left_anti"), "batch_id")
    _replace_log(spark, root, fresh, log.where(_among("batch_id", [*own, *news])), own, [*batches, *news], as_of, run_ts)
    write_key_filters(read_layer(spark, root, "bronze_cdr_raw").where(_among("batch_id", own)), root, dynamic=True)
    return {"batches": sorted(batches, key=str), "days": sorted(d for d in days if d is not None)}


def _replace_tagged(spark, root: str, stage: _Stage, tagged: DataFrame, keys: DataFrame, own, batches, as_of) -> None:
    """Tagged and quarantined records of the affected batches."""
    was = read_layer(spark, root, "silver_cdr_tagged").where(_among("batch_id", batches))
    kept = _with_keys(was.where(~_among("batch_id", own)), keys, "left_anti")
    lines = quality.tag_malformed(read_side(spark, root, "bronze_cdr_malformed").where(_among("batch_id", own)), as_of)
    now = kept.unionByName(tagged.select(*kept.columns)).unionByName(lines.select(*kept.columns))
    now = stage(now, "tagged-batches")
    for table, rows in [("silver_cdr_tagged", now), ("silver_cdr_quarantine", quality.quarantine_records(now, as_of))]:
        before = files_of(read_files(spark, root, table).where(_among("batch_id", batches)))
        replace_partitions(rows, root, table, before, rebalance=table != "silver_cdr_tagged")


def _replace_usage(spark, root: str, stage: _Stage, tagged: DataFrame, keys: DataFrame, days) -> None:
    """Clean records and usage of the affected days."""
    was = read_layer(spark, root, "silver_cdr_clean").where(_among("event_date", days))
    kept = _with_keys(was, keys, "left_anti")
    now = stage(kept.unionByName(quality.clean_records(tagged).select(*kept.columns)), "clean-days")
    before = files_of(read_files(spark, root, "silver_cdr_clean").where(_among("event_date", days)))
    replace_partitions(now, root, "silver_cdr_clean", before)
    for table, rows in [
        ("gold_cdr_usage_hourly", usage.usage_hourly(now)),
        ("gold_subscriber_usage_daily", usage.subscriber_daily(now)),
    ]:
        before = files_of(read_files(spark, root, table).where(_among("usage_date", days)))
        replace_partitions(rows, root, table, before)


def _replace_log(spark, root: str, fresh: DataFrame, log: DataFrame, own, batches, as_of, run_ts) -> None:
    """Log and bronze of the replayed batches, reconciliation of the affected ones."""
    merge_layer(log, root, "metadata_ingestion_log", BATCH_KEYS, ANNOUNCED)
    before = files_of(read_files(spark, root, "bronze_cdr_raw").where(_among("batch_id", own)))
    replace_partitions(fresh, root, "bronze_cdr_raw", before, rebalance=False)
    of = lambda table: read_layer(spark, root, table).where(_among("batch_id", batches))
    days = _values(of("silver_cdr_tagged").where(F.col("quality_status") == "VALID"), "event_date")
    clean = of("silver_cdr_clean").where(_among("event_date", days))
    arrived = landed(spark, root).where(_among("batch_id", batches))
    recon = reconcile.reconcile(of("metadata_ingestion_log"), arrived, clean, of("silver_cdr_quarantine"), as_of)
    merge_layer(recon, root, "gold_reconciliation_daily", BATCH_KEYS)
    run = of("gold_reconciliation_daily")
    add_run(run if run_ts is None else run.withColumn("reconciliation_ts", wall_clock(run_ts)), root)


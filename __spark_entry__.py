"""

``entry(spark)`` runs the flagship (batch reconciliation, which touches every
layer) on sf0.001. ``queries()`` registers one callable per operator/report of
the pipeline; each builds the layers from the driver's ``events`` table of the
given scale and returns a lazy DataFrame. ``oracle_sql()`` gives the DuckDB
statement that computes the same rows from the same parquet tables, for every
query except those in ``APPROXIMATE`` (estimates, checked against the exact
count in the tests).
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from meterflow import fixed  # noqa: E402
from meterflow.operators import quality, reconcile, reference, usage  # noqa: E402
from meterflow.plans import layers, monitoring, replay, reports, subscribers  # noqa: E402
from meterflow.plans.layerset import LayerSet  # noqa: E402
from meterflow.plans.oracle import ORACLE_SQL  # noqa: E402
from meterflow.schemas import BATCH_KEYS, LANDING_SCHEMA  # noqa: E402
from meterflow.sources import fixture, integrity, landing  # noqa: E402
from meterflow.streaming import incremental  # noqa: E402
from meterflow.sources.tables import read_layer, register_views  # noqa: E402
from meterflow.session import REQUIRED_CONF, checkpoint_root  # noqa: E402

try:  # the corpus operators are optional: without their folders all else works
    import corpus_pipeline
    from meterflow.llm.queries import ORACLE_SQL as LLM_SQL
    from meterflow.llm.queries import QUERIES as LLM_QUERIES

    LLM_QUERIES = {**LLM_QUERIES, "pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        LLM_SQL = {**LLM_SQL, "pipeline": corpus_pipeline.ORACLE_SQL}
except ImportError as missing:  # also of an emptied folder; errors inside the operators are raised
    if missing.name not in {"corpus_pipeline", "meterflow.llm", "meterflow.llm.queries"}:
        raise
    LLM_QUERIES, LLM_SQL = {}, {}

SMOKE_DIR = "/root/testdata/sf0.001"


SQL_REPORT = """
SELECT c.source_system, c.usage_day, c.clean_records, q.rejected_records, m.announced_batches
FROM (SELECT source_system, event_date AS usage_day, count(*) AS clean_records
      FROM silver_cdr_clean GROUP BY source_system, event_date) c
JOIN (SELECT source_system, CAST(ingestion_ts AS DATE) AS usage_day, count(*) AS rejected_records
      FROM silver_cdr_tagged WHERE quality_status = 'REJECTED' GROUP BY source_system, CAST(ingestion_ts AS DATE)) q
  ON c.source_system = q.source_system AND c.usage_day = q.usage_day
JOIN (SELECT source_system, CAST(arrival_ts AS DATE) AS usage_day, count(*) AS announced_batches
      FROM metadata_ingestion_log GROUP BY source_system, CAST(arrival_ts AS DATE)) m
  ON c.source_system = m.source_system AND c.usage_day = m.usage_day
"""


def _layers(spark: SparkSession, sf_dir: str) -> LayerSet:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return LayerSet.from_fixture(spark, sf_dir)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: reconcile every logged batch of the sf0.001 fixture."""
    return _layers(spark, SMOKE_DIR).recon


def _q(build: Callable[[LayerSet], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(_layers(spark, sf_dir))

    run.__doc__ = build.__doc__
    return run


_REPLAYED_ROOTS: dict[tuple[str, str], str] = {}


def _replayed_root(ls: LayerSet) -> str:
    """Layers written from a day's wrong batches, then from their replay; made once for a session and scale."""
    made = (ls.spark.sparkContext.applicationId, ls.source)
    if made not in _REPLAYED_ROOTS:
        root, later = f"{checkpoint_root(ls.spark)}/replayed-{uuid.uuid4().hex}", ls.as_of + dt.timedelta(hours=1)
        layers.write_layers(fixture.first_delivery(ls.bronze), ls.metadata, root, as_of=ls.as_of)
        replay.replay_batches(fixture.redelivered(ls.bronze), ls.metadata, root, as_of=ls.as_of, run_ts=later)
        _REPLAYED_ROOTS[made] = root
    return _REPLAYED_ROOTS[made]


def _replayed(table: str) -> Callable[[LayerSet], DataFrame]:
    """A layer after a day's wrong batches were replayed over written layers."""
    return lambda ls: read_layer(ls.spark, _replayed_root(ls), table)


def _with_check(make: Callable[[LayerSet], object]) -> Callable[[LayerSet], DataFrame]:
    """Verdict of every record with one more rule, from reference data."""

    def build(ls: LayerSet) -> DataFrame:
        tagged = quality.tag_quality(ls.bronze, as_of=ls.as_of, reference_checks=[make(ls)])
        return tagged.select("batch_id", "source_system", "cdr_id", "ingest_seq", "reject_reason")

    return build


def _partners(ls: LayerSet) -> DataFrame:
    """Roaming usage of clean records per partner, by the longest range that holds the other party's number."""
    ranges = fixture.partner_ranges(ls.spark)
    roaming = ls.clean.where(F.col("roaming_flag"))
    found = reference.match_prefix(roaming, "other_party_msisdn", ranges, "prefix", "partner", "partner")
    return found.groupBy("partner").agg(
        F.count(F.lit(1)).alias("roaming_events"), F.sum("duration_sec").alias("total_duration_sec")
    )


def _sql_report(ls: LayerSet) -> DataFrame:
    """A statement over the layers as views, run as it stands."""
    register_views(ls.spark, layers=ls)
    return ls.spark.sql(SQL_REPORT)


def _malformed(ls: LayerSet) -> DataFrame:
    """Verdicts of raw lines: those with fields too many or missing are rejected as malformed, with their line kept."""
    root = f"{checkpoint_root(ls.spark)}/landing-{uuid.uuid4().hex}"
    fixture.raw_lines(ls.bronze).write.text(f"{root}/raw")
    landing.read_lines(ls.spark, f"{root}/raw", {"header": "false"}, ls.as_of).write.parquet(f"{root}/lines")
    records, malformed = landing.split_malformed(ls.spark.read.parquet(f"{root}/lines"))
    tagged = quality.tag_quality(records, as_of=ls.as_of)
    tagged = tagged.unionByName(quality.tag_malformed(malformed, ls.as_of).select(*tagged.columns))
    line = malformed.select("ingestion_ts", "ingest_seq", "raw_line")
    return tagged.join(line, ["ingestion_ts", "ingest_seq"], "left").groupBy(
        *BATCH_KEYS, "reject_reason"
    ).agg(F.count(F.lit(1)).alias("record_count"), F.sum(F.length("raw_line")).alias("raw_characters"))


def _block_digests(ls: LayerSet) -> DataFrame:
    """Digests of the blocks of written day files."""
    folder = f"{checkpoint_root(ls.spark)}/days-{uuid.uuid4().hex}"
    fixture.write_day_files(ls.bronze, folder)
    blocks = integrity.block_digests(ls.spark, folder, fixture.DIGEST_BLOCK)
    return blocks.select(F.regexp_extract("path", r"day=(\d+)", 1).alias("day"), "block_no", "n_lines", "block_sha256")


def _control_totals(ls: LayerSet) -> DataFrame:
    """Announced against landed counts and charges, exact to the cent."""
    checked = integrity.control_total_check(fixture.control_totals(ls.bronze), ls.bronze)
    return checked.withColumns({c: F.col(c).cast("double") for c in ("control_charge_total", "landed_charge_total")})


def _history(ls: LayerSet) -> DataFrame:
    """Status changes between two runs: a build from wrong batches, then their replay an hour later."""
    return monitoring.status_changes(read_layer(ls.spark, _replayed_root(ls), "reconciliation_history"))


def _rolled_up(*keys: str) -> Callable[[LayerSet], DataFrame]:
    """Distinct subscribers from the written hourly bitmaps alone."""

    def build(ls: LayerSet) -> DataFrame:
        root = f"{checkpoint_root(ls.spark)}/subscribers-{uuid.uuid4().hex}"
        return subscribers.distinct_subscribers(subscribers.write_bitmaps(ls.clean, root), *keys)

    return build


def _incremental(ls: LayerSet) -> DataFrame:
    """Verdicts of the incremental tier, load after load; a load knows what earlier ones brought."""
    root = f"{checkpoint_root(ls.spark)}/incremental-{uuid.uuid4().hex}"
    step = incremental.IncrementalQuality(root, as_of=ls.as_of, fanout=2)
    for load in range(31 // fixture.LOAD_DAYS + 2):
        step(fixture.load_arrivals(ls.bronze, load).select(*LANDING_SCHEMA.fieldNames()), load)
    tagged = read_layer(ls.spark, root, "silver_cdr_tagged")
    return tagged.select("batch_id", "source_system", "cdr_id", "is_duplicate", "reject_reason", "quality_status")


def _recon_split(ls: LayerSet) -> DataFrame:
    """Reconciliation by three joins, over a split that lost and repeated records."""
    return reconcile.reconcile(ls.metadata, ls.bronze, *fixture.faulty_split(ls.clean, ls.quarantine), as_of=ls.as_of)


_QUERIES: dict[str, Callable[[LayerSet], DataFrame]] = {
    # sources and landing
    "bronze_raw": lambda ls: ls.bronze,
    "batch_metadata_log": lambda ls: ls.metadata.orderBy("source_system", "batch_id"),
    "bronze_counts_by_file": lambda ls: landing.file_counts(ls.bronze).orderBy("source_system", "source_file"),
    "sql_over_views": _sql_report,
    "malformed_lines": _malformed,
    "control_totals": _control_totals,
    "block_digests": _block_digests,
    # silver: typing, duplicates, quality rules, split
    "silver_typed": lambda ls: quality.standardise(ls.bronze, ls.as_of),
    "duplicate_flagged": lambda ls: quality.flag_duplicates(quality.standardise(ls.bronze, ls.as_of)).select(
        "batch_id", "source_system", "source_file", "cdr_id", "ingestion_ts", "ingest_seq", "is_duplicate"
    ),
    "quality_tagged": lambda ls: ls.tagged.select(*quality.TAGGED_COLUMNS),
    "silver_clean": lambda ls: ls.clean,
    "silver_quarantine": lambda ls: ls.quarantine,
    "duplicate_records": lambda ls: quality.duplicate_records(ls.tagged),
    "quality_status_reason_counts": lambda ls: reports.quality_status_reason_counts(ls.tagged),
    "reject_reasons": lambda ls: reports.reject_reasons(ls.quarantine),
    "source_status_counts": lambda ls: reports.source_status_counts(ls.tagged),
    "layer_count_check": lambda ls: reconcile.layer_balance_tagged(ls.bronze, ls.tagged),
    "quality_metrics": lambda ls: reports.quality_metrics(ls.tagged),
    # gold usage
    "gold_usage_hourly": lambda ls: ls.hourly.orderBy("usage_date", "usage_hour", "source_system", "event_type"),
    "gold_usage_hourly_first20": lambda ls: reports.hourly_first_rows(ls.hourly),
    "gold_subscriber_daily": lambda ls: ls.daily,
    "top_subscriber_days": lambda ls: reports.top_subscriber_days(ls.daily),
    "gold_layer_counts": reports.gold_layer_counts,
    # reconciliation
    "bronze_counts_by_batch": lambda ls: reconcile.bronze_counts(ls.bronze),
    "silver_counts_by_batch": lambda ls: reconcile.silver_counts(ls.clean),
    "quarantine_counts_by_batch": lambda ls: reconcile.quarantine_counts(ls.quarantine),
    "reconciliation": lambda ls: ls.recon.orderBy("source_system", "batch_id"),
    "count_match_check": lambda ls: reconcile.count_match_check(ls.recon).orderBy("source_system", "batch_id"),
    "count_match_labels": lambda ls: reconcile.count_match_labels(ls.recon).orderBy("source_system", "batch_id"),
    "recon_exceptions": lambda ls: reports.recon_exceptions(ls.recon),
    "recon_by_batch": lambda ls: reports.recon_by_batch(ls.recon),
    "recon_status_summary": lambda ls: reports.recon_status_summary(ls.recon),
    "reject_rate_by_source": lambda ls: reports.reject_rate_by_source(ls.recon),
    "reject_rate_by_source_dups": lambda ls: reports.reject_rate_by_source(ls.recon, with_duplicates=True),
    "reconciliation_split": lambda ls: _recon_split(ls).orderBy("source_system", "batch_id"),
    "count_match_check_split": lambda ls: reconcile.count_match_check(_recon_split(ls)),
    "count_match_labels_split": lambda ls: reconcile.count_match_labels(_recon_split(ls)),
    "unregistered_batches": lambda ls: reconcile.unregistered_batches(ls.metadata, ls.bronze),
    # optional rules: number format, reference data
    "invalid_msisdn_formats": lambda ls: quality.tag_quality(
        ls.bronze, quality.default_rules(extra=[quality.OPTIONAL_RULES["INVALID_MSISDN_FORMAT"]]), ls.as_of
    ).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("record_count")),
    "roaming_partner_usage": _partners,
    "roaming_partner_tagged": _with_check(lambda ls: reference.PartnerCheck(fixture.partner_ranges(ls.spark))),
    "cell_validity_tagged": _with_check(lambda ls: reference.ValidityCheck(fixture.cell_periods(ls.bronze))),
    # batches delivered wrong, then replayed over the written layers
    "replayed_tagged": _replayed("silver_cdr_tagged"),
    "replayed_gold_hourly": _replayed("gold_cdr_usage_hourly"),
    "replayed_reconciliation": _replayed("gold_reconciliation_daily"),
    "reconciliation_history": _history,
    "incremental_outcomes": _incremental,
    # dashboard
    "layer_counts": reports.layer_counts,
    "valid_vs_quarantined": reports.valid_vs_quarantined,
    "event_type_distribution": lambda ls: reports.event_type_distribution(ls.hourly),
    "hourly_usage_trend": lambda ls: reports.hourly_usage_trend(ls.hourly),
    "top_subscribers": lambda ls: reports.top_subscribers(ls.daily),
    "source_usage_summary": lambda ls: reports.source_usage_summary(ls.hourly),
    "source_unique_subscribers": lambda ls: reports.source_unique_subscribers(ls.clean),
    "source_unique_subscribers_rollup": _rolled_up("source_system"),
    "daily_unique_subscribers_rollup": _rolled_up("usage_date", "event_type"),
    "daily_usage_summary": lambda ls: reports.daily_usage_summary(ls.hourly),
    "quality_by_source": lambda ls: reports.quality_by_source_tagged(ls.tagged),
    "quality_by_source_joined": lambda ls: reports.quality_by_source(ls.clean, ls.quarantine),
    "quarantine_sample": lambda ls: reports.quarantine_sample(ls.quarantine),
    # monitoring (documented needs beyond the core reports)
    "reconciliation_trend": lambda ls: monitoring.reconciliation_trend(ls.recon, ls.metadata),
    "quality_scorecard": lambda ls: monitoring.quality_scorecard(ls.tagged),
    "reject_rate_jumps": lambda ls: monitoring.reject_rate_jumps(ls.recon, ls.metadata),
    "missing_batches": lambda ls: monitoring.missing_batches(ls.metadata),
    "late_batches": lambda ls: monitoring.late_batches(ls.metadata, ls.as_of, [*fixed.SOURCE_SYSTEMS, "SILENT_SOURCE"]),
    "sequence_overlaps": lambda ls: monitoring.sequence_overlaps(ls.clean),
    # approximate (no exact SQL twin): mergeable subscriber sketches rolled up per source
    "source_unique_subscribers_approx": lambda ls: usage.unique_subscribers_from_sketches(
        usage.hourly_subscriber_sketches(ls.clean), "source_system"
    ),
}

# Registered without a DuckDB twin: the result is an estimate, checked against
# the exact count within its error bound in tests/test_monitoring.py.
APPROXIMATE = {"source_unique_subscribers_approx"}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _q(build) for name, build in _QUERIES.items()} | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for each registered query over the driver's parquet views."""
    return {name: sql for name, sql in ORACLE_SQL.items() if name in _QUERIES} | LLM_SQL


__all__ = ["entry", "queries", "oracle_sql", "fixed"]

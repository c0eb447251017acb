"""Reconciliation status and rate on golden rows."""

import pytest
from pyspark.sql import functions as F

from meterflow.functions.metrics import rate
from meterflow.operators import reconcile


def status(spark, expected, bronze, clean, quarantine):
    df = spark.createDataFrame(
        [(expected, bronze, clean, quarantine)],
        "expected_record_count int, bronze_record_count long, silver_valid_count long, quarantine_count long",
    ).withColumn("reject_rate", rate("quarantine_count", "bronze_record_count"))
    r = reconcile.with_status(df).first()
    return r.reject_rate, r.reconciliation_status


@pytest.mark.parametrize(
    "row, want",
    [
        ((1000, 1000, 930, 70), (0.07, "RECONCILED")),
        ((1000, 1000, 850, 150), (0.15, "WARNING")),
        ((1000, 980, 920, 60), (0.0612, "FAILED")),
        ((1000, 1000, 900, 100), (0.1, "RECONCILED")),
        ((100000, 100000, 89996, 10004), (0.1, "RECONCILED")),
        ((1000, 1000, 899, 101), (0.101, "WARNING")),
        ((1000, 1000, 900, 99), (0.099, "FAILED")),
        ((100, 0, 0, 0), (None, "FAILED")),
    ],
)
def test_status(spark, row, want):
    assert status(spark, *row) == want


def test_quality_summary_rate(spark):
    df = spark.range(1).select(rate(F.lit(285), F.lit(3000)).alias("r"))
    assert df.first().r == 0.095


def test_unregistered_batch_is_hidden_but_listed(spark):
    from meterflow.plans.layerset import LayerSet

    ls = LayerSet.from_fixture(spark, "/root/testdata/sf0.001")
    ids = {r.batch_id for r in ls.recon.select("batch_id").collect()}
    assert "BATCH_20240102_000000_ROAMING_PARTNER" not in ids
    orphans = [r.batch_id for r in reconcile.unregistered_batches(ls.metadata, ls.bronze).collect()]
    assert orphans == ["BATCH_20240102_000000_ROAMING_PARTNER"]


def test_split_and_tagged_reconciliation_agree(spark):
    from meterflow.plans.layerset import LayerSet

    ls = LayerSet.from_fixture(spark, "/root/testdata/sf0.01")
    a = reconcile.reconcile(ls.metadata, ls.bronze, ls.clean, ls.quarantine, as_of=ls.as_of)
    b = reconcile.reconcile_tagged(ls.metadata, ls.tagged, as_of=ls.as_of)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    counts = {r.reconciliation_status: r.batch_count for r in reconcile.status_summary(b).collect()}
    assert counts == {"RECONCILED": 30, "WARNING": 56, "FAILED": 4}


def test_quality_by_source_full_outer_semantics(spark):
    from meterflow.plans import reports

    clean = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "source_system string")
    quarantine = spark.createDataFrame([("B",), ("C",), (None,), (None,)], "source_system string")
    got = sorted(
        (r.source_system or "", r.clean_count, r.quarantine_count, r.total_count, r.quarantine_rate)
        for r in reports.quality_by_source(clean, quarantine).collect()
    )
    # NULL sources do not match each other: one row from each side.
    assert got == [("", 0, 2, 2, 1.0), ("", 1, 0, 1, 0.0), ("A", 2, 0, 2, 0.0), ("B", 1, 1, 2, 0.5), ("C", 0, 1, 1, 1.0)]

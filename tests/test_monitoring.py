"""Monitoring reports: skew-safe sequence check against a plain window."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF
from meterflow.plans import monitoring
from meterflow.plans.layerset import LayerSet
from meterflow.sources import fixture


def brute_force(clean):
    w = Window.partitionBy("subscriber_msisdn").orderBy(*monitoring.SEQUENCE_ORDER).rowsBetween(
        Window.unboundedPreceding, -1
    )
    end = F.timestamp_add("SECOND", F.col("duration_sec"), F.col("event_ts")).alias("event_end")
    latest = F.max(F.struct(end, *monitoring.SEQUENCE_ORDER)).over(w)
    out = clean.select(
        "subscriber_msisdn", "source_system", "cdr_id", "event_ts",
        latest["source_system"].alias("previous_source_system"),
        latest["cdr_id"].alias("previous_cdr_id"),
        latest["event_end"].alias("previous_end_ts"),
    )
    return out.where(F.col("event_ts") < F.col("previous_end_ts"))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_hot_subscriber_split_by_hours(spark):
    clean = LayerSet.from_fixture(spark, SF["0.01"]).clean
    hot = clean.withColumn(
        "subscriber_msisdn",
        F.when(F.abs(F.hash("cdr_id")) % 3 == 0, F.lit("90539999999")).otherwise(F.col("subscriber_msisdn")),
    )
    expected = rows(brute_force(hot))
    assert len(expected) > 0
    try:
        for partitions, reuse in [("1", "true"), ("7", "false"), ("64", "true")]:
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.exchange.reuse", reuse)
            assert rows(monitoring.sequence_overlaps(hot)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_an_event_open_over_others_is_found(spark):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1, 10, 59, 0)
    events = [("A", 0, 6000), ("B", 10, 5), ("C", 100, 5), ("D", 3700, 1), ("E", 6000, 1)]
    clean = spark.createDataFrame(
        [("m", "S", k, t0 + dt.timedelta(seconds=s), d) for k, s, d in events],
        "subscriber_msisdn string, source_system string, cdr_id string, event_ts timestamp, duration_sec int",
    )
    got = {(r.cdr_id, r.previous_cdr_id) for r in monitoring.sequence_overlaps(clean).collect()}
    assert got == {("B", "A"), ("C", "A"), ("D", "A")}


def test_late_batches_up_to_now(spark):
    import datetime as dt

    log = spark.createDataFrame(
        [("MEDIATION_A", dt.datetime(2024, 1, d)) for d in (1, 2)] + [("MEDIATION_B", dt.datetime(2024, 1, 1))],
        "source_system string, arrival_ts timestamp",
    )
    got = monitoring.late_batches(log, dt.datetime(2024, 1, 3, 6), ["MEDIATION_A", "MEDIATION_B", "X"]).collect()
    assert [(r.source_system, r.expected_date.day, r.hours_late) for r in got] == [
        ("MEDIATION_B", 2, 6), ("X", 1, 30), ("X", 2, 6)
    ]
    assert monitoring.late_batches(log, dt.datetime(2023, 12, 1)).count() == 0


def test_missing_batches_and_jumps(spark):
    ls = LayerSet.from_fixture(spark, SF["0.01"])
    missing = [(r.source_system, str(r.expected_date)) for r in monitoring.missing_batches(ls.metadata).collect()]
    assert missing == [("ROAMING_PARTNER", "2024-01-02")]
    jumps = monitoring.reject_rate_jumps(ls.recon, ls.metadata)
    first = jumps.where(F.col("previous_avg_reject_rate").isNull()).count()
    assert first == 3


def test_subscriber_sketches_roll_up_within_error(spark):
    import __spark_entry__ as entry_module

    approx = {r.source_system: r.approx_unique_subscribers
              for r in entry_module.queries()["source_unique_subscribers_approx"](spark, SF["0.1"]).collect()}
    exact = {r.source_system: r.unique_subscribers
             for r in entry_module.queries()["source_unique_subscribers"](spark, SF["0.1"]).collect()}
    assert approx.keys() == exact.keys()
    for k in exact:
        assert abs(approx[k] - exact[k]) <= 0.05 * exact[k]


def test_history_keeps_every_run_and_selects_the_latest(spark, scratch):
    import datetime as dt

    from meterflow.plans.layers import write_layers
    from meterflow.plans.replay import replay_batches
    from meterflow.sources.tables import read_layer

    ls = LayerSet.from_fixture(spark, SF["0.001"])
    later = fixture.AS_OF + dt.timedelta(hours=1)
    write_layers(fixture.first_delivery(ls.bronze), ls.metadata, scratch, as_of=fixture.AS_OF)
    replay_batches(fixture.redelivered(ls.bronze), ls.metadata, scratch, as_of=later)
    history = read_layer(spark, scratch, "reconciliation_history")
    assert history.select("run_id").distinct().count() == 2
    first = monitoring.latest_reconciliation(history, fixture.AS_OF)
    now = monitoring.latest_reconciliation(history)
    stored = read_layer(spark, scratch, "gold_reconciliation_daily")
    assert now.exceptAll(stored).count() == 0 and stored.exceptAll(now).count() == 0
    changed = {r.batch_id: (r.previous_status, r.reconciliation_status) for r in monitoring.status_changes(history).collect()}
    assert {b for b in changed if "20240108" in b} and all(a != b for a, b in changed.values())
    was = {r.batch_id: r.reconciliation_status for r in first.collect()}
    is_ = {r.batch_id: r.reconciliation_status for r in now.collect()}
    assert changed == {b: (was[b], is_[b]) for b in is_ if was[b] != is_[b]}
    assert any(v == ("FAILED", "RECONCILED") or v == ("FAILED", "WARNING") for v in changed.values())

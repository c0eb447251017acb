"""Layered writes: partitioned Parquet, read back, idempotent batch replay."""

import os

from pyspark.sql import functions as F

from conftest import SF
from meterflow.plans import reports
from meterflow.plans.layers import write_layers
from meterflow.plans.layerset import LayerSet
from meterflow.sources import fixture
from meterflow.sources.tables import LAYOUT, read_layer


def snapshot(spark, root):
    return {t: sorted(map(tuple, read_layer(spark, root, t).collect())) for t in LAYOUT}


def test_write_read_and_replay(spark, scratch):
    root = os.path.join(scratch, "layers")
    mem = LayerSet.from_fixture(spark, SF["0.001"])
    write_layers(mem.bronze, mem.metadata, root, as_of=fixture.AS_OF)
    assert os.path.isdir(os.path.join(root, "bronze_cdr_raw", "batch_id=BATCH_20240101_000000_MEDIATION_A"))
    first = snapshot(spark, root)

    disk = LayerSet.from_tables(spark, root, as_of=fixture.AS_OF)
    assert disk.recon.exceptAll(mem.recon).count() == 0
    assert disk.hourly.exceptAll(mem.hourly).count() == 0
    assert reports.layer_counts(disk).exceptAll(reports.layer_counts(mem)).count() == 0
    assert reports.quality_metrics(disk.tagged).exceptAll(reports.quality_metrics(mem.tagged)).count() == 0

    # Replay one batch: only its bronze partition is replaced; result identical.
    one = mem.bronze.where(F.col("batch_id") == "BATCH_20240105_000000_MEDIATION_B")
    write_layers(one, mem.metadata, root, as_of=fixture.AS_OF, replay=True)
    assert snapshot(spark, root) == first


def test_sql_over_views_and_cli(spark, scratch):
    from meterflow.__main__ import main
    from meterflow.sources.tables import register_views

    root = os.path.join(scratch, "cli")
    main(["build", "--sf-dir", SF["0.001"], "--root", root])
    register_views(spark, root)
    got = spark.sql(
        "SELECT reconciliation_status, count(*) AS n FROM gold_reconciliation_daily GROUP BY reconciliation_status"
    )
    assert {r.reconciliation_status: r.n for r in got.collect()} == {"RECONCILED": 51, "WARNING": 35, "FAILED": 4}
    total = spark.sql(
        "SELECT (SELECT count(*) FROM silver_cdr_clean) + (SELECT count(*) FROM silver_cdr_quarantine) AS n"
    ).first().n
    assert total == spark.sql("SELECT count(*) AS n FROM bronze_cdr_raw").first().n == 1012

    sql_file = os.path.join(scratch, "r.sql")
    with open(sql_file, "w") as fh:
        fh.write("-- a report\nSELECT reject_reason, count(*) AS c FROM silver_cdr_quarantine GROUP BY reject_reason;\n")
    main(["sql", "--root", root, "--file", sql_file])
    main(["reconcile", "--root", root])
    assert read_layer(spark, root, "gold_reconciliation_daily").count() == 90


def test_build_from_landing(spark, scratch):
    from meterflow.plans.layers import build_from_landing
    from meterflow.schemas import LANDING_SCHEMA

    ls = LayerSet.from_fixture(spark, SF["0.001"])
    landing = os.path.join(scratch, "landing")
    (ls.bronze.select(*[f.name for f in LANDING_SCHEMA.fields]).repartition(2, "batch_id")
     .write.options(header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(landing))
    root = os.path.join(scratch, "from_landing")
    build_from_landing(spark, landing, root)
    disk = LayerSet.from_tables(spark, root)
    assert disk.bronze.count() == 1012
    reasons = {r.reject_reason: r.rejected_record_count for r in reports.reject_reasons(disk.quarantine).collect()}
    expected = {r.reject_reason: r.rejected_record_count for r in reports.reject_reasons(ls.quarantine).collect()}
    assert reasons == expected
    # nobody announced a count, so nothing can be reconciled
    assert {(r.reconciliation_status, r.expected_record_count) for r in disk.recon.collect()} == {("FAILED", None)}


def test_rebalanced_write_splits_a_hot_partition(spark, scratch):
    from meterflow.sources.tables import write_layer

    ls = LayerSet.from_fixture(spark, SF["0.01"])
    hot = ls.quarantine.unionByName(ls.quarantine).unionByName(ls.quarantine).withColumn(
        "batch_id", F.lit("BATCH_HOT")
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
    try:
        root = os.path.join(scratch, "hot")
        write_layer(hot, root, "silver_cdr_quarantine")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    folder = os.path.join(root, "silver_cdr_quarantine", "batch_id=BATCH_HOT")
    files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    assert len(files) > 1
    assert read_layer(spark, root, "silver_cdr_quarantine").count() == 3 * ls.quarantine.count()


def test_reconciliation_from_tables_catches_a_lost_batch(spark, scratch):
    from meterflow.sources.tables import write_layer

    root = os.path.join(scratch, "loss")
    mem = LayerSet.from_fixture(spark, SF["0.001"])
    write_layers(mem.bronze, mem.metadata, root, as_of=fixture.AS_OF)
    lost = "BATCH_20240105_000000_MEDIATION_B"
    clean = read_layer(spark, root, "silver_cdr_clean")
    staged = os.path.join(scratch, "staged")
    write_layer(clean.where(F.col("batch_id") != lost), staged, "silver_cdr_clean")
    write_layer(read_layer(spark, staged, "silver_cdr_clean"), root, "silver_cdr_clean")

    from meterflow.operators.reconcile import reconcile

    disk = LayerSet.from_tables(spark, root, as_of=fixture.AS_OF)
    recon = reconcile(disk.metadata, disk.bronze, disk.clean, disk.quarantine, as_of=fixture.AS_OF)
    before = {r.batch_id: r.reconciliation_status for r in mem.recon.collect()}
    after = {r.batch_id: r.reconciliation_status for r in recon.collect()}
    changed = {b for b in after if after[b] != before[b]}
    assert changed == {lost} and after[lost] == "FAILED"
    row = recon.where(F.col("batch_id") == lost).first()
    assert row.silver_valid_count == 0 and row.bronze_record_count > row.quarantine_count


def landed(spark, folder, *batches):
    """CSV landing files, one per (batch, keys)."""
    from helpers import rows
    from meterflow.schemas import LANDING_SCHEMA

    for batch, keys in batches:
        frame = rows(spark, *[{"batch_id": batch, "cdr_id": k, "source_file": f"{batch}.csv"} for k in keys])
        frame.select(*LANDING_SCHEMA.fieldNames()).coalesce(1).write.option("header", "true").csv(os.path.join(folder, batch))
    return os.path.join(folder, "*")


def control_of(spark, folder, *expected):
    from meterflow.sources.landing import read_control

    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "control.csv"), "w") as fh:
        fh.write("source_system,batch_id,source_file,expected_record_count\n")
        fh.writelines(f"MEDIATION_A,{b},{b}.csv,{n}\n" for b, n in expected)
    return read_control(spark, folder)


def test_replay_keeps_other_batches_and_announced_counts(spark, scratch):
    from meterflow.plans.layers import build_from_landing

    root = os.path.join(scratch, "root")
    both = landed(spark, os.path.join(scratch, "both"), ("B1", ["K1", "K2"]), ("B2", ["K3", "K4"]))
    build_from_landing(spark, both, root, control=control_of(spark, os.path.join(scratch, "c1"), ("B1", 2), ("B2", 5)))

    def status():
        rows = read_layer(spark, root, "gold_reconciliation_daily").collect()
        return {r.batch_id: (r.expected_record_count, r.reconciliation_status) for r in rows}

    assert status() == {"B1": (2, "RECONCILED"), "B2": (5, "FAILED")}
    again = landed(spark, os.path.join(scratch, "again"), ("B1", ["K1", "K2"]))
    for control in (None, control_of(spark, os.path.join(scratch, "c2"), ("B1", 2))):
        build_from_landing(spark, again, root, replay=True, control=control)
        assert status() == {"B1": (2, "RECONCILED"), "B2": (5, "FAILED")}


def test_all_valid_all_rejected_and_numeric_looking_batches(spark, scratch):
    from helpers import rows

    for name, override, table in [
        ("valid", {}, "silver_cdr_quarantine"),
        ("rejected", {"duration_raw": "0"}, "silver_cdr_clean"),
    ]:
        root = os.path.join(scratch, name)
        bronze = rows(spark, *[{"batch_id": "0001", **override}] * 3)
        from meterflow.plans.layers import build_downstream, log_landed

        from meterflow.sources.tables import write_layer

        write_layer(bronze, root, "bronze_cdr_raw", rebalance=False)
        log_landed(read_layer(spark, root, "bronze_cdr_raw"), root, merge=False)
        build_downstream(spark, root, as_of=fixture.AS_OF)
        assert read_layer(spark, root, table).count() == 0
        got = read_layer(spark, root, "gold_reconciliation_daily").collect()
        assert [(r.batch_id, r.bronze_record_count) for r in got] == [("0001", 3)]
        assert {r.batch_id for r in read_layer(spark, root, "bronze_cdr_raw").collect()} == {"0001"}


def test_reordered_header_fails_loudly(spark, scratch):
    import pytest

    from meterflow.schemas import LANDING_SCHEMA
    from meterflow.sources.landing import read_landing

    names = LANDING_SCHEMA.fieldNames()
    names[0], names[3] = names[3], names[0]
    path = os.path.join(scratch, "odd.csv")
    with open(path, "w") as fh:
        fh.write(",".join(names) + "\n" + ",".join("x" for _ in names) + "\n")
    with pytest.raises(Exception, match="header|schema"):
        read_landing(spark, path).collect()


def test_statements_and_session(monkeypatch, spark):
    from meterflow import __main__ as cli
    from meterflow import session

    text = "-- one; two\nSELECT ';' AS a, `b;c` /* ; */ FROM t;\n\nSELECT 2"
    assert [s.split()[0:2] for s in cli._statements(text)] == [["SELECT", "';'"], ["SELECT", "2"]]
    assert session.cluster_session() is not None
    import inspect

    assert "master" not in inspect.getsource(session.cluster_session).split('"""')[2]

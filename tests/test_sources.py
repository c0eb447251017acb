"""Landing readers, naming expressions, reference rules and delivery integrity."""

import datetime as dt
import hashlib
import os

from pyspark.sql import functions as F

from conftest import SF
from helpers import rows
from meterflow.functions import naming
from meterflow.operators import quality
from meterflow.plans.layerset import LayerSet
from meterflow.schemas import BRONZE_COLUMNS, LANDING_SCHEMA
from meterflow.sources import integrity
from meterflow.sources.landing import read_landing

LANDING_COLS = [f.name for f in LANDING_SCHEMA.fields]


def test_read_landing_csv_round_trip(spark, scratch):
    ls = LayerSet.from_fixture(spark, SF["0.001"])
    path = os.path.join(scratch, "landing")
    ls.bronze.select(*LANDING_COLS).repartition(3).write.options(header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)
    landed = read_landing(spark, path, as_of=dt.datetime(2024, 2, 1))
    assert landed.columns == BRONZE_COLUMNS
    assert landed.select(*LANDING_COLS).exceptAll(ls.bronze.select(*LANDING_COLS)).count() == 0
    assert landed.count() == ls.bronze.count()
    assert landed.select("ingest_seq").distinct().count() == landed.count()


def test_read_landing_lineage_and_dated_layout(spark, scratch):
    root = os.path.join(scratch, "dated")
    day = os.path.join(root, "MEDIATION_B", "2024", "01", "07")
    os.makedirs(day)
    with open(os.path.join(day, "cdr_mediation_b_20240107_000000.csv"), "w") as fh:
        fh.write(",".join(LANDING_COLS) + "\n")
        fh.write("BATCH_X,,,K1,90531234567,90547654321,VOICE,2024-01-07 10:00:00,30,CELL_1,SW_1,N,1.00,TRY\n")
        fh.write(",,,K2,90531234567,90547654321,VOICE,2024-01-07 10:00:00,30,CELL_1,SW_1,N,1.00,TRY\n")
    got = read_landing(spark, root, dated=True).orderBy("cdr_id").collect()
    assert [r.source_system for r in got] == ["MEDIATION_B", "MEDIATION_B"]
    assert got[0].source_file == "cdr_mediation_b_20240107_000000.csv"
    assert [r.batch_id for r in got] == ["BATCH_X", "BATCH_20240107_000000_MEDIATION_B"]


def test_naming_expressions(spark):
    stamp = naming.stamp_from_file(F.lit("cdr_mediation_a_20240107_101112.csv"))
    r = spark.range(1).select(
        naming.batch_id(stamp, F.lit("MEDIATION_A")).alias("b"), naming.stamp_from_file(F.lit("other.csv")).alias("none")
    ).first()
    assert (r.b, r.none) == ("BATCH_20240107_101112_MEDIATION_A", None)


def test_reference_check_rejects_unknown_cells(spark):
    cells = spark.createDataFrame([("CELL_100",), ("CELL_101",)], "cell_id string")
    check = quality.ReferenceCheck("DQ_X03", "UNKNOWN_CELL_ID", "cell_id", cells)
    df = rows(spark, {"cell_id": "CELL_100"}, {"cell_id": "CELL_999"}, {"cell_id": None}, {"cell_id": "CELL_999", "duration_raw": "0"})
    got = [r.reject_reason for r in quality.tag_quality(df, reference_checks=[check]).orderBy("ingest_seq").collect()]
    assert got == [None, "UNKNOWN_CELL_ID", None, "INVALID_DURATION"]


def test_checksums_against_manifest(spark, scratch):
    folder = os.path.join(scratch, "files")
    os.makedirs(folder)
    payload = {"a.csv": b"x,y\n1,2\n", "b.csv": b"x,y\n3,4\n", "c.csv": b"extra"}
    for name, data in payload.items():
        with open(os.path.join(folder, name), "wb") as fh:
            fh.write(data)
    manifest = spark.createDataFrame(
        [("a.csv", hashlib.sha256(payload["a.csv"]).hexdigest()), ("b.csv", "0" * 64), ("d.csv", "1" * 64)],
        "file_name string, sha256 string",
    )
    got = integrity.checksum_mismatches(integrity.file_checksums(spark, folder), manifest)
    assert sorted((r.file_name, r.problem) for r in got.collect()) == [
        ("b.csv", "CHECKSUM_MISMATCH"),
        ("c.csv", "UNEXPECTED_FILE"),
        ("d.csv", "MISSING_FILE"),
    ]


def test_control_totals(spark):
    ls = LayerSet.from_fixture(spark, SF["0.001"])
    landed = (
        ls.bronze.groupBy("batch_id", "source_system", "source_file")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("charge_amount_raw").try_cast("double")), 2).alias("c"))
    )
    control = landed.select(
        "batch_id", "source_system", "source_file",
        F.when(F.col("batch_id").endswith("MEDIATION_A"), F.col("n") + 1).otherwise(F.col("n")).alias("control_record_count"),
        F.col("c").alias("control_charge_total"),
    )
    out = integrity.control_total_check(control, ls.bronze)
    assert out.where(~F.col("charge_matched")).count() == 0
    assert out.where(~F.col("count_matched")).count() == out.where(F.col("batch_id").endswith("MEDIATION_A")).count() > 0


def test_read_landing_parquet_without_batch_columns(spark, scratch):
    """Parquet landing files without batch columns: lineage fills them from the file name."""
    import shutil

    ls = LayerSet.from_fixture(spark, SF["0.001"])
    one = ls.bronze.where(F.col("batch_id") == "BATCH_20240107_000000_MEDIATION_B")
    staged = os.path.join(scratch, "staged")
    one.select(*[c for c in LANDING_COLS if c not in ("batch_id", "source_file")]).coalesce(1).write.parquet(staged)
    landing = os.path.join(scratch, "landing_pq")
    os.makedirs(landing)
    part = next(f for f in os.listdir(staged) if f.endswith(".parquet"))
    shutil.copy(os.path.join(staged, part), os.path.join(landing, "cdr_mediation_b_20240107_000000.parquet"))
    got = read_landing(spark, landing, fmt="parquet")
    assert got.count() == one.count()
    assert {(r.batch_id, r.source_file) for r in got.select("batch_id", "source_file").distinct().collect()} == {
        ("BATCH_20240107_000000_MEDIATION_B", "cdr_mediation_b_20240107_000000.parquet")
    }


def block_tree(data, size):
    """Digests of the blocks of a file's lines, by their definition."""
    blocks, at = {}, 0
    lines = data.split(b"\n")
    for line in lines[:-1] if lines[-1] == b"" else lines:
        blocks.setdefault(at // size, []).append(hashlib.sha256(line).hexdigest())
        at += len(line) + 1
    return {k: (len(d), hashlib.sha256("".join(d).encode()).hexdigest()) for k, d in blocks.items()}


def test_block_digests_do_not_depend_on_splits_and_name_the_damage(spark, scratch):
    folder = os.path.join(scratch, "large")
    os.makedirs(folder)
    rng = __import__("random").Random(4)
    line = lambda: bytes(rng.choice(b"abc,;\r\xe9 ") for _ in range(rng.choice([0, 3, 40, 900])))
    files = {"a.csv": b"\n".join(line() for _ in range(700)) + b"\n", "b.csv": b"\n".join(line() for _ in range(300)), "c.csv": b"", "d.csv": b"\n\nx"}
    for name, data in files.items():
        with open(os.path.join(folder, name), "wb") as fh:
            fh.write(data)
    want = {(n, k): v for n, data in files.items() for k, v in block_tree(data, 5000).items()}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ["1700b", "30000b", old]:
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            blocks = integrity.block_digests(spark, folder, 5000)
            got = {(r.file_name, r.block_no): (r.n_lines, r.block_sha256) for r in blocks.collect()}
            assert got == want
            roots = {r.file_name: r.tree_sha256 for r in integrity.tree_digests(blocks).collect()}
            assert roots["a.csv"] == hashlib.sha256("".join(want[n, k][1] for n, k in sorted(want) if n == "a.csv").encode()).hexdigest()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    manifest = spark.createDataFrame([(n, k, v[1]) for (n, k), v in want.items()], "file_name string, block_no long, block_sha256 string")
    with open(os.path.join(folder, "a.csv"), "r+b") as fh:  # one byte of block 3
        fh.seek(files["a.csv"].index(b"a", 16000))
        fh.write(b"Z")
    os.remove(os.path.join(folder, "d.csv"))
    problems = integrity.block_mismatches(integrity.block_digests(spark, folder, 5000), manifest).collect()
    assert sorted((r.file_name, r.block_no, r.problem) for r in problems) == [("a.csv", 3, "BLOCK_MISMATCH"), ("d.csv", 0, "MISSING_BLOCK")]


def test_control_totals_are_exact_to_the_cent(spark):
    from meterflow.sources import fixture

    bronze = rows(spark, *[{"charge_amount_raw": c} for c in ["0.10"] * 7 + ["0.20", "1e-2", "abc", "NaN", None, "-0.30"]])
    keys = {k: bronze.first()[k] for k in ["batch_id", "source_system", "source_file"]}
    for total, matched in [("0.61", True), ("0.62", False), ("0.605", True), ("0.604", False)]:
        control = spark.createDataFrame([(*keys.values(), 13, total)], "batch_id string, source_system string, source_file string, control_record_count long, control_charge_total string")
        row = integrity.control_total_check(control, bronze).first()
        assert (row.count_matched, row.charge_matched, str(row.landed_charge_total)) == (True, matched, "0.61")
    ls = LayerSet.from_fixture(spark, SF["0.001"])
    checked = integrity.control_total_check(fixture.control_totals(ls.bronze), ls.bronze)
    assert [r.batch_id for r in checked.where("NOT charge_matched").collect()] == [fixture.CENT_OFF]
    assert [r.batch_id for r in checked.where("NOT count_matched").collect()] == [fixture.ONE_LESS]


def test_malformed_lines_end_in_quarantine(spark, scratch):
    from meterflow.plans.layers import build_from_landing
    from meterflow.sources.tables import read_layer, read_side

    folder = os.path.join(scratch, "landing")
    os.makedirs(folder)
    good = "BATCH_20240107_101112_MEDIATION_A,MEDIATION_A,cdr_mediation_a_20240107_101112.csv,{},90531234567,90547654321,VOICE,2024-01-07 10:00:00,30,CELL_1,SW_1,N,1.00,TRY\n"
    bad = [good.format("K3")[:-1] + ",extra\n", "K4,too,short\n", good.format("K1")[:-1] + ",copy of a key\n"]

    def land(name, lines):
        with open(os.path.join(folder, name), "w") as fh:
            fh.write(",".join(LANDING_COLS) + "\n" + "".join(lines))

    land("cdr_mediation_a_20240107_101112.csv", [good.format("K1"), bad[0], bad[1], good.format("K2"), bad[2]])
    land("unnamed.csv", [good.format("K9").replace("101112", "202122").replace("MEDIATION_A_", "X"), "B7,S7,f7.csv,K8\n"])
    root = os.path.join(scratch, "root")
    build_from_landing(spark, folder, root)
    clean, quarantine = (read_layer(spark, root, t) for t in ["silver_cdr_clean", "silver_cdr_quarantine"])
    assert sorted(r.cdr_id for r in clean.collect()) == ["K1", "K2", "K9"]
    assert {r.reject_reason for r in quarantine.collect()} == {"MALFORMED_RECORD"}
    named = ("BATCH_20240107_101112_MEDIATION_A", "MEDIATION_A", "cdr_mediation_a_20240107_101112.csv")
    lines = read_side(spark, root, "bronze_cdr_malformed").collect()
    assert sorted(((r.batch_id, r.source_system, r.source_file), r.raw_line) for r in lines) == sorted(
        [(named, b.strip()) for b in bad] + [(("B7", "S7", "f7.csv"), "B7,S7,f7.csv,K8")]
    )
    recon = {r.batch_id: r for r in read_layer(spark, root, "gold_reconciliation_daily").collect()}
    row = recon[named[0]]
    assert (row.bronze_record_count, row.silver_valid_count, row.quarantine_count) == (5, 2, 3)
    assert recon["B7"].bronze_record_count == recon["B7"].quarantine_count == 1
    assert read_layer(spark, root, "silver_cdr_tagged").count() == 7
    # delivered again without bad lines
    land("cdr_mediation_a_20240107_101112.csv", [good.format("K1"), good.format("K2"), good.format("K3")])
    os.remove(os.path.join(folder, "unnamed.csv"))
    build_from_landing(spark, folder, root, replay=True)
    assert [r.batch_id for r in read_side(spark, root, "bronze_cdr_malformed").collect()] == ["B7"]
    assert read_layer(spark, root, "silver_cdr_clean").count() == 4

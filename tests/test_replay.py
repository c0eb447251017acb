"""Replay of batches: equal to a full rebuild, and nothing but what is affected is read."""

import glob
import os

from pyspark.sql import functions as F

from conftest import SF
from helpers import rows
from meterflow.operators import keyfilter
from meterflow.plans.layers import write_layers
from meterflow.plans.layerset import LayerSet
from meterflow.plans.replay import replay_batches, write_key_filters
from meterflow.sources import fixture
from meterflow.sources.tables import LAYOUT, read_layer


def snapshot(spark, root, tables=LAYOUT):
    return {t: sorted(map(tuple, read_layer(spark, root, t).collect()), key=str) for t in tables}


def spoil(folder):
    """Make a partition's files unreadable: whoever opens one fails."""
    for name in glob.glob(os.path.join(folder, "*.parquet")):
        with open(name, "wb") as out:
            out.write(b"spoilt")
        crc = os.path.join(folder, f".{os.path.basename(name)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


def test_replay_equals_a_full_rebuild(spark, scratch):
    ls = LayerSet.from_fixture(spark, SF["0.001"])
    whole, root = (os.path.join(scratch, d) for d in ["whole", "replayed"])
    write_layers(ls.bronze, ls.metadata, whole, as_of=fixture.AS_OF)
    write_layers(fixture.first_delivery(ls.bronze), ls.metadata, root, as_of=fixture.AS_OF)
    assert snapshot(spark, root) != snapshot(spark, whole)
    touched = replay_batches(fixture.redelivered(ls.bronze), ls.metadata, root, as_of=fixture.AS_OF)
    assert snapshot(spark, root) == snapshot(spark, whole)
    # other batches and days were affected, through the keys
    assert any("20240108" not in b for b in touched["batches"]) and len(touched["days"]) > 1
    assert len(touched["batches"]) < 30
    # the same replay again changes nothing
    replay_batches(fixture.redelivered(ls.bronze), ls.metadata, root, as_of=fixture.AS_OF)
    assert snapshot(spark, root) == snapshot(spark, whole)


def test_only_affected_partitions_are_read(spark, scratch):
    """All partitions that the replay reports as untouched are unreadable, except the small key filters and logs."""
    ls = LayerSet.from_fixture(spark, SF["0.001"])
    trial, root = (os.path.join(scratch, d) for d in ["trial", "root"])
    for path in (trial, root):
        write_layers(fixture.first_delivery(ls.bronze), ls.metadata, path, as_of=fixture.AS_OF)
        write_key_filters(read_layer(spark, path, "bronze_cdr_raw"), path)
    touched = replay_batches(fixture.redelivered(ls.bronze), ls.metadata, trial, as_of=fixture.AS_OF)
    want = snapshot(spark, trial)

    folders, kept = [], {"batch_id": set(touched["batches"]), "day": {str(d) for d in touched["days"]}}
    for table, unit in [
        ("bronze_cdr_raw", "batch_id"), ("silver_cdr_tagged", "batch_id"), ("silver_cdr_quarantine", "batch_id"),
        ("silver_cdr_clean", "day"), ("gold_cdr_usage_hourly", "day"), ("gold_subscriber_usage_daily", "day"),
    ]:
        for folder in glob.glob(os.path.join(root, table, "*=*")):
            if os.path.basename(folder).split("=", 1)[1] not in kept[unit]:
                folders += [folder, *glob.glob(os.path.join(folder, "*=*"))]
    assert len(folders) > 100
    for folder in folders:
        spoil(folder)
    assert replay_batches(fixture.redelivered(ls.bronze), ls.metadata, root, as_of=fixture.AS_OF) == touched
    tables = ["gold_reconciliation_daily", "metadata_ingestion_log"]
    assert snapshot(spark, root, tables) == {t: want[t] for t in tables}


def test_partitions_that_lose_all_rows_go(spark, scratch):
    def put(*overrides):
        return rows(spark, *[{"source_file": f"{o['batch_id']}.csv", **o} for o in overrides])

    first = put(
        {"batch_id": "B1", "cdr_id": "K1", "start_time_raw": "2024-03-01 10:00:00"},
        {"batch_id": "B1", "cdr_id": "K2", "duration_raw": "0"},
        {"batch_id": "B2", "cdr_id": "K1", "ingest_seq": 9, "start_time_raw": "2024-03-02 11:00:00"},
        {"batch_id": "B2", "cdr_id": None, "ingest_seq": 10},
        {"batch_id": "B3", "cdr_id": None, "ingest_seq": 11},
    )
    again = put({"batch_id": "B1", "cdr_id": "K3", "start_time_raw": "2024-03-05 10:00:00"})
    final = again.unionByName(first.where("batch_id <> 'B1'"))
    log = LayerSet.from_fixture(spark, SF["0.001"]).metadata.limit(0)
    root, whole = (os.path.join(scratch, d) for d in ["root", "whole"])
    write_layers(first, log, root, as_of=fixture.AS_OF)
    replay_batches(again, log, root, as_of=fixture.AS_OF)
    write_layers(final, log, whole, as_of=fixture.AS_OF)
    assert snapshot(spark, root) == snapshot(spark, whole)
    # a NULL key is a key: B2's record without one was first, and still is after B2 is replayed without it
    replay_batches(first.where("batch_id = 'B2' AND cdr_id IS NOT NULL"), log, root, as_of=fixture.AS_OF)
    write_layers(final.where("batch_id <> 'B2' OR cdr_id IS NOT NULL"), log, whole, as_of=fixture.AS_OF)
    assert snapshot(spark, root) == snapshot(spark, whole)


def test_a_new_batch_is_a_replay_of_nothing(spark, scratch):
    ls = LayerSet.from_fixture(spark, SF["0.001"])
    root, whole = (os.path.join(scratch, d) for d in ["root", "whole"])
    last = F.substring("batch_id", 7, 8) >= "20240129"
    write_layers(ls.bronze.where(~last), ls.metadata.where(~last), root, as_of=fixture.AS_OF)
    replay_batches(ls.bronze.where(last), ls.metadata.where(last), root, as_of=fixture.AS_OF)
    write_layers(ls.bronze, ls.metadata, whole, as_of=fixture.AS_OF)
    assert snapshot(spark, root) == snapshot(spark, whole)


def test_filters_have_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(0, 30_000).select(
        F.when(F.col("id") % 7 == 0, None).otherwise("S").alias("s"),
        F.col("id").cast("string").alias("k"),
        F.when(F.col("id") < 25_000, "hot").otherwise((F.col("id") % 5).cast("string")).alias("batch"),
    )
    filters = keyfilter.build(keys, ["s", "k"], ["batch"])
    assert filters.groupBy("batch").count().where("batch = 'hot'").first()["count"] > 20
    got = keyfilter.may_contain(keys.select("s", "k"), ["s", "k"], filters, ["batch"])
    assert keys.select("s", "k", "batch").exceptAll(got).count() == 0
    assert got.count() <= 30_000 + 3
    other = spark.range(100_000, 150_000).select(F.lit("S").alias("s"), F.col("id").cast("string").alias("k"))
    assert keyfilter.may_contain(other, ["s", "k"], filters, ["batch"]).count() <= 5
    none = keyfilter.build(keys.limit(0), ["s", "k"], ["batch"])
    assert none.count() == 0 and keyfilter.may_contain(keys, ["s", "k"], none, ["batch"]).count() == 0


def test_a_key_is_one_row_until_its_bitmaps(spark):
    keys = spark.range(0, 5_000).select(
        F.when(F.col("id") % 9 == 0, None).otherwise("S").alias("s"),
        F.col("id").cast("string").alias("k"),
        (F.col("id") % 3).cast("string").alias("batch"),
    )
    filters = keyfilter.build(keys, ["s", "k"], ["batch"])
    plan = filters._jdf.queryExecution().optimizedPlan().toString()
    # from the top: the bitmaps are laid over each other after all probes have been aggregated
    assert plan.index("bitmap_or_agg") < plan.index("Generate") < plan.index("bitmap_construct_agg")
    asked = keyfilter.may_contain(keys.select("s", "k"), ["s", "k"], filters, ["batch"])
    assert "forall(" not in asked._jdf.queryExecution().optimizedPlan().toString()
    # the same bits as a row for each probe gives
    a, b = keyfilter._hashes(["s", "k"])
    rows_of = keys.select("batch", "s", "k", a.alias("a"), b.alias("b")).join(
        filters.groupBy("batch").agg(F.max("level").alias("level")), "batch"
    )
    start, step = F.pmod("a", F.lit(32768)), F.pmod("b", F.lit(16384)) * 2 + 1
    bits = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.pmod(start + i * step, F.lit(32768)))
    each = rows_of.select("batch", "level", keyfilter._block(F.col("a"), F.col("level")).alias("block"), F.explode(bits).alias("bit"))
    want = each.groupBy("batch", "level", "block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    got, want = ({(r.batch, r.level, r.block): bytes(r.bitmap) for r in f.collect()} for f in (filters, want))
    assert got == want and len(got) > 3


def test_a_filter_on_batches_comes_before_the_columns(spark):
    """The redelivered day is chosen below the projection of the other columns."""
    plan = fixture.redelivered(LayerSet.from_fixture(spark, SF["0.001"]).bronze)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("lpad") < plan.index("Filter")
    assert "lpad" not in plan[plan.index("Filter"):]

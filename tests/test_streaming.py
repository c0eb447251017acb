"""Incremental tier: stream results equal the batch pipeline; replay is idempotent."""

import os

from pyspark.sql import functions as F

from conftest import SF
from meterflow.plans.layers import write_layers
from meterflow.plans.layerset import LayerSet
from meterflow.schemas import LANDING_SCHEMA
from meterflow.sources import fixture
from meterflow.sources.tables import read_layer
from meterflow.streaming.incremental import IncrementalQuality, hourly_usage_stream, run_incremental

LANDING_COLS = [f.name for f in LANDING_SCHEMA.fields]


def land(bronze, path, files):
    bronze.select(*LANDING_COLS).repartition(files, "batch_id").write.options(header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)


def outcome(df):
    return sorted(
        tuple(r) for r in df.select("batch_id", "source_system", "cdr_id", F.col("reject_reason")).collect()
    )


def test_stream_equals_batch_and_catches_cross_batch_copies(spark, scratch):
    ls = LayerSet.from_fixture(spark, SF["0.001"])
    landing, root, ckpt = (os.path.join(scratch, d) for d in ["landing", "stream", "ckpt"])
    land(ls.bronze, os.path.join(landing, "day1"), 4)
    run_incremental(spark, landing + "/*", root, ckpt, as_of=fixture.AS_OF, max_files_per_trigger=1)

    quarantine = read_layer(spark, root, "silver_cdr_quarantine")
    clean = read_layer(spark, root, "silver_cdr_clean")
    assert outcome(quarantine) == outcome(ls.quarantine)
    assert sorted(r.cdr_id for r in clean.collect()) == sorted(r.cdr_id for r in ls.clean.collect())

    # A later file re-sends five records that were clean: all become duplicates.
    picked = ls.clean.select("cdr_id").orderBy("cdr_id").limit(5)
    originals = ls.bronze.where(F.col("ingest_seq") % 2 == 0).join(picked, "cdr_id", "left_semi")
    resent = originals.withColumn("batch_id", F.lit("BATCH_20240201_000000_MEDIATION_A"))
    land(resent, os.path.join(landing, "day2"), 1)
    run_incremental(spark, landing + "/*", root, ckpt, as_of=fixture.AS_OF)
    late = read_layer(spark, root, "silver_cdr_quarantine").where(F.col("batch_id") == "BATCH_20240201_000000_MEDIATION_A")
    assert [r.reject_reason for r in late.collect()] == ["DUPLICATE_CDR_ID"] * 5
    assert read_layer(spark, root, "silver_cdr_clean").count() == clean.count()


def test_retried_micro_batch_is_idempotent(spark, scratch):
    ls = LayerSet.from_fixture(spark, SF["0.001"])
    root = os.path.join(scratch, "stream")
    step = IncrementalQuality(root, as_of=fixture.AS_OF)
    micro = ls.bronze.select(*LANDING_COLS)
    step(micro, 0)
    first = {t: outcome(read_layer(spark, root, t).withColumn("reject_reason", F.lit(None)))
             if t == "silver_cdr_clean" else outcome(read_layer(spark, root, t))
             for t in ["silver_cdr_clean", "silver_cdr_quarantine"]}
    step(micro, 0)
    again = {t: outcome(read_layer(spark, root, t).withColumn("reject_reason", F.lit(None)))
             if t == "silver_cdr_clean" else outcome(read_layer(spark, root, t))
             for t in ["silver_cdr_clean", "silver_cdr_quarantine"]}
    assert first == again
    assert read_layer(spark, root, "bronze_cdr_raw").count() == ls.bronze.count()


def test_hourly_stream_matches_batch_on_closed_windows(spark, scratch):
    ls = LayerSet.from_fixture(spark, SF["0.001"])
    root = os.path.join(scratch, "layers")
    write_layers(ls.bronze, ls.metadata, root, as_of=fixture.AS_OF)
    clean_stream = (
        spark.readStream.schema(read_layer(spark, root, "silver_cdr_clean").schema)
        .option("maxFilesPerTrigger", "5")
        .parquet(os.path.join(root, "silver_cdr_clean"))
    )
    q = (
        hourly_usage_stream(clean_stream)
        .writeStream.outputMode("append")
        .format("memory")
        .queryName("hourly_stream_test")
        .option("checkpointLocation", os.path.join(scratch, "ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    got = spark.table("hourly_stream_test").drop("approx_unique_subscribers")
    batch = ls.hourly.drop("unique_subscribers")
    assert got.count() > 0
    assert got.exceptAll(batch).count() == 0


def micro(spark, *records):
    """Landing rows (batch, key) as a micro-batch."""
    from helpers import rows

    return rows(spark, *[{"batch_id": b, "cdr_id": k} for b, k in records]).select(*LANDING_COLS)


def balance(spark, root):
    bronze, clean, quarantine = (
        sorted((str(r.batch_id), r.cdr_id) for r in read_layer(spark, root, t).collect())
        for t in ["bronze_cdr_raw", "silver_cdr_clean", "silver_cdr_quarantine"]
    )
    assert sorted(clean + quarantine) == bronze
    keys = [k for _, k in clean]
    assert len(keys) == len(set(keys))
    return clean, quarantine


def test_redelivery_split_and_nameless_batches(spark, scratch):
    root = os.path.join(scratch, "loads")
    step = IncrementalQuality(root, as_of=fixture.AS_OF)
    step(micro(spark, ("B1", "K1"), ("B1", "K2")), 0)
    step(micro(spark, ("B2", "K1"), ("B2", "K3")), 1)
    step(micro(spark, ("B1", "K1"), ("B1", "K2")), 2)  # delivered again
    step(micro(spark, ("B2", "K4"), (None, "K5"), (None, "K3")), 3)  # the rest of B2, and records without a batch
    step(micro(spark, ("B2", "K4"), (None, "K5"), (None, "K3")), 3)  # a retry
    clean, quarantine = balance(spark, root)
    assert clean == [("B1", "K1"), ("B1", "K2"), ("B2", "K3"), ("B2", "K4"), ("None", "K5")]
    assert len(quarantine) == 4


def test_publish_reconciles_the_loads(spark, scratch):
    from meterflow.streaming.incremental import publish

    ls = LayerSet.from_fixture(spark, SF["0.001"])
    root = os.path.join(scratch, "published")
    IncrementalQuality(root, as_of=fixture.AS_OF)(ls.bronze.select(*LANDING_COLS), 0)
    publish(spark, root, fixture.fixture_control(spark, ls.bronze), as_of=fixture.AS_OF)
    status = {r.batch_id: r.reconciliation_status for r in read_layer(spark, root, "gold_reconciliation_daily").collect()}
    expected = {r.batch_id: r.reconciliation_status for r in ls.recon.collect()}
    unannounced = set(status) - set(expected)
    assert {b: s for b, s in status.items() if b in expected} == expected
    assert unannounced and all(status[b] == "FAILED" for b in unannounced)
    assert read_layer(spark, root, "gold_cdr_usage_hourly").exceptAll(ls.hourly).count() == 0


def spoil_keys(root):
    """Make every file of seen keys unreadable; the filters stay."""
    import glob

    files = glob.glob(os.path.join(root, "seen_keys", "*", "*", "*.parquet"))
    for name in files:
        os.remove(os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc"))
        with open(name, "wb") as out:
            out.write(b"spoilt")
    return files


def test_a_load_of_new_keys_reads_no_key_file(spark, scratch):
    ls = LayerSet.from_fixture(spark, SF["0.001"])
    step = IncrementalQuality(scratch, as_of=fixture.AS_OF)
    arrivals = fixture.loads(ls.bronze)
    step(arrivals.where("load_no = 0").select(*LANDING_COLS), 0)
    assert spoil_keys(scratch)
    fresh = arrivals.where("load_no = 1 AND ingest_seq DIV 2 % 53 <> 7").select(*LANDING_COLS)
    step(fresh, 1)
    assert read_layer(spark, scratch, "bronze_cdr_raw").count() > fresh.count()


def test_compaction_keeps_every_key(spark, scratch):
    import pytest

    from meterflow.streaming.incremental import FILTER_SCHEMA, compact

    ls = LayerSet.from_fixture(spark, SF["0.001"])
    step = IncrementalQuality(scratch, as_of=fixture.AS_OF, fanout=2)
    days = [ls.bronze.where(F.dayofmonth("ingestion_ts") == d).select(*LANDING_COLS) for d in range(1, 5)]
    for epoch, day in enumerate(days):
        step(day, epoch)
    known = spark.read.schema(FILTER_SCHEMA).parquet(os.path.join(scratch, "seen_filters"))
    assert known.select("load_id").distinct().count() <= 2
    before = read_layer(spark, scratch, "silver_cdr_clean").count()
    step(days[0].unionByName(days[3]), 100)
    assert read_layer(spark, scratch, "silver_cdr_clean").count() == before
    again = read_layer(spark, scratch, "silver_cdr_tagged").groupBy("cdr_id").agg(F.count_if(~F.col("is_duplicate")).alias("n"))
    assert again.where("n <> 1").count() == 0
    assert compact(spark, os.path.join(scratch, "nothing")) == []
    # a key file that is needed and cannot be read is an error, not a lost duplicate
    spoil_keys(scratch)
    with pytest.raises(Exception, match="Parquet|parquet"):
        step(days[0], 300)


def test_exact_hourly_stream_equals_gold_also_after_a_restart(spark, scratch):
    from meterflow.schemas import GOLD_HOURLY_COLUMNS
    from meterflow.streaming.incremental import hourly_usage_stream_exact

    ls = LayerSet.from_fixture(spark, SF["0.001"])
    source, out, ckpt = (os.path.join(scratch, d) for d in ["clean", "hourly", "ckpt"])
    schema, days = ls.clean.schema, [F.dayofmonth("event_ts").between(a, a + 9) for a in (1, 11, 21)]
    last = ls.clean.limit(1).withColumn("event_ts", F.lit("2024-03-01 00:00:00").cast("timestamp"))

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "3").parquet(source)
        query = (
            hourly_usage_stream_exact(stream).writeStream.outputMode("append").format("parquet")
            .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out)
        )
        query.awaitTermination()

    for part in days:  # a new query each time, from the checkpoint of the one before
        ls.clean.where(part).coalesce(1).write.mode("append").parquet(source)
        run()
    last.coalesce(1).write.mode("append").parquet(source)  # closes every hour of the fixture
    run()
    got = spark.read.parquet(out).select(*GOLD_HOURLY_COLUMNS)
    want = ls.hourly
    assert got.count() == want.count() > 500
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_load_has_few_key_files_whatever_its_tasks(spark, scratch):
    import glob

    from meterflow.streaming.incremental import SEEN_BUCKETS, _write_seen, compact

    def files():
        return glob.glob(os.path.join(scratch, "seen_keys", "*", "*", "*.parquet"))

    def keys(first, load):
        ids = spark.range(first, first + 6_000, 1, 12)
        return ids.select(F.lit("S").alias("source_system"), F.col("id").cast("string").alias("cdr_id"), F.lit(load).alias("load_id"))

    _write_seen(keys(0, "a"), scratch)
    assert SEEN_BUCKETS <= len(files()) <= 2 * SEEN_BUCKETS
    _write_seen(keys(6_000, "b"), scratch)
    assert compact(spark, scratch, fanout=2) == ["a", "b"]
    assert SEEN_BUCKETS <= len(files()) <= 2 * SEEN_BUCKETS
    assert spark.read.parquet(os.path.join(scratch, "seen_keys")).select("cdr_id").distinct().count() == 12_000


def test_arrivals_of_a_load_are_those_of_all_loads(spark):
    ls = LayerSet.from_fixture(spark, SF["0.001"])
    odd = ls.bronze.limit(3).withColumn("ingest_seq", F.lit(None).cast("long"))
    odd = odd.unionByName(ls.bronze.limit(3).withColumn("ingestion_ts", F.lit(None).cast("timestamp")))
    bronze = ls.bronze.unionByName(odd)
    whole = fixture.loads(bronze)
    for load in range(5):
        got, want = fixture.load_arrivals(bronze, load), whole.where(F.col("load_no") == load)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert fixture.load_arrivals(bronze, 1).count() > ls.bronze.where(F.dayofmonth("ingestion_ts").between(9, 16)).count()

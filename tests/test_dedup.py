"""Duplicate flags: equal to row_number() > 1 under a total order, skew-safe."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import T0, rows
from meterflow.operators import quality
from meterflow.operators.dedup import DEFAULT_KEY, DEFAULT_ORDER, flag_duplicates
from meterflow.sources import fixture


def brute_force(df):
    w = Window.partitionBy(*DEFAULT_KEY).orderBy(*DEFAULT_ORDER)
    return df.withColumn("is_duplicate", F.row_number().over(w) > 1)


def flags(df):
    return sorted((r.ingest_seq, r.is_duplicate) for r in df.select("ingest_seq", "is_duplicate").collect())


def test_identical_copies_keep_exactly_one(spark):
    df = rows(spark, *[{"cdr_id": "K"} for _ in range(5)])
    got = flags(flag_duplicates(df))
    assert sum(not d for _, d in got) == 1
    assert got == flags(brute_force(df))


def test_earliest_ingestion_wins_then_batch_then_seq(spark):
    later = T0 + dt.timedelta(minutes=1)
    df = rows(
        spark,
        {"cdr_id": "K", "ingestion_ts": later, "ingest_seq": 1},
        {"cdr_id": "K", "ingestion_ts": T0, "batch_id": "B2", "ingest_seq": 2},
        {"cdr_id": "K", "ingestion_ts": T0, "batch_id": "B1", "ingest_seq": 3},
    )
    assert flags(flag_duplicates(df)) == [(1, True), (2, True), (3, False)]


def test_null_keys_form_a_group(spark):
    df = rows(spark, {"cdr_id": None}, {"cdr_id": None}, {"cdr_id": None, "source_system": None}, {})
    got = flags(flag_duplicates(df))
    assert got == flags(brute_force(df))
    assert sum(d for _, d in got) == 1


def test_key_is_per_source(spark):
    df = rows(spark, {"cdr_id": "K"}, {"cdr_id": "K", "source_system": "MEDIATION_B"})
    assert [d for _, d in flags(flag_duplicates(df))] == [False, False]


def test_first_copy_invalid_rejects_both(spark):
    df = rows(
        spark,
        {"cdr_id": "K", "duration_raw": "abc", "ingest_seq": 0},
        {"cdr_id": "K", "ingestion_ts": T0 + dt.timedelta(minutes=1), "ingest_seq": 1},
    )
    tagged = quality.tag_quality(df).orderBy("ingest_seq").collect()
    assert [r.reject_reason for r in tagged] == ["INVALID_DURATION", "DUPLICATE_CDR_ID"]


def test_hot_key_holding_a_third_of_rows(spark):
    """One key with a third of all rows: same flags as the window, no row lost."""
    base = fixture.fixture_bronze(fixture.events(spark, "/root/testdata/sf0.001"))
    n = base.count()
    hot = base.where(F.col("ingest_seq") % 3 == 0).withColumn("cdr_id", F.lit("MEDIATION_A_HOT")).withColumn(
        "source_system", F.lit("MEDIATION_A")
    )
    df = base.where(F.col("ingest_seq") % 3 != 0).unionByName(hot)
    got = flag_duplicates(df)
    assert got.count() == n
    assert flags(got) == flags(brute_force(df))
    assert got.where(F.col("cdr_id") == "MEDIATION_A_HOT").where(~F.col("is_duplicate")).count() == 1


def test_fixture_matches_window_at_any_partition_count(spark):
    df = fixture.fixture_bronze(fixture.events(spark, "/root/testdata/sf0.01"))
    expected = flags(brute_force(df))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ["1", "64"]:
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            assert flags(flag_duplicates(df)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_no_window_and_no_python_in_tagging_plan(spark):
    df = quality.tag_quality(fixture.fixture_bronze(fixture.events(spark, "/root/testdata/sf0.001")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "Python" not in plan and "ArrowEval" not in plan


def test_hot_key_is_split_by_aqe_when_not_broadcast(spark):
    """Broadcasts off (as when the repeated-key table is large): AQE splits the hot key's partition.

    Splitting works along map outputs, so the input is spread over several map
    tasks first, as any large input is; the flags stay exact.
    """
    base = fixture.fixture_bronze(fixture.events(spark, "/root/testdata/sf0.1")).repartition(8)
    is_hot = F.col("ingest_seq") % 3 == 0
    hot = base.withColumn("cdr_id", F.when(is_hot, F.lit("MEDIATION_A_HOT")).otherwise(F.col("cdr_id"))).withColumn(
        "source_system", F.when(is_hot, F.lit("MEDIATION_A")).otherwise(F.col("source_system"))
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        expected = flags(brute_force(hot))
        got = flag_duplicates(hot)
        assert sorted((r.ingest_seq, r.is_duplicate) for r in got.collect()) == expected
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert plan.count("skew=true") >= 1
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

"""Distinct subscribers that add up exactly: bitmaps per hour over a persisted numbering.

A distinct count per hour says nothing about the day: the same subscriber counts in each
hour. A bitmap of subscriber numbers per hour does, since bitmaps are united before they
are counted. So hourly gold gets a companion table of bitmaps, and any roll-up (source,
day, month) is exact from gold alone.

* ``extend_numbers``: each subscriber gets one number for good, counted up without gaps
  so that bitmaps are few and full. New subscribers are numbered in parallel: their place
  in their partition plus the number of new ones in earlier partitions (one count for
  each partition passes the driver).
* ``hourly_bitmaps``: subscribers of an hour are reduced to distinct ones before they
  meet the numbering, so a hot subscriber costs a row an hour, and an hour with a third of
  all records is spread over its bitmaps (``BITS`` numbers each).
* ``distinct_subscribers``: unites bitmaps by key and number range, then adds counts up.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.operators.usage import HOURLY_KEYS
from meterflow.sources.tables import exists, layer_path

BITS = 32768  # the size of Spark's bitmaps
NUMBERS, NUMBERS_SCHEMA = "subscriber_numbers", "subscriber_msisdn string, subscriber_no long"
BITMAPS = "gold_cdr_subscribers_hourly"
BITMAPS_SCHEMA = "usage_hour int, source_system string, event_type string, range_no long, subscribers binary, usage_date date"


def numbers(spark: SparkSession, root: str) -> DataFrame:
    """The numbering; empty before the first subscriber."""
    if not exists(spark, root, NUMBERS):
        return spark.createDataFrame([], NUMBERS_SCHEMA)
    return spark.read.schema(NUMBERS_SCHEMA).parquet(layer_path(root, NUMBERS))


def extend_numbers(clean: DataFrame, root: str) -> DataFrame:
    """Number the subscribers of ``clean`` that have no number yet; returns the whole numbering.

    Numbers given once never change. A run that failed before its append can be repeated.
    """
    spark = clean.sparkSession
    known = numbers(spark, root)
    fresh = clean.select("subscriber_msisdn").where("subscriber_msisdn IS NOT NULL").distinct()
    fresh = fresh.join(known, "subscriber_msisdn", "left_anti")
    staged = f"{root.rstrip('/')}/_staging/{NUMBERS}-{uuid.uuid4().hex}"
    fresh.select("subscriber_msisdn", F.monotonically_increasing_id().alias("place")).write.parquet(staged)
    placed = spark.read.schema("subscriber_msisdn string, place long").parquet(staged).select(
        "subscriber_msisdn", F.shiftright("place", 33).alias("part"), F.col("place").bitwiseAND((1 << 33) - 1).alias("place")
    )
    base, starts = (known.agg(F.max("subscriber_no")).first()[0] or 0) + 1, []
    for row in placed.groupBy("part").count().orderBy("part").collect():
        starts.append((row.part, base))
        base += row["count"]
    if starts:
        begin = F.broadcast(spark.createDataFrame(starts, "part long, base long"))  # a row for each partition
        numbered = placed.join(begin, "part").select("subscriber_msisdn", (F.col("base") + F.col("place")).alias("subscriber_no"))
        numbered.write.mode("append").parquet(layer_path(root, NUMBERS))
    return numbers(spark, root)


def hourly_bitmaps(clean: DataFrame, numbering: DataFrame) -> DataFrame:
    """Bitmaps of the subscribers of each hour, source and event type, per range of numbers."""
    seen = clean.select(
        F.col("event_date").alias("usage_date"),
        F.col("event_hour").alias("usage_hour"),
        "source_system",
        "event_type",
        "subscriber_msisdn",
    ).distinct()
    number = F.col("subscriber_no")
    return (
        seen.join(numbering, "subscriber_msisdn")
        .groupBy(*HOURLY_KEYS, F.bitmap_bucket_number(number).alias("range_no"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("subscribers"))
    )


def write_bitmaps(clean: DataFrame, root: str, dynamic: bool = False) -> DataFrame:
    """Number new subscribers and write the bitmaps of the days of ``clean``; ``dynamic`` leaves other days."""
    spark = clean.sparkSession
    rows = hourly_bitmaps(clean, extend_numbers(clean, root))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    writer.partitionBy("usage_date").parquet(layer_path(root, BITMAPS))
    return read_bitmaps(spark, root)


def read_bitmaps(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(BITMAPS_SCHEMA).parquet(layer_path(root, BITMAPS))


def distinct_subscribers(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Exact distinct subscribers for any roll-up of the hourly bitmaps."""
    united = bitmaps.groupBy(*keys, "range_no").agg(F.bitmap_or_agg("subscribers").alias("subscribers"))
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count("subscribers")).alias("unique_subscribers"))

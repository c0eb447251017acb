"""Subscriber bitmaps: numbers stay, roll-ups equal exact distinct counts."""

import os

from pyspark.sql import functions as F

from conftest import SF
from meterflow.plans import subscribers
from meterflow.plans.layerset import LayerSet


def exact(clean, *keys):
    rows = clean.withColumnsRenamed({"event_date": "usage_date", "event_hour": "usage_hour"}).groupBy(*keys)
    return sorted(map(tuple, rows.agg(F.count_distinct("subscriber_msisdn")).collect()))


def test_roll_ups_are_exact_and_numbers_stay(spark, scratch):
    clean = LayerSet.from_fixture(spark, SF["0.001"]).clean
    root = os.path.join(scratch, "gold")
    # some subscribers appear later only; each part holds whole days
    clean = clean.where((F.dayofmonth("event_date") > 12) | ~F.col("subscriber_msisdn").endswith("3"))
    early = F.dayofmonth("event_date") <= 12
    subscribers.write_bitmaps(clean.where(early).repartition(5), root)
    first = {r.subscriber_msisdn: r.subscriber_no for r in subscribers.numbers(spark, root).collect()}
    assert sorted(first.values()) == list(range(1, len(first) + 1))
    bitmaps = subscribers.write_bitmaps(clean.where(~early).repartition(3), root, dynamic=True)
    later = {r.subscriber_msisdn: r.subscriber_no for r in subscribers.numbers(spark, root).collect()}
    assert sorted(later.values()) == list(range(1, len(later) + 1)) and len(later) > len(first)
    assert all(later[s] == n for s, n in first.items())
    for keys in [("source_system",), ("usage_date",), ("usage_date", "usage_hour"), ("event_type", "usage_hour")]:
        got = sorted(map(tuple, subscribers.distinct_subscribers(bitmaps, *keys).collect()))
        assert got == exact(clean, *keys)
    # the same days again change nothing
    again = subscribers.write_bitmaps(clean.where(early), root, dynamic=True)
    assert sorted(map(tuple, subscribers.distinct_subscribers(again, "source_system").collect())) == exact(clean, "source_system")


def test_several_ranges_and_no_rows(spark, scratch):
    clean = LayerSet.from_fixture(spark, SF["0.001"]).clean
    many = spark.range(70_000).select(
        F.to_date(F.lit("2024-05-01")).alias("event_date"), F.lit(3).alias("event_hour"), F.lit("S").alias("source_system"),
        F.lit("SMS").alias("event_type"), F.format_string("9053%07d", F.col("id") % 66_000).alias("subscriber_msisdn"),
    )
    bitmaps = subscribers.write_bitmaps(many.repartition(4), os.path.join(scratch, "many"))
    assert bitmaps.count() == 3
    assert subscribers.distinct_subscribers(bitmaps, "source_system").first().unique_subscribers == 66_000
    none = subscribers.write_bitmaps(clean.limit(0), os.path.join(scratch, "none"))
    assert subscribers.distinct_subscribers(none, "source_system").count() == 0

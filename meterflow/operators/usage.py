"""Gold usage aggregates over clean records.

Both are single ``groupBy`` aggregates: partial aggregation runs before the
shuffle, so a hot key (one source, one subscriber) is pre-reduced per map task.
The distinct subscriber count is exact; Catalyst plans it as an aggregate on
(key, subscriber) first, which is again pre-reduced before each shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions.metrics import count_when, money_sum
from meterflow.schemas import GOLD_HOURLY_COLUMNS, GOLD_SUBSCRIBER_DAILY_COLUMNS

HOURLY_KEYS = ["usage_date", "usage_hour", "source_system", "event_type"]
EVENT_TYPE_COUNTS = [
    ("VOICE", "voice_call_count"),
    ("SMS", "sms_count"),
    ("DATA", "data_session_count"),
    ("ROAMING", "roaming_event_count"),
]


def usage_hourly(clean: DataFrame) -> DataFrame:
    """Events, duration, charge, distinct subscribers and roaming events per hour, source and type."""
    return (
        clean.groupBy(
            F.col("event_date").alias("usage_date"),
            F.col("event_hour").alias("usage_hour"),
            "source_system",
            "event_type",
        )
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.sum("duration_sec").alias("total_duration_sec"),
            money_sum("charge_amount").alias("total_charge"),
            F.count_distinct("subscriber_msisdn").alias("unique_subscribers"),
            count_when(F.col("roaming_flag")).alias("roaming_events"),
        )
        .select(*GOLD_HOURLY_COLUMNS)
    )


def subscriber_daily(clean: DataFrame) -> DataFrame:
    """Per subscriber and day: counts by event type, duration and charge."""
    return (
        clean.groupBy(F.col("event_date").alias("usage_date"), "subscriber_msisdn")
        .agg(
            *[count_when(F.col("event_type") == t).alias(name) for t, name in EVENT_TYPE_COUNTS],
            F.sum("duration_sec").alias("total_duration_sec"),
            money_sum("charge_amount").alias("total_charge"),
        )
        .select(*GOLD_SUBSCRIBER_DAILY_COLUMNS)
    )


SKETCH_LG_K = 12  # HLL sketch size 2^12 registers: about 1.6% relative error


def hourly_subscriber_sketches(clean: DataFrame, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """Per hourly key, a mergeable HLL sketch of the subscribers.

    Distinct counts do not add up across hours; sketches do: any rollup (per
    source, per day, per month) unions them instead of rescanning clean records.
    """
    return clean.groupBy(
        F.col("event_date").alias("usage_date"),
        F.col("event_hour").alias("usage_hour"),
        "source_system",
        "event_type",
    ).agg(F.hll_sketch_agg("subscriber_msisdn", lg_k).alias("subscriber_sketch"))


def unique_subscribers_from_sketches(sketches: DataFrame, *keys: str) -> DataFrame:
    """Approximate distinct subscribers for any rollup of the hourly sketches."""
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("subscriber_sketch")).alias("approx_unique_subscribers")
    )

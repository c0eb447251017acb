"""Reference data: number ranges (longest prefix) and master data with validity periods.

* ``match_prefix``: which range of a numbering plan a number belongs to. Ranges nest, the
  longest prefix wins. Only the numbers' different heads (as long as the longest prefix)
  are expanded into their prefixes and joined by equality; a head is then one row with its
  range, and the records get it by one equi-join. So records are never multiplied by the
  lengths, and a number that many records name costs one row.
* ``active_at``: whether an entity was valid at a record's time. Overlapping periods are
  merged first, so that a record meets one at most; a period is cut into bins of
  ``BIN_DAYS`` days, and the join is on (entity, bin) with the exact bounds as a residual.

Both joins are plain equi-joins: Spark broadcasts the small side once its size is known to
allow it, and splits a hot key's partition otherwise. A NULL number, entity or time matches
nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.operators.quality import Rule

BIN_DAYS = 32


def match_prefix(records: DataFrame, number: str, ranges: DataFrame, prefix: str, value: str, name: str) -> DataFrame:
    """``records`` with ``name``: the ``value`` of the longest ``prefix`` of ``ranges`` that starts the number.

    NULL where no prefix does. Of equal prefixes the smallest value counts.
    """
    plan = ranges.where(F.length(prefix) > 0).groupBy(F.col(prefix).alias("_prefix")).agg(F.min(value).alias("_value"))
    # one row: the lengths in use, and the longest; a number shorter than that is its own head
    lengths = sorted(r[0] for r in plan.select(F.length("_prefix")).distinct().collect())
    longest = lengths[-1] if lengths else 0
    heads = records.select(F.substring(number, 1, longest).alias("_head")).where("_head IS NOT NULL").distinct()
    tried = heads.withColumn("_length", F.explode(F.array(*[F.lit(n) for n in lengths]).cast("array<int>")))
    tried = tried.where(F.length("_head") >= F.col("_length"))
    tried = tried.withColumn("_prefix", F.col("_head").substr(F.lit(1), F.col("_length")))
    found = tried.join(plan, "_prefix").groupBy("_head").agg(F.max_by("_value", "_length").alias(name))
    head = F.substring(F.col(number), 1, longest)
    return records.join(found, head == F.col("_head"), "left").drop("_head")


def merged_periods(periods: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Periods [start, end) of each key with overlaps merged; an open end is NULL, an empty period goes."""
    far = F.lit("9999-12-31").cast("timestamp")
    rows = periods.select(F.col(key).alias("_key"), F.col(start).alias("_from"), F.coalesce(F.col(end), far).alias("_to"))
    rows = rows.where(F.col("_from") < F.col("_to"))
    before = Window.partitionBy("_key").orderBy("_from", "_to").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.max("_to").over(before)
    begins = rows.withColumn("_new", (opened.isNull() | (F.col("_from") > opened)).cast("int"))
    run = Window.partitionBy("_key").orderBy("_from", "_to").rowsBetween(Window.unboundedPreceding, 0)
    runs = begins.withColumn("_run", F.sum("_new").over(run))
    return runs.groupBy("_key", "_run").agg(F.min("_from").alias("_from"), F.max("_to").alias("_to")).drop("_run")


def _bin(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BIN_DAYS).cast("int")


def active_at(
    records: DataFrame, key: str, at: str, periods: DataFrame, name: str, period_key: str | None = None,
    start: str = "valid_from", end: str = "valid_to",
) -> DataFrame:
    """``records`` with ``name``: true if a period of ``key`` holds the time ``at``, else false; NULL if either is NULL.

    Bins end with the records' last day, so that an open period needs no more of them.
    """
    spans = merged_periods(periods, period_key or key, start, end)
    seen = records.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()
    low, high = (F.lit(v).cast("timestamp") for v in seen)
    spans = spans.where((F.col("_from") <= high) & (F.col("_to") > low))
    bins = F.sequence(_bin(F.to_date(F.greatest("_from", low))), _bin(F.to_date(F.least("_to", high))))
    spans = spans.withColumn("_bin", F.explode(bins))
    on = (
        (F.col(key) == F.col("_key"))
        & (_bin(F.to_date(F.col(at))) == F.col("_bin"))
        & (F.col(at) >= F.col("_from"))
        & (F.col(at) < F.col("_to"))
    )
    hit = records.join(spans, on, "left")
    known = F.col(key).isNotNull() & F.col(at).isNotNull()
    return hit.withColumn(name, F.when(known, F.col("_key").isNotNull())).drop("_key", "_bin", "_from", "_to")


@dataclass(frozen=True)
class PartnerCheck:
    """Reject a roaming record whose ``number`` lies in no partner's range."""

    ranges: DataFrame
    number: str = "other_party_msisdn"
    rule_id: str = "DQ_X05"
    reason: str = "UNKNOWN_ROAMING_PARTNER"
    flag: str = "_no_partner"

    def rule(self) -> Rule:
        return Rule(self.rule_id, self.reason, lambda: F.col(self.flag))

    def apply(self, typed: DataFrame) -> DataFrame:
        found = match_prefix(typed, self.number, self.ranges, "prefix", "partner", "_partner")
        return found.withColumn(self.flag, F.col("roaming_flag_bool") & F.col("_partner").isNull()).drop("_partner")


@dataclass(frozen=True)
class ValidityCheck:
    """Reject a record whose ``column`` was not in service at the event's time."""

    periods: DataFrame
    column: str = "cell_id"
    rule_id: str = "DQ_X06"
    reason: str = "CELL_NOT_IN_SERVICE"

    @property
    def flag(self) -> str:
        return f"_out_of_service_{self.column}"

    def rule(self) -> Rule:
        return Rule(self.rule_id, self.reason, lambda: F.col(self.flag))

    def apply(self, typed: DataFrame) -> DataFrame:
        return active_at(typed, self.column, "event_ts", self.periods, "_active").withColumn(
            self.flag, ~F.col("_active")
        ).drop("_active")

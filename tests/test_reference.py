"""Longest prefix and validity joins against plain Python."""

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import SF
from helpers import rows
from meterflow.operators import quality, reference
from meterflow.plans.layerset import LayerSet
from meterflow.sources import fixture


def test_longest_prefix(spark):
    rng = random.Random(2)
    plan = [("".join(rng.choice("012") for _ in range(rng.randint(1, 6))), f"P{i}") for i in range(60)] + [("01", "A"), ("01", "B"), ("", "E")]
    nums = ["".join(rng.choice("0123") for _ in range(rng.randint(0, 9))) for _ in range(800)] + [None, "", "01", "0" * 40]
    records = spark.createDataFrame([(i, n, "keep") for i, n in enumerate(nums)], "id long, number string, _value string")
    ranges = spark.createDataFrame(plan, "prefix string, partner string")
    got = reference.match_prefix(records, "number", ranges, "prefix", "partner", "partner").collect()
    best = {}
    for prefix, partner in plan:
        if prefix:
            best[prefix] = min(partner, best.get(prefix, partner))
    want = {}
    for i, n in enumerate(nums):
        hits = [p for p in best if n is not None and n.startswith(p)]
        want[i] = best[max(hits, key=len)] if hits else None
    assert {r.id: r.partner for r in got} == want and len(got) == len(nums)
    assert {r._value for r in got} == {"keep"}
    none = reference.match_prefix(records, "number", ranges.limit(0), "prefix", "partner", "partner")
    assert none.where("partner IS NOT NULL").count() == 0 and none.count() == len(nums)


def test_validity_periods(spark):
    rng = random.Random(3)
    day0 = dt.datetime(2024, 1, 1)

    def at():
        return day0 + dt.timedelta(hours=rng.randint(-3000, 3000))

    periods = []
    for _ in range(120):
        a, b = at(), rng.choice([at(), None])
        periods.append((f"C{rng.randint(0, 15)}", a, b))
    periods += [(None, day0, None), ("C1", day0, day0)]
    events = [(i, rng.choice([f"C{rng.randint(0, 17)}", None]), rng.choice([at(), None, periods[i % 120][1]])) for i in range(1500)]
    frame = spark.createDataFrame(events, "id long, cell string, ts timestamp")
    spans = spark.createDataFrame(periods, "cell string, valid_from timestamp, valid_to timestamp")
    got = {r.id: r.active for r in reference.active_at(frame, "cell", "ts", spans, "active").collect()}
    want = {}
    for i, cell, ts in events:
        known = cell is not None and ts is not None
        want[i] = any(c == cell and a <= ts and (b is None or ts < b) for c, a, b in periods) if known else None
    assert got == want
    assert reference.active_at(frame.limit(0), "cell", "ts", spans, "active").count() == 0
    assert reference.active_at(frame, "cell", "ts", spans.limit(0), "active").where("active").count() == 0


def test_checks_reject_only_what_they_should(spark):
    bronze = rows(
        spark,
        {"roaming_flag": "Y", "other_party_msisdn": "90549000000"},
        {"roaming_flag": "N", "other_party_msisdn": "90549000000"},
        {"roaming_flag": "Y", "other_party_msisdn": "90541550000"},
        {"roaming_flag": "Y", "other_party_msisdn": None},
        {"roaming_flag": None, "other_party_msisdn": "1"},
        {"cell_id": "CELL_101", "start_time_raw": "2024-01-16 11:59:59"},
        {"cell_id": "CELL_101", "start_time_raw": "2024-01-16 12:00:00"},
        {"cell_id": None},
    )
    cells = fixture.cell_periods(rows(spark, {"cell_id": "CELL_100"}, {"cell_id": "CELL_101"}))
    checks = [reference.PartnerCheck(fixture.partner_ranges(spark)), reference.ValidityCheck(cells)]
    tagged = quality.tag_quality(bronze, reference_checks=checks).orderBy("ingest_seq")
    assert [r.reject_reason for r in tagged.collect()] == [
        "UNKNOWN_ROAMING_PARTNER", None, None, "UNKNOWN_ROAMING_PARTNER", None, None, "CELL_NOT_IN_SERVICE", None,
    ]
    assert set(tagged.columns) == set(quality.TAGGED_COLUMNS)


def test_a_closed_cell_rejects_later_events_only(spark):
    ls = LayerSet.from_fixture(spark, SF["0.001"])
    check = reference.ValidityCheck(fixture.cell_periods(ls.bronze))
    late = quality.tag_quality(ls.bronze, reference_checks=[check]).where("reject_reason = 'CELL_NOT_IN_SERVICE'")
    number = F.substring("cell_id", 6, 9).cast("int")
    closed = late.where(number % 11 != 5)
    assert closed.count() > 20 and closed.where("event_ts < '2024-01-16 12:00:00'").count() == 0
    assert closed.where((number % 14 == 3) & (F.col("event_ts") >= "2024-01-20 06:30:00")).count() == 0

"""Quality rules on hand-made rows (one case per documented invalid value)."""

import pytest
from pyspark.sql import functions as F

from helpers import rows
from meterflow.operators import quality
from meterflow.operators.standardise import standardise


def reasons(spark, *overrides, **kw):
    df = quality.tag_quality(rows(spark, *overrides), **kw).orderBy("ingest_seq")
    return [r.reject_reason for r in df.select("ingest_seq", "reject_reason").collect()]


@pytest.mark.parametrize("raw", ["2026-99-99 25:61:00", "not_a_timestamp", None, "2024-01-01", "2024-01-01 10:15:00.5"])
def test_invalid_timestamp(spark, raw):
    assert reasons(spark, {"start_time_raw": raw}) == ["INVALID_TIMESTAMP"]


@pytest.mark.parametrize("raw", ["0", "-10", None, "abc", "1.5", "99999999999", ""])
def test_invalid_duration(spark, raw):
    assert reasons(spark, {"duration_raw": raw}) == ["INVALID_DURATION"]


@pytest.mark.parametrize("raw", ["UNKNOWN", "MMS", "INVALID_EVENT", "voice"])
def test_unknown_event_type(spark, raw):
    assert reasons(spark, {"event_type": raw}) == ["UNKNOWN_EVENT_TYPE"]


def test_null_event_type_passes_by_default_and_rejects_when_strict(spark):
    assert reasons(spark, {"event_type": None}) == [None]
    strict = quality.default_rules(null_event_type="reject")
    assert reasons(spark, {"event_type": None}, rules=strict) == ["UNKNOWN_EVENT_TYPE"]


@pytest.mark.parametrize("raw", [None, "", "  "])
def test_missing_msisdn(spark, raw):
    assert reasons(spark, {"subscriber_msisdn": raw}) == ["MISSING_MSISDN"]


def test_tab_is_not_blank(spark):
    assert reasons(spark, {"subscriber_msisdn": "\t"}) == [None]


@pytest.mark.parametrize("raw", ["-0.50", "-10.00", None, "abc"])
def test_negative_or_unparseable_charge(spark, raw):
    assert reasons(spark, {"charge_amount_raw": raw}) == ["NEGATIVE_CHARGE_AMOUNT"]


def test_zero_charge_is_valid(spark):
    assert reasons(spark, {"charge_amount_raw": "0"}) == [None]


def test_nan_charge_passes_unless_optional_rule(spark):
    assert reasons(spark, {"charge_amount_raw": "NaN"}) == [None]
    rules = quality.default_rules(extra=[quality.OPTIONAL_RULES["NON_FINITE_CHARGE"]])
    assert reasons(spark, {"charge_amount_raw": "NaN"}, rules=rules) == ["NON_FINITE_CHARGE"]


def test_priority_first_match_wins(spark):
    assert reasons(spark, {"subscriber_msisdn": None, "duration_raw": "0"}) == ["MISSING_MSISDN"]
    assert reasons(spark, {"start_time_raw": "x", "duration_raw": "0", "charge_amount_raw": "-1"}) == [
        "INVALID_TIMESTAMP"
    ]


def test_msisdn_format_rule(spark):
    rules = quality.default_rules(extra=[quality.OPTIONAL_RULES["INVALID_MSISDN_FORMAT"]])
    assert reasons(spark, {"subscriber_msisdn": "12345"}, {}, rules=rules) == ["INVALID_MSISDN_FORMAT", None]


def test_roaming_flag_three_valued(spark):
    df = standardise(rows(spark, {"roaming_flag": "Y"}, {"roaming_flag": "N"}, {"roaming_flag": "X"}, {"roaming_flag": None}))
    got = [r.roaming_flag_bool for r in df.orderBy("ingest_seq").collect()]
    assert got == [True, False, None, None]


def test_typed_columns(spark):
    r = standardise(rows(spark, {})).collect()[0]
    assert (r.event_hour, r.duration_sec, r.charge_amount) == (10, 60, 1.5)
    assert str(r.event_date) == "2024-01-01"
    assert len(r.record_hash) == 64


def test_record_hash_skips_nulls(spark):
    a = rows(spark, {"subscriber_msisdn": None, "other_party_msisdn": "X"})
    b = rows(spark, {"subscriber_msisdn": "X", "other_party_msisdn": None})
    ha = standardise(a).select("record_hash").first()[0]
    hb = standardise(b).select("record_hash").first()[0]
    assert ha == hb


def test_quality_status_and_split(spark):
    tagged = quality.tag_quality(rows(spark, {}, {"duration_raw": "0"}))
    assert sorted(r.quality_status for r in tagged.collect()) == ["REJECTED", "VALID"]
    clean = quality.clean_records(tagged)
    quarantine = quality.quarantine_records(tagged)
    assert clean.count() == 1 and quarantine.count() == 1
    assert clean.where(F.col("is_duplicate") | (F.col("quality_status") != "VALID")).count() == 0
    assert quarantine.first().reject_reason == "INVALID_DURATION"

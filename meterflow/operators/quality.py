"""Quality rules, tagging and the clean/quarantine split.

Rules are data: an ordered list of (id, reason, predicate). The reject reason of
a record is the reason of the first rule whose predicate is true; a NULL
predicate does not fire (so a NULL event type passes the membership rule unless
``null_event_type="reject"``).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow import fixed
from meterflow.functions.parsing import is_blank, wall_clock
from meterflow.operators.dedup import DEFAULT_KEY, DEFAULT_ORDER, flag_duplicates
from meterflow.operators.standardise import standardise
from meterflow import schemas
from meterflow.schemas import SILVER_CLEAN_COLUMNS, SILVER_QUARANTINE_COLUMNS


@dataclass(frozen=True)
class Rule:
    rule_id: str
    reason: str
    predicate: Callable[[], Column]  # true -> the record is rejected for ``reason``


def _event_type_unknown(null_is_unknown: bool) -> Callable[[], Column]:
    def pred() -> Column:
        unknown = ~F.col("event_type").isin(fixed.VALID_EVENT_TYPES)
        return (F.col("event_type").isNull() | unknown) if null_is_unknown else unknown

    return pred


_PREDICATES: dict[str, Callable[[], Column]] = {
    "MISSING_MSISDN": lambda: is_blank("subscriber_msisdn"),
    "INVALID_TIMESTAMP": lambda: F.col("event_ts").isNull(),
    "INVALID_DURATION": lambda: F.col("duration_sec").isNull() | (F.col("duration_sec") <= 0),
    "NEGATIVE_CHARGE_AMOUNT": lambda: F.col("charge_amount").isNull() | (F.col("charge_amount") < 0),
    "UNKNOWN_EVENT_TYPE": _event_type_unknown(False),
    "DUPLICATE_CDR_ID": lambda: F.col("is_duplicate"),
}

# Optional rules (documented needs, off by default).
MSISDN_PATTERN = r"^9053[0-9]{7}$"
OPTIONAL_RULES = {
    "NON_FINITE_CHARGE": Rule(
        "DQ_X01", "NON_FINITE_CHARGE", lambda: F.isnan("charge_amount") | (F.abs("charge_amount") == float("inf"))
    ),
    "INVALID_MSISDN_FORMAT": Rule(
        "DQ_X02", "INVALID_MSISDN_FORMAT", lambda: ~F.col("subscriber_msisdn").rlike(MSISDN_PATTERN)
    ),
}


@dataclass(frozen=True)
class ReferenceCheck:
    """Reject a record whose ``column`` is not NULL and not among ``reference[ref_column]``.

    Reference tables (cells, roaming partners) are dimension tables; their
    distinct keys are left-joined, and AQE broadcasts them when small.
    """

    rule_id: str
    reason: str
    column: str
    reference: DataFrame
    ref_column: str | None = None

    @property
    def flag(self) -> str:
        return f"_unknown_{self.column}"

    def rule(self) -> Rule:
        return Rule(self.rule_id, self.reason, lambda: F.col(self.flag))

    def apply(self, df: DataFrame) -> DataFrame:
        keys = self.reference.select(F.col(self.ref_column or self.column).alias("_ref_key")).distinct()
        hit = keys.withColumn("_ref_hit", F.lit(True))
        out = df.join(hit, df[self.column] == hit["_ref_key"], "left")
        unknown = F.col(self.column).isNotNull() & F.col("_ref_hit").isNull()
        return out.withColumn(self.flag, unknown).drop("_ref_key", "_ref_hit")


def default_rules(null_event_type: str = "pass", extra: list[Rule] | None = None) -> list[Rule]:
    """The six rules in priority order; ``extra`` rules go before the duplicate rule."""
    rules = []
    for rule_id, reason in fixed.QUALITY_RULES:
        pred = _PREDICATES[reason]
        if reason == "UNKNOWN_EVENT_TYPE" and null_event_type == "reject":
            pred = _event_type_unknown(True)
        rules.append(Rule(rule_id, reason, pred))
    if extra:
        rules = rules[:-1] + list(extra) + rules[-1:]
    return rules


def reject_reason(rules: list[Rule]) -> Column:
    """First-match CASE over the ordered rules; NULL when no rule fires."""
    expr = None
    for rule in rules:
        expr = (F.when if expr is None else expr.when)(rule.predicate(), F.lit(rule.reason))
    return expr


def tag_quality(
    bronze: DataFrame,
    rules: list[Rule] | None = None,
    as_of=None,
    key=DEFAULT_KEY,
    order=DEFAULT_ORDER,
    seen: DataFrame | None = None,
    reference_checks: list[ReferenceCheck] | None = None,
) -> DataFrame:
    """Typed bronze with ``is_duplicate``, ``reject_reason`` and ``quality_status``.

    Duplicates are ranked over all records, before the other rules, so a
    repeated key whose first copy is invalid has no clean record. ``seen``
    holds records of earlier loads (incremental runs): their keys count first.
    ``reference_checks`` add reference-data rules, ahead of the duplicate rule.
    """
    rules = rules or default_rules()
    checks = reference_checks or []
    if checks:
        rules = rules[:-1] + [c.rule() for c in checks] + rules[-1:]
    typed = standardise(bronze, as_of)
    for check in checks:
        typed = check.apply(typed)
    flagged = flag_duplicates(typed, key, order, seen=seen)
    reason = reject_reason(rules)
    out = flagged.withColumn("reject_reason", reason).withColumn(
        "quality_status",
        F.when(F.col("reject_reason").isNull(), F.lit(fixed.STATUS_VALID)).otherwise(F.lit(fixed.STATUS_REJECTED)),
    )
    return out.drop(*[c.flag for c in checks])


#: The reason of a line that no record could be read from; it comes before all rules.
MALFORMED = "MALFORMED_RECORD"


def tag_malformed(malformed: DataFrame, as_of=None) -> DataFrame:
    """Malformed lines as tagged records: rejected, with lineage and nothing else, never duplicates."""
    return standardise(malformed.select(*schemas.BRONZE_COLUMNS), as_of).withColumns(
        {
            "is_duplicate": F.lit(False),
            "reject_reason": F.lit(MALFORMED),
            "quality_status": F.lit(fixed.STATUS_REJECTED),
        }
    )


def clean_records(tagged: DataFrame) -> DataFrame:
    """Silver clean: VALID records in the 20-column contract."""
    return tagged.where(F.col("quality_status") == fixed.STATUS_VALID).select(
        *[F.col("roaming_flag_bool").alias(c) if c == "roaming_flag" else F.col(c) for c in SILVER_CLEAN_COLUMNS]
    )


def quarantine_records(tagged: DataFrame, as_of=None) -> DataFrame:
    """Silver quarantine: REJECTED records, raw strings and one reason each."""
    return tagged.where(F.col("quality_status") == fixed.STATUS_REJECTED).select(
        *SILVER_QUARANTINE_COLUMNS[:-1], wall_clock(as_of).alias("reject_ts")
    )


def duplicate_records(tagged: DataFrame) -> DataFrame:
    """Records flagged as duplicates (whatever their primary reason)."""
    return tagged.where(F.col("is_duplicate")).select("batch_id", "source_system", "source_file", "cdr_id", "is_duplicate")


TAGGED_COLUMNS = schemas.TAGGED_COLUMNS

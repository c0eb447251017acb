"""Table contracts of the seven layer tables.

Every table has a fixed schema and is read with it, so that types are never
inferred from folder names or from whatever rows a load happened to have.
Raw values stay strings.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, TS, I, L = T.StringType(), T.TimestampType(), T.IntegerType(), T.LongType()
D, X, B = T.DateType(), T.DoubleType(), T.BooleanType()

# --- fixed values: begin (names and order of the columns are the table contract)

BATCH_KEYS = ["batch_id", "source_system", "source_file"]

# Raw record as delivered by a mediation or partner system: 14 strings.
LANDING_SCHEMA = T.StructType(
    [
        T.StructField(name, S, True)
        for name in [
            "batch_id",
            "source_system",
            "source_file",
            "cdr_id",
            "subscriber_msisdn",
            "other_party_msisdn",
            "event_type",
            "start_time_raw",
            "duration_raw",
            "cell_id",
            "switch_id",
            "roaming_flag",
            "charge_amount_raw",
            "currency",
        ]
    ]
)

# Bronze = landing record + ingestion stamp + landing sequence. ``ingest_seq``
# is unique per landed record and is assigned once, when bronze is written; it
# is the last tie-break of the duplicate order.
BRONZE_SCHEMA = T.StructType(
    LANDING_SCHEMA.fields + [T.StructField("ingestion_ts", TS, True), T.StructField("ingest_seq", L, True)]
)
BRONZE_COLUMNS = [f.name for f in BRONZE_SCHEMA.fields]

METADATA_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", S, True),
        T.StructField("source_system", S, True),
        T.StructField("source_file", S, True),
        T.StructField("arrival_ts", TS, True),
        T.StructField("expected_record_count", I, True),
        T.StructField("actual_generated_count", I, True),
        T.StructField("bronze_count", I, True),
        T.StructField("status", S, True),
        T.StructField("created_ts", TS, True),
    ]
)
METADATA_COLUMNS = [f.name for f in METADATA_SCHEMA.fields]

# Every bronze record with its typed values, duplicate flag and verdict.
TAGGED_COLUMNS = BRONZE_COLUMNS + [
    "event_ts",
    "event_date",
    "event_hour",
    "duration_sec",
    "charge_amount",
    "roaming_flag_bool",
    "record_hash",
    "processed_ts",
    "is_duplicate",
    "reject_reason",
    "quality_status",
]

SILVER_CLEAN_COLUMNS = [
    "batch_id",
    "source_system",
    "source_file",
    "cdr_id",
    "subscriber_msisdn",
    "other_party_msisdn",
    "event_type",
    "event_ts",
    "event_date",
    "event_hour",
    "duration_sec",
    "cell_id",
    "switch_id",
    "roaming_flag",
    "charge_amount",
    "currency",
    "record_hash",
    "quality_status",
    "is_duplicate",
    "processed_ts",
]

SILVER_QUARANTINE_COLUMNS = [
    "batch_id",
    "source_system",
    "source_file",
    "cdr_id",
    "subscriber_msisdn",
    "event_type",
    "start_time_raw",
    "duration_raw",
    "charge_amount_raw",
    "reject_reason",
    "reject_ts",
]

GOLD_HOURLY_COLUMNS = [
    "usage_date",
    "usage_hour",
    "source_system",
    "event_type",
    "total_events",
    "total_duration_sec",
    "total_charge",
    "unique_subscribers",
    "roaming_events",
]

GOLD_SUBSCRIBER_DAILY_COLUMNS = [
    "usage_date",
    "subscriber_msisdn",
    "voice_call_count",
    "sms_count",
    "data_session_count",
    "roaming_event_count",
    "total_duration_sec",
    "total_charge",
]

RECONCILIATION_COLUMNS = [
    "batch_id",
    "source_system",
    "source_file",
    "expected_record_count",
    "bronze_record_count",
    "silver_valid_count",
    "quarantine_count",
    "duplicate_count",
    "reject_rate",
    "reconciliation_status",
    "reconciliation_ts",
]

# --- fixed values: end

# Types of the columns that bronze and the ingestion log don't have.
_DERIVED = {
    "event_ts": TS,
    "event_date": D,
    "event_hour": I,
    "duration_sec": I,
    "charge_amount": X,
    "roaming_flag_bool": B,
    "record_hash": S,
    "processed_ts": TS,
    "is_duplicate": B,
    "reject_reason": S,
    "quality_status": S,
    "reject_ts": TS,
    "usage_date": D,
    "usage_hour": I,
    "total_charge": X,
    "reject_rate": X,
    "reconciliation_status": S,
    "reconciliation_ts": TS,
}
_RAW = {f.name: f.dataType for f in [*BRONZE_SCHEMA.fields, *METADATA_SCHEMA.fields]}


def _schema(columns: list[str], **own: T.DataType) -> T.StructType:
    """The columns with their types; counts and totals that are not listed are bigint."""
    return T.StructType([T.StructField(c, own.get(c, _RAW.get(c, _DERIVED.get(c, L))), True) for c in columns])


TABLE_SCHEMAS = {
    "metadata_ingestion_log": METADATA_SCHEMA,
    "bronze_cdr_raw": BRONZE_SCHEMA,
    "silver_cdr_tagged": _schema(TAGGED_COLUMNS),
    "silver_cdr_clean": _schema(SILVER_CLEAN_COLUMNS, roaming_flag=B),
    "silver_cdr_quarantine": _schema(SILVER_QUARANTINE_COLUMNS),
    "gold_cdr_usage_hourly": _schema(GOLD_HOURLY_COLUMNS),
    "gold_subscriber_usage_daily": _schema(GOLD_SUBSCRIBER_DAILY_COLUMNS),
    "gold_reconciliation_daily": _schema(RECONCILIATION_COLUMNS),
    # Beside the layers: malformed lines (all but lineage is in the raw line), and all reconciliation runs.
    "bronze_cdr_malformed": T.StructType([*BRONZE_SCHEMA.fields, T.StructField("raw_line", S)]),
    "reconciliation_history": _schema([*RECONCILIATION_COLUMNS, "run_id"], run_id=S),
    # Bloom filters of each landed batch's record keys (operators.keyfilter).
    "bronze_key_filters": T.StructType(
        [T.StructField("batch_id", S), T.StructField("level", I), T.StructField("block", L), T.StructField("bitmap", T.BinaryType())]
    ),
}

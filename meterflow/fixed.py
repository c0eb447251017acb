"""Fixed values.

These values must equal the ones of the system this library re-implements,
or results differ. They are stated here once, in their natural order, and
imported everywhere else.
"""

# --- fixed values: begin -------------------------------------------------

# Source systems and the file-name prefix each one uses.
SOURCE_SYSTEMS = ["MEDIATION_A", "MEDIATION_B", "ROAMING_PARTNER"]
SOURCE_FILE_PREFIXES = {
    "MEDIATION_A": "cdr_mediation_a",
    "MEDIATION_B": "cdr_mediation_b",
    "ROAMING_PARTNER": "cdr_roaming_partner",
}

# Raw event time format (Spark datetime pattern) and its DuckDB twin.
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
EVENT_TIME_FORMAT_STRPTIME = "%Y-%m-%d %H:%M:%S"

# Accepted event types; the check is case-sensitive.
VALID_EVENT_TYPES = ["VOICE", "SMS", "DATA", "ROAMING"]

# Roaming flag text values.
ROAMING_YES = "Y"
ROAMING_NO = "N"

# Record hash: SHA-256 (hex) over these columns joined by the separator.
RECORD_HASH_SEPARATOR = "||"
RECORD_HASH_COLUMNS = ["source_system", "cdr_id", "subscriber_msisdn", "other_party_msisdn", "start_time_raw"]

# Quality rules: (rule id, reject reason), in priority order; first match wins.
QUALITY_RULES = [
    ("DQ_004", "MISSING_MSISDN"),
    ("DQ_001", "INVALID_TIMESTAMP"),
    ("DQ_002", "INVALID_DURATION"),
    ("DQ_005", "NEGATIVE_CHARGE_AMOUNT"),
    ("DQ_003", "UNKNOWN_EVENT_TYPE"),
    ("DQ_006", "DUPLICATE_CDR_ID"),
]

# Quality status labels.
STATUS_VALID = "VALID"
STATUS_REJECTED = "REJECTED"

# Reconciliation.
RECONCILED = "RECONCILED"
WARNING = "WARNING"
FAILED = "FAILED"
REJECT_RATE_WARNING_THRESHOLD = 0.10  # compared with the rounded rate, strictly greater
REJECT_RATE_SCALE = 4
MONEY_SCALE = 2
COUNT_MATCHED = "MATCHED"
COUNT_NOT_MATCHED = "NOT_MATCHED"

# Ingestion log status of a landed batch.
BATCH_STATUS_GENERATED = "GENERATED"

# Report labels.
LAYER_COUNT_LABELS = [
    "Bronze Raw Records",
    "Silver Clean Records",
    "Silver Quarantine Records",
    "Gold Hourly Usage Rows",
    "Gold Subscriber Daily Rows",
]
GOLD_LAYER_COUNT_LABELS = ["Silver Clean Records", "Gold Hourly Rows", "Gold Subscriber Daily Rows"]
RECORD_STATUS_VALID = "VALID"
RECORD_STATUS_QUARANTINED = "QUARANTINED"

# Report sizes.
TOP_SUBSCRIBER_DAYS = 20
TOP_SUBSCRIBERS = 10
HOURLY_PREVIEW_ROWS = 20
QUARANTINE_SAMPLE_ROWS = 100

# --- fixed values: end ---------------------------------------------------

DUPLICATE_REASON = QUALITY_RULES[-1][1]
RULE_REASONS = [reason for _, reason in QUALITY_RULES]

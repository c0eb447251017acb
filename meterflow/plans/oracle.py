"""DuckDB twins of the registered queries, for the correctness check.

Only the driver's tables exist on the DuckDB side, so every statement repeats
the fixture projection as a chain of CTEs, then states the query on top. The
fragments below are composed per query; casts line DuckDB's types up with
Spark's (``hour`` and integer sums are wider in DuckDB).
"""

from __future__ import annotations

import re

from meterflow import fixed
from meterflow.sources import fixture

AS_OF_SQL = f"TIMESTAMP '{fixture.AS_OF:%Y-%m-%d %H:%M:%S}'"
# Written out, so that a wrong value in the package does not pass on both sides.
_VALID_TYPES = "'VOICE', 'SMS', 'DATA', 'ROAMING'"

_BRONZE_COLS = (
    "batch_id, source_system, source_file, cdr_id, subscriber_msisdn, other_party_msisdn, event_type, "
    "start_time_raw, duration_raw, cell_id, switch_id, roaming_flag, charge_amount_raw, currency"
)

_RECORDS = ",\n    ".join(f"{expr} AS {name}" for name, expr in fixture.RECORD_COLUMNS)

BRONZE = f"""
ev AS (SELECT {", ".join(fixture.EVENT_COLUMNS)} FROM events),
proj AS (
  SELECT e,
    {_RECORDS}
  FROM ev
),
bronze AS (
  SELECT {_BRONZE_COLS}, ingestion_ts, e * 2 AS ingest_seq FROM proj
  UNION ALL
  SELECT {_BRONZE_COLS}, ingestion_ts + INTERVAL {fixture.COPY_DELAY_SECONDS} SECOND AS ingestion_ts, e * 2 + 1 AS ingest_seq
  FROM proj WHERE e % {fixture.COPY_EVERY} = {fixture.COPY_REMAINDER}
)"""

TAGGED = (
    BRONZE
    + f""",
typed AS (
  SELECT *,
    CAST(event_ts AS DATE) AS event_date,
    CAST(hour(event_ts) AS INTEGER) AS event_hour
  FROM (
    SELECT *,
      try_strptime(start_time_raw, '{fixed.EVENT_TIME_FORMAT_STRPTIME}') AS event_ts,
      TRY_CAST(duration_raw AS INTEGER) AS duration_sec,
      TRY_CAST(charge_amount_raw AS DOUBLE) AS charge_amount,
      CASE roaming_flag WHEN 'Y' THEN true WHEN 'N' THEN false END AS roaming_flag_bool,
      sha256(concat_ws('||', source_system, cdr_id, subscriber_msisdn, other_party_msisdn, start_time_raw))
        AS record_hash,
      {AS_OF_SQL} AS processed_ts,
      row_number() OVER (PARTITION BY source_system, cdr_id
                         ORDER BY ingestion_ts, batch_id, source_file, ingest_seq) > 1 AS is_duplicate
    FROM bronze)
),
reasoned AS (
  SELECT *,
    CASE
      WHEN subscriber_msisdn IS NULL OR trim(subscriber_msisdn) = '' THEN 'MISSING_MSISDN'
      WHEN event_ts IS NULL THEN 'INVALID_TIMESTAMP'
      WHEN duration_sec IS NULL OR duration_sec <= 0 THEN 'INVALID_DURATION'
      WHEN charge_amount IS NULL OR charge_amount < 0 THEN 'NEGATIVE_CHARGE_AMOUNT'
      WHEN NOT (event_type IN ({_VALID_TYPES})) THEN 'UNKNOWN_EVENT_TYPE'
      WHEN is_duplicate THEN 'DUPLICATE_CDR_ID'
    END AS reject_reason
  FROM typed
),
tagged AS (
  SELECT *, CASE WHEN reject_reason IS NULL THEN 'VALID' ELSE 'REJECTED' END AS quality_status FROM reasoned
)"""
)

SILVER = (
    TAGGED
    + f""",
clean AS (
  SELECT batch_id, source_system, source_file, cdr_id, subscriber_msisdn, other_party_msisdn, event_type,
         event_ts, event_date, event_hour, duration_sec, cell_id, switch_id, roaming_flag_bool AS roaming_flag,
         charge_amount, currency, record_hash, quality_status, is_duplicate, processed_ts
  FROM tagged WHERE quality_status = 'VALID'
),
quarantine AS (
  SELECT batch_id, source_system, source_file, cdr_id, subscriber_msisdn, event_type, start_time_raw,
         duration_raw, charge_amount_raw, reject_reason, {AS_OF_SQL} AS reject_ts
  FROM tagged WHERE quality_status = 'REJECTED'
)"""
)

GOLD = (
    SILVER
    + """,
hourly AS (
  SELECT event_date AS usage_date, event_hour AS usage_hour, source_system, event_type,
         count(*) AS total_events,
         CAST(sum(duration_sec) AS BIGINT) AS total_duration_sec,
         round(sum(charge_amount), 2) AS total_charge,
         count(DISTINCT subscriber_msisdn) AS unique_subscribers,
         CAST(sum(CASE WHEN roaming_flag THEN 1 ELSE 0 END) AS BIGINT) AS roaming_events
  FROM clean GROUP BY event_date, event_hour, source_system, event_type
),
daily AS (
  SELECT event_date AS usage_date, subscriber_msisdn,
         CAST(sum(CASE WHEN event_type = 'VOICE' THEN 1 ELSE 0 END) AS BIGINT) AS voice_call_count,
         CAST(sum(CASE WHEN event_type = 'SMS' THEN 1 ELSE 0 END) AS BIGINT) AS sms_count,
         CAST(sum(CASE WHEN event_type = 'DATA' THEN 1 ELSE 0 END) AS BIGINT) AS data_session_count,
         CAST(sum(CASE WHEN event_type = 'ROAMING' THEN 1 ELSE 0 END) AS BIGINT) AS roaming_event_count,
         CAST(sum(duration_sec) AS BIGINT) AS total_duration_sec,
         round(sum(charge_amount), 2) AS total_charge
  FROM clean GROUP BY event_date, subscriber_msisdn
)"""
)

_METADATA = f""",
bcounts AS (
  SELECT batch_id, source_system, source_file, count(*) AS n FROM bronze GROUP BY batch_id, source_system, source_file
),
control AS (
  SELECT batch_id, source_system, source_file,
         strptime(substr(batch_id, 7, 8), '%Y%m%d') AS arrival_ts,
         CAST(n + CASE WHEN substr(batch_id, 7, 8) = '{fixture.SHORT_BATCH_DAY}' THEN {fixture.SHORT_BY} ELSE 0 END
              AS INTEGER) AS expected_record_count
  FROM bcounts WHERE batch_id <> '{fixture.UNREGISTERED_BATCH}'
  UNION ALL
  SELECT 'BATCH_{fixture.EMPTY_BATCH_DAY}_000000_MEDIATION_A', 'MEDIATION_A',
         'cdr_mediation_a_{fixture.EMPTY_BATCH_DAY}_000000.csv',
         strptime('{fixture.EMPTY_BATCH_DAY}', '%Y%m%d'), CAST({fixture.EMPTY_BATCH_EXPECTED} AS INTEGER)
),
metadata AS (
  SELECT c.batch_id, c.source_system, c.source_file, c.arrival_ts, c.expected_record_count,
         CAST(coalesce(b.n, 0) AS INTEGER) AS actual_generated_count,
         CAST(coalesce(b.n, 0) AS INTEGER) AS bronze_count,
         'GENERATED' AS status, {AS_OF_SQL} AS created_ts
  FROM control c LEFT JOIN bcounts b
    ON c.batch_id = b.batch_id AND c.source_system = b.source_system AND c.source_file = b.source_file
)"""

METADATA = BRONZE + _METADATA

_RECON = f""",
scounts AS (
  SELECT batch_id, source_system, source_file, count(*) AS n FROM clean GROUP BY batch_id, source_system, source_file
),
qcounts AS (
  SELECT batch_id, source_system, source_file, count(*) AS n,
         CAST(sum(CASE WHEN reject_reason = 'DUPLICATE_CDR_ID' THEN 1 ELSE 0 END) AS BIGINT) AS dups
  FROM quarantine GROUP BY batch_id, source_system, source_file
),
recon_counts AS (
  SELECT m.batch_id, m.source_system, m.source_file, m.expected_record_count,
         coalesce(b.n, 0) AS bronze_record_count, coalesce(s.n, 0) AS silver_valid_count,
         coalesce(q.n, 0) AS quarantine_count, coalesce(q.dups, 0) AS duplicate_count
  FROM metadata m
  LEFT JOIN bcounts b ON m.batch_id = b.batch_id AND m.source_system = b.source_system AND m.source_file = b.source_file
  LEFT JOIN scounts s ON m.batch_id = s.batch_id AND m.source_system = s.source_system AND m.source_file = s.source_file
  LEFT JOIN qcounts q ON m.batch_id = q.batch_id AND m.source_system = q.source_system AND m.source_file = q.source_file
),
recon_rated AS (
  SELECT *, round(quarantine_count / NULLIF(bronze_record_count, 0), 4) AS reject_rate FROM recon_counts
),
recon AS (
  SELECT batch_id, source_system, source_file, expected_record_count, bronze_record_count, silver_valid_count,
         quarantine_count, duplicate_count, reject_rate,
         CASE WHEN expected_record_count <> bronze_record_count
                OR bronze_record_count <> silver_valid_count + quarantine_count THEN 'FAILED'
              WHEN reject_rate > 0.10 THEN 'WARNING'
              ELSE 'RECONCILED' END AS reconciliation_status,
         {AS_OF_SQL} AS reconciliation_ts
  FROM recon_rated
)"""

RECON = GOLD + _METADATA + _RECON


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


_REJECT_RATE_BY_SOURCE = """
SELECT source_system,
       CAST(sum(bronze_record_count) AS BIGINT) AS bronze_record_count,
       CAST(sum(silver_valid_count) AS BIGINT) AS silver_valid_count,
       CAST(sum(quarantine_count) AS BIGINT) AS quarantine_count,{dups}
       round(sum(quarantine_count) / NULLIF(sum(bronze_record_count), 0), 4) AS reject_rate
FROM recon GROUP BY source_system ORDER BY reject_rate DESC, source_system"""

# One filtered aggregate, so that it also checks the joined form independently of its join.
_QUALITY_BY_SOURCE = """
SELECT source_system,
       count(*) FILTER (quality_status = 'VALID') AS clean_count,
       count(*) FILTER (quality_status = 'REJECTED') AS quarantine_count,
       count(*) AS total_count,
       round(avg(CASE quality_status WHEN 'REJECTED' THEN 1.0 ELSE 0.0 END), 4) AS quarantine_rate
FROM tagged GROUP BY source_system ORDER BY quarantine_rate DESC, source_system"""

_REASONS = "MISSING_MSISDN INVALID_TIMESTAMP INVALID_DURATION NEGATIVE_CHARGE_AMOUNT UNKNOWN_EVENT_TYPE DUPLICATE_CDR_ID".split()
_REASON_COUNTS = ",\n".join(
    f"       CAST(sum(CASE WHEN reject_reason = '{r}' THEN 1 ELSE 0 END) AS BIGINT) AS {r.lower()}_count" for r in _REASONS
)


def _row_counts(label_col: str, value_col: str, labels: list[str], tables: list[str]) -> str:
    """One row per table: its label and its number of rows."""
    counts = ", ".join(f"('{label}', (SELECT count(*) FROM {table}))" for label, table in zip(labels, tables))
    return f"SELECT {label_col}, CAST({value_col} AS BIGINT) AS {value_col} FROM (VALUES {counts}) AS v({label_col}, {value_col})"


ORACLE_SQL: dict[str, str] = {
    # sources
    "bronze_raw": with_(BRONZE, "SELECT * FROM bronze"),
    "batch_metadata_log": with_(METADATA, "SELECT * FROM metadata ORDER BY source_system, batch_id"),
    "bronze_counts_by_file": with_(
        BRONZE,
        "SELECT source_system, source_file, count(*) AS bronze_record_count FROM bronze "
        "GROUP BY source_system, source_file ORDER BY source_system, source_file",
    ),
    # silver
    "silver_typed": with_(
        TAGGED,
        "SELECT batch_id, source_system, source_file, cdr_id, subscriber_msisdn, other_party_msisdn, event_type, "
        "start_time_raw, duration_raw, cell_id, switch_id, roaming_flag, charge_amount_raw, currency, ingestion_ts, "
        "ingest_seq, event_ts, event_date, event_hour, duration_sec, charge_amount, roaming_flag_bool, record_hash, "
        "processed_ts FROM typed",
    ),
    "duplicate_flagged": with_(
        TAGGED,
        "SELECT batch_id, source_system, source_file, cdr_id, ingestion_ts, ingest_seq, is_duplicate FROM typed",
    ),
    "quality_tagged": with_(TAGGED, "SELECT * FROM tagged"),
    "silver_clean": with_(SILVER, "SELECT * FROM clean"),
    "silver_quarantine": with_(SILVER, "SELECT * FROM quarantine"),
    "duplicate_records": with_(
        TAGGED, "SELECT batch_id, source_system, source_file, cdr_id, is_duplicate FROM tagged WHERE is_duplicate"
    ),
    "quality_status_reason_counts": with_(
        TAGGED,
        "SELECT quality_status, reject_reason, count(*) AS count FROM tagged "
        "GROUP BY quality_status, reject_reason ORDER BY quality_status, reject_reason",
    ),
    "reject_reasons": with_(
        SILVER,
        "SELECT reject_reason, count(*) AS rejected_record_count FROM quarantine GROUP BY reject_reason "
        "ORDER BY rejected_record_count DESC, reject_reason",
    ),
    "source_status_counts": with_(
        TAGGED,
        "SELECT source_system, quality_status, count(*) AS count FROM tagged "
        "GROUP BY source_system, quality_status ORDER BY source_system, quality_status",
    ),
    "layer_count_check": with_(
        SILVER,
        "SELECT b.n AS bronze_count, c.n AS silver_clean_count, q.n AS silver_quarantine_count, "
        "b.n = c.n + q.n AS is_balanced FROM (SELECT count(*) AS n FROM bronze) b, "
        "(SELECT count(*) AS n FROM clean) c, (SELECT count(*) AS n FROM quarantine) q",
    ),
    "quality_metrics": with_(
        TAGGED,
        "SELECT count(*) AS total_bronze_records, CAST(sum(CASE WHEN quality_status = 'VALID' THEN 1 ELSE 0 END) AS BIGINT) AS valid_records, "
        "CAST(sum(CASE WHEN quality_status = 'REJECTED' THEN 1 ELSE 0 END) AS BIGINT) AS quarantined_records, CAST(sum(CASE WHEN is_duplicate THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_records, "
        "round(CAST(sum(CASE WHEN quality_status = 'REJECTED' THEN 1 ELSE 0 END) AS BIGINT) / count(*), 4) AS reject_rate,\n"
        + _REASON_COUNTS
        + "\nFROM tagged",
    ),
    # gold
    "gold_usage_hourly": with_(
        GOLD, "SELECT * FROM hourly ORDER BY usage_date, usage_hour, source_system, event_type"
    ),
    "gold_usage_hourly_first20": with_(
        GOLD, "SELECT * FROM hourly ORDER BY usage_date, usage_hour, source_system, event_type LIMIT 20"
    ),
    "gold_subscriber_daily": with_(GOLD, "SELECT * FROM daily"),
    "top_subscriber_days": with_(
        GOLD, "SELECT * FROM daily ORDER BY total_charge DESC, subscriber_msisdn, usage_date LIMIT 20"
    ),
    "gold_layer_counts": with_(
        GOLD, _row_counts("metric", "value", fixed.GOLD_LAYER_COUNT_LABELS, ["clean", "hourly", "daily"])
    ),
    # reconciliation
    "bronze_counts_by_batch": with_(
        BRONZE,
        "SELECT batch_id, source_system, source_file, count(*) AS bronze_record_count FROM bronze "
        "GROUP BY batch_id, source_system, source_file",
    ),
    "silver_counts_by_batch": with_(
        SILVER,
        "SELECT batch_id, source_system, source_file, count(*) AS silver_valid_count FROM clean "
        "GROUP BY batch_id, source_system, source_file",
    ),
    "quarantine_counts_by_batch": with_(
        SILVER,
        "SELECT batch_id, source_system, source_file, count(*) AS quarantine_count, "
        "CAST(sum(CASE WHEN reject_reason = 'DUPLICATE_CDR_ID' THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_count FROM quarantine "
        "GROUP BY batch_id, source_system, source_file",
    ),
    "reconciliation": with_(RECON, "SELECT * FROM recon ORDER BY source_system, batch_id"),
    "count_match_check": with_(
        RECON,
        "SELECT batch_id, source_system, expected_record_count, bronze_record_count, silver_valid_count, "
        "quarantine_count, silver_valid_count + quarantine_count AS silver_plus_quarantine, "
        "bronze_record_count = silver_valid_count + quarantine_count AS is_count_matched, reject_rate, "
        "reconciliation_status FROM recon ORDER BY source_system, batch_id",
    ),
    "count_match_labels": with_(
        RECON,
        "SELECT batch_id, source_system, expected_record_count, bronze_record_count, silver_valid_count, "
        "quarantine_count, silver_valid_count + quarantine_count AS silver_plus_quarantine, "
        "CASE WHEN bronze_record_count = silver_valid_count + quarantine_count THEN 'MATCHED' ELSE 'NOT_MATCHED' END "
        "AS bronze_vs_silver_quarantine_check, reconciliation_status FROM recon ORDER BY source_system, batch_id",
    ),
    "recon_exceptions": with_(
        RECON,
        "SELECT * FROM recon WHERE reconciliation_status IN ('FAILED', 'WARNING') "
        "ORDER BY reconciliation_status, source_system, batch_id",
    ),
    "recon_by_batch": with_(
        RECON,
        "SELECT batch_id, source_system, source_file, expected_record_count, bronze_record_count, "
        "silver_valid_count, quarantine_count, duplicate_count, reject_rate, reconciliation_status "
        "FROM recon ORDER BY source_system, batch_id",
    ),
    "recon_status_summary": with_(
        RECON,
        "SELECT reconciliation_status, count(*) AS batch_count, round(avg(reject_rate), 4) AS avg_reject_rate "
        "FROM recon GROUP BY reconciliation_status ORDER BY reconciliation_status",
    ),
    "reject_rate_by_source": with_(RECON, _REJECT_RATE_BY_SOURCE.format(dups="")),
    "reject_rate_by_source_dups": with_(
        RECON, _REJECT_RATE_BY_SOURCE.format(dups="\n       CAST(sum(duplicate_count) AS BIGINT) AS duplicate_count,")
    ),
    "unregistered_batches": with_(
        METADATA,
        "SELECT b.batch_id, b.source_system, b.source_file, b.n AS bronze_record_count FROM bcounts b "
        "WHERE NOT EXISTS (SELECT 1 FROM metadata m WHERE m.batch_id = b.batch_id "
        "AND m.source_system = b.source_system AND m.source_file = b.source_file)",
    ),
    # dashboard
    "layer_counts": with_(
        GOLD, _row_counts("metric", "value", fixed.LAYER_COUNT_LABELS, ["bronze", "clean", "quarantine", "hourly", "daily"])
    ),
    "valid_vs_quarantined": with_(
        SILVER, _row_counts("record_status", "record_count", ["VALID", "QUARANTINED"], ["clean", "quarantine"])
    ),
    "event_type_distribution": with_(
        GOLD,
        "SELECT event_type, CAST(sum(total_events) AS BIGINT) AS total_events, "
        "round(sum(total_charge), 2) AS total_charge, CAST(sum(total_duration_sec) AS BIGINT) AS total_duration_sec "
        "FROM hourly GROUP BY event_type ORDER BY total_events DESC, event_type",
    ),
    "hourly_usage_trend": with_(
        GOLD,
        "SELECT usage_hour, CAST(sum(total_events) AS BIGINT) AS total_events, "
        "CAST(sum(total_duration_sec) AS BIGINT) AS total_duration_sec, round(sum(total_charge), 2) AS total_charge "
        "FROM hourly GROUP BY usage_hour ORDER BY usage_hour",
    ),
    "top_subscribers": with_(
        GOLD,
        "SELECT subscriber_msisdn, CAST(sum(voice_call_count) AS BIGINT) AS voice_call_count, "
        "CAST(sum(sms_count) AS BIGINT) AS sms_count, CAST(sum(data_session_count) AS BIGINT) AS data_session_count, "
        "CAST(sum(roaming_event_count) AS BIGINT) AS roaming_event_count, "
        "CAST(sum(total_duration_sec) AS BIGINT) AS total_duration_sec, round(sum(total_charge), 2) AS total_charge "
        "FROM daily GROUP BY subscriber_msisdn ORDER BY total_charge DESC, subscriber_msisdn LIMIT 10",
    ),
    "source_usage_summary": with_(
        GOLD,
        "SELECT source_system, CAST(sum(total_events) AS BIGINT) AS total_events, "
        "CAST(sum(total_duration_sec) AS BIGINT) AS total_duration_sec, round(sum(total_charge), 2) AS total_charge, "
        "CAST(sum(unique_subscribers) AS BIGINT) AS unique_subscribers_sum, "
        "CAST(sum(roaming_events) AS BIGINT) AS roaming_events "
        "FROM hourly GROUP BY source_system ORDER BY total_events DESC, source_system",
    ),
    "source_unique_subscribers": with_(
        SILVER,
        "SELECT source_system, count(DISTINCT subscriber_msisdn) AS unique_subscribers FROM clean "
        "GROUP BY source_system",
    ),
    "daily_usage_summary": with_(
        GOLD,
        "SELECT usage_date, CAST(sum(total_events) AS BIGINT) AS total_events, "
        "CAST(sum(total_duration_sec) AS BIGINT) AS total_duration_sec, round(sum(total_charge), 2) AS total_charge, "
        "CAST(sum(roaming_events) AS BIGINT) AS roaming_events FROM hourly GROUP BY usage_date ORDER BY usage_date",
    ),
    "quality_by_source": with_(TAGGED, _QUALITY_BY_SOURCE),
    "quality_by_source_joined": with_(TAGGED, _QUALITY_BY_SOURCE),
    "quarantine_sample": with_(
        SILVER,
        "SELECT * FROM quarantine ORDER BY reject_ts DESC, source_system, cdr_id, reject_reason LIMIT 100",
    ),
    # monitoring
    "reconciliation_trend": with_(
        RECON,
        "SELECT CAST(m.arrival_ts AS DATE) AS arrival_date, count(*) AS batch_count, "
        "CAST(sum(CASE WHEN r.reconciliation_status = 'RECONCILED' THEN 1 ELSE 0 END) AS BIGINT) AS reconciled_batches, "
        "CAST(sum(CASE WHEN r.reconciliation_status = 'WARNING' THEN 1 ELSE 0 END) AS BIGINT) AS warning_batches, "
        "CAST(sum(CASE WHEN r.reconciliation_status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed_batches, "
        "CAST(sum(r.expected_record_count) AS BIGINT) AS expected_record_count, "
        "CAST(sum(r.bronze_record_count) AS BIGINT) AS bronze_record_count, "
        "CAST(sum(r.quarantine_count) AS BIGINT) AS quarantine_count, "
        "round(sum(r.quarantine_count) / NULLIF(sum(r.bronze_record_count), 0), 4) AS reject_rate "
        "FROM recon r JOIN metadata m ON r.batch_id = m.batch_id AND r.source_system = m.source_system "
        "AND r.source_file = m.source_file GROUP BY CAST(m.arrival_ts AS DATE) ORDER BY arrival_date",
    ),
    "quality_scorecard": with_(
        TAGGED,
        "SELECT source_system, CAST(ingestion_ts AS DATE) AS load_date, count(*) AS total_records, "
        "CAST(sum(CASE WHEN quality_status = 'VALID' THEN 1 ELSE 0 END) AS BIGINT) AS valid_records, "
        "CAST(sum(CASE WHEN quality_status = 'REJECTED' THEN 1 ELSE 0 END) AS BIGINT) AS quarantined_records, "
        "round(sum(CASE WHEN quality_status = 'REJECTED' THEN 1 ELSE 0 END) / count(*), 4) AS reject_rate,\n"
        + _REASON_COUNTS
        + "\nFROM tagged GROUP BY source_system, CAST(ingestion_ts AS DATE) ORDER BY source_system, load_date",
    ),
    "reject_rate_jumps": with_(
        RECON,
        ", jr AS (SELECT r.batch_id, r.source_system, m.arrival_ts, r.reject_rate, "
        "CAST(round(r.reject_rate * 10000) AS BIGINT) AS bp FROM recon r JOIN metadata m "
        "ON r.batch_id = m.batch_id AND r.source_system = m.source_system AND r.source_file = m.source_file), "
        "jw AS (SELECT *, sum(bp) OVER w AS s, count(bp) OVER w AS n FROM jr "
        "WINDOW w AS (PARTITION BY source_system ORDER BY arrival_ts, batch_id "
        "ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)), "
        "jp AS (SELECT *, CASE WHEN n > 0 THEN CAST(floor((s * 2 + n) / (n * 2)) AS BIGINT) END AS prev_bp FROM jw) "
        "SELECT batch_id, source_system, arrival_ts, reject_rate, prev_bp / 10000.0 AS previous_avg_reject_rate, "
        "coalesce(bp - prev_bp > 200, false) AS is_jump FROM jp",
    ),
    "missing_batches": with_(
        METADATA,
        ", logged AS (SELECT source_system, CAST(arrival_ts AS DATE) AS expected_date FROM metadata), "
        "span AS (SELECT source_system, min(expected_date) AS d0, max(expected_date) AS d1 FROM logged "
        "GROUP BY source_system), "
        "sched AS (SELECT source_system, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) "
        "AS expected_date FROM span) "
        "SELECT s.source_system, s.expected_date FROM sched s WHERE NOT EXISTS (SELECT 1 FROM logged l "
        "WHERE l.source_system = s.source_system AND l.expected_date = s.expected_date) "
        "ORDER BY s.source_system, s.expected_date",
    ),
    "late_batches": with_(
        METADATA,
        f", due AS (SELECT CAST({AS_OF_SQL} - INTERVAL 24 HOUR AS DATE) AS d), "
        "days AS (SELECT CAST(unnest(generate_series((SELECT min(CAST(arrival_ts AS DATE)) FROM metadata), "
        "(SELECT d FROM due), INTERVAL 1 DAY)) AS DATE) AS expected_date), "
        "sources AS (SELECT unnest(['MEDIATION_A', 'MEDIATION_B', 'ROAMING_PARTNER', 'SILENT_SOURCE']) AS source_system) "
        "SELECT s.source_system, d.expected_date, "
        f"CAST(floor((epoch({AS_OF_SQL}) - epoch(CAST(d.expected_date AS TIMESTAMP))) / 3600) - 24 AS BIGINT) AS hours_late "
        "FROM sources s, days d WHERE NOT EXISTS (SELECT 1 FROM metadata m WHERE m.source_system = s.source_system "
        "AND CAST(m.arrival_ts AS DATE) = d.expected_date) ORDER BY s.source_system, d.expected_date",
    ),
    "sequence_overlaps": with_(
        SILVER,
        ", timed AS (SELECT subscriber_msisdn, source_system, cdr_id, event_ts, "
        "{'e': event_ts + to_seconds(duration_sec), 't': event_ts, 's': source_system, 'c': cdr_id} AS own FROM clean), "
        "seq AS (SELECT subscriber_msisdn, source_system, cdr_id, event_ts, max(own) OVER (PARTITION BY subscriber_msisdn "
        "ORDER BY event_ts, source_system, cdr_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM timed) "
        "SELECT subscriber_msisdn, source_system, cdr_id, event_ts, p.s AS previous_source_system, "
        "p.c AS previous_cdr_id, p.e AS previous_end_ts FROM seq WHERE event_ts < p.e",
    ),
}

# The same reconciliation over the fixture's faulty split.
_FAULTY = f""",
clean_split AS (
  SELECT * FROM clean WHERE NOT (substr(batch_id, 7, 8) = '{fixture.LOST_DAY}' AND right(cdr_id, 1) = '{fixture.LOST_DIGIT}')
),
quarantine_split AS (
  SELECT * FROM quarantine UNION ALL SELECT * FROM quarantine WHERE substr(batch_id, 7, 8) = '{fixture.REPEATED_DAY}'
)"""
_RECON_SPLIT = (
    SILVER + _METADATA + _FAULTY + _RECON.replace("FROM clean ", "FROM clean_split ").replace("FROM quarantine ", "FROM quarantine_split ")
)
for _name, _whole in [
    ("reconciliation_split", "reconciliation"),
    ("count_match_check_split", "count_match_check"),
    ("count_match_labels_split", "count_match_labels"),
]:
    _body = ORACLE_SQL[_whole].removeprefix(with_(RECON, ""))
    ORACLE_SQL[_name] = with_(_RECON_SPLIT, _body)

# A replay of the batches that came wrong leaves what a build from the right ones gives.
for _name, _whole in [
    ("replayed_tagged", "quality_tagged"),
    ("replayed_gold_hourly", "gold_usage_hourly"),
    ("replayed_reconciliation", "reconciliation"),
]:
    ORACLE_SQL[_name] = ORACLE_SQL[_whole]

# Arrivals in loads: the first load that brings a key has its first record.
_ARRIVALS = f""",
numbered AS (
  SELECT *, CAST(floor((day(ingestion_ts) - 1) / {fixture.LOAD_DAYS}) AS INTEGER) AS load_no FROM bronze
),
arrivals AS (
  SELECT * FROM numbered
  UNION ALL
  SELECT * REPLACE (load_no + 1 AS load_no) FROM numbered
  WHERE (ingest_seq // 2) % {fixture.RESENT_EVERY} = {fixture.RESENT_REMAINDER}
)"""
_OF_ARRIVALS = (
    TAGGED.removeprefix(BRONZE)
    .replace("FROM bronze)", "FROM arrivals)")
    .replace("ORDER BY ingestion_ts, batch_id, source_file, ingest_seq", "ORDER BY load_no, ingest_seq")
)
ORACLE_SQL["incremental_outcomes"] = with_(
    BRONZE + _ARRIVALS + _OF_ARRIVALS,
    "SELECT batch_id, source_system, cdr_id, is_duplicate, reject_reason, quality_status FROM tagged",
)

# Rules beyond the six, before the duplicate rule.
_RANGES = ", ".join(f"('{prefix}', '{partner}')" for prefix, partner in fixture.PARTNER_RANGES)
_CELL = "CAST(substr(cell_id, 6, 9) AS INTEGER)"
_MORE = f""",
ranges(prefix, partner) AS (VALUES {_RANGES}),
partners AS (
  SELECT number, arg_max(partner, length(prefix)) AS partner
  FROM (SELECT DISTINCT other_party_msisdn AS number FROM bronze) JOIN ranges ON starts_with(number, prefix)
  GROUP BY number
),
cells AS (
  SELECT cell_id, TIMESTAMP '{fixture.CELLS_OPEN}' AS valid_from,
         CASE WHEN {_CELL} % {fixture.CELL_CLOSES[0]} = {fixture.CELL_CLOSES[1]}
              THEN TIMESTAMP '{fixture.CELL_CLOSES[2]}' END AS valid_to
  FROM (SELECT DISTINCT cell_id FROM bronze) WHERE {_CELL} % {fixture.CELL_UNKNOWN[0]} <> {fixture.CELL_UNKNOWN[1]}
  UNION ALL
  SELECT cell_id, TIMESTAMP '{fixture.CELL_REOPENS[2]}', NULL FROM (SELECT DISTINCT cell_id FROM bronze)
  WHERE {_CELL} % {fixture.CELL_UNKNOWN[0]} <> {fixture.CELL_UNKNOWN[1]}
    AND {_CELL} % {fixture.CELL_REOPENS[0]} = {fixture.CELL_REOPENS[1]}
)"""


def _tagged_with(reason: str, fails: str) -> str:
    """Tagged records with one more rule ahead of the duplicate rule."""
    return TAGGED.removeprefix(BRONZE).replace(
        "      WHEN is_duplicate THEN", f"      WHEN {fails} THEN '{reason}'\n      WHEN is_duplicate THEN"
    )


_VERDICT = "SELECT batch_id, source_system, cdr_id, ingest_seq, reject_reason FROM tagged"
ORACLE_SQL["invalid_msisdn_formats"] = with_(
    BRONZE + _tagged_with("INVALID_MSISDN_FORMAT", "NOT regexp_full_match(subscriber_msisdn, '9053[0-9]{7}')"),
    "SELECT reject_reason, count(*) AS record_count FROM tagged GROUP BY reject_reason",
)
ORACLE_SQL["roaming_partner_tagged"] = with_(
    BRONZE + _MORE + _tagged_with(
        "UNKNOWN_ROAMING_PARTNER",
        "roaming_flag_bool AND NOT EXISTS (SELECT 1 FROM partners p WHERE p.number = other_party_msisdn)",
    ),
    _VERDICT,
)
ORACLE_SQL["cell_validity_tagged"] = with_(
    BRONZE + _MORE + _tagged_with(
        "CELL_NOT_IN_SERVICE",
        "NOT EXISTS (SELECT 1 FROM cells c WHERE c.cell_id = typed.cell_id AND event_ts >= c.valid_from "
        "AND (c.valid_to IS NULL OR event_ts < c.valid_to))",
    ),
    _VERDICT,
)
ORACLE_SQL["roaming_partner_usage"] = with_(
    SILVER + _MORE,
    "SELECT p.partner, count(*) AS roaming_events, CAST(sum(duration_sec) AS BIGINT) AS total_duration_sec "
    "FROM clean LEFT JOIN partners p ON p.number = other_party_msisdn WHERE roaming_flag GROUP BY p.partner",
)

ORACLE_SQL["source_unique_subscribers_rollup"] = ORACLE_SQL["source_unique_subscribers"]
ORACLE_SQL["daily_unique_subscribers_rollup"] = with_(
    SILVER,
    "SELECT event_date AS usage_date, event_type, count(DISTINCT subscriber_msisdn) AS unique_subscribers FROM clean "
    "GROUP BY event_date, event_type",
)

ORACLE_SQL["control_totals"] = with_(
    BRONZE,
    ", totals AS (SELECT batch_id, source_system, source_file, count(*) AS n, "
    "sum(CAST(charge_amount_raw AS DECIMAL(18,2))) AS charge FROM bronze GROUP BY batch_id, source_system, source_file), "
    f"checked AS (SELECT *, n - CAST(batch_id = '{fixture.ONE_LESS}' AS INTEGER) AS said_n, "
    f"charge + CASE WHEN batch_id = '{fixture.CENT_OFF}' THEN 0.01 ELSE 0.00 END AS said_charge FROM totals) "
    "SELECT batch_id, source_system, source_file, said_n AS control_record_count, "
    "CAST(said_charge AS DOUBLE) AS control_charge_total, n AS landed_record_count, "
    "CAST(charge AS DOUBLE) AS landed_charge_total, said_n = n AS count_matched, said_charge = charge AS charge_matched FROM checked",
)

# Lines with a field too many or missing are no records: they are rejected before all rules and rank nowhere.
_EXTRA = f"(ingest_seq // 2) % {fixture.EXTRA_FIELD[0]} = {fixture.EXTRA_FIELD[1]}"
_SHORT = f"(ingest_seq // 2) % {fixture.CUT_SHORT[0]} = {fixture.CUT_SHORT[1]}"
_FIELDS = [f"coalesce({c.strip()}, '')" for c in _BRONZE_COLS.split(",")]
_LINES = TAGGED.removeprefix(BRONZE).replace("FROM bronze)", f"FROM bronze WHERE NOT ({_EXTRA} OR {_SHORT}))")
ORACLE_SQL["malformed_lines"] = with_(
    BRONZE + _LINES,
    "SELECT batch_id, source_system, source_file, reject_reason, count(*) AS record_count, "
    "CAST(NULL AS BIGINT) AS raw_characters FROM tagged GROUP BY batch_id, source_system, source_file, reject_reason "
    "UNION ALL SELECT batch_id, source_system, source_file, 'MALFORMED_RECORD', count(*), "
    f"CAST(sum(length(CASE WHEN {_SHORT} THEN concat_ws(',', {', '.join(_FIELDS[:5])}) "
    f"ELSE concat_ws(',', {', '.join(_FIELDS)}) || ',extra' END)) AS BIGINT) "
    f"FROM bronze WHERE {_EXTRA} OR {_SHORT} GROUP BY batch_id, source_system, source_file",
)

# Reconciliation before and after the replay: the chain of CTEs twice, once over the first delivery.
_FIRST = f""",
wrong AS (
  SELECT *, substr(batch_id, 7, 8) = '{fixture.REDELIVERED_DAY}' AS bad, ingest_seq // 2 AS event FROM bronze
),
bronze_1 AS (
  SELECT * EXCLUDE (bad, event) REPLACE (
    CASE WHEN bad AND event % 7 = 1 THEN source_system || '_' || CAST(event + {fixture.KEY_SHIFT} AS STRING) ELSE cdr_id END AS cdr_id,
    CASE WHEN bad AND event % 11 = 3 THEN 'MMS' ELSE event_type END AS event_type)
  FROM wrong WHERE NOT (bad AND event % 5 = 2)
),
bcounts_1 AS (
  SELECT batch_id, source_system, source_file, count(*) AS n FROM bronze_1 GROUP BY batch_id, source_system, source_file
)"""
_CHAIN = "bronze bcounts typed reasoned tagged clean quarantine scounts qcounts recon_counts recon_rated recon".split()
_AGAIN = re.sub(rf"\b({"|".join(_CHAIN)})\b", r"\1_1", SILVER.removeprefix(BRONZE) + _RECON)
ORACLE_SQL["reconciliation_history"] = with_(
    SILVER + _METADATA + _RECON + _FIRST + _AGAIN,
    f"SELECT r.batch_id, r.source_system, r.source_file, {AS_OF_SQL} + INTERVAL 1 HOUR AS reconciliation_ts, "
    "f.reconciliation_status AS previous_status, r.reconciliation_status, f.reject_rate AS previous_reject_rate, r.reject_rate "
    "FROM recon r JOIN recon_1 f USING (batch_id, source_system, source_file) WHERE f.reconciliation_status <> r.reconciliation_status",
)

ORACLE_SQL["block_digests"] = with_(
    BRONZE,
    f", lines AS (SELECT strftime(ingestion_ts, '%Y%m%d') AS day, ingest_seq, concat_ws(',', {', '.join(_FIELDS)}) AS line FROM bronze), "
    "placed AS (SELECT day, line, sum(strlen(line) + 1) OVER (PARTITION BY day ORDER BY ingest_seq) - strlen(line) - 1 AS place FROM lines) "
    f"SELECT day, CAST(place // {fixture.DIGEST_BLOCK} AS BIGINT) AS block_no, count(*) AS n_lines, "
    "sha256(string_agg(sha256(line), '' ORDER BY place)) AS block_sha256 "
    f"FROM placed GROUP BY day, place // {fixture.DIGEST_BLOCK}",
)

# The statement of the views, with the days of each layer as the views have them.
ORACLE_SQL["sql_over_views"] = with_(
    SILVER + _METADATA,
    ", c AS (SELECT source_system, event_date AS usage_day, count(*) AS clean_records FROM clean GROUP BY ALL), "
    "q AS (SELECT source_system, CAST(ingestion_ts AS DATE) AS usage_day, count(*) AS rejected_records FROM tagged "
    "WHERE reject_reason IS NOT NULL GROUP BY ALL), "
    "m AS (SELECT source_system, CAST(arrival_ts AS DATE) AS usage_day, count(*) AS announced_batches FROM metadata GROUP BY ALL) "
    "SELECT * FROM c JOIN q USING (source_system, usage_day) JOIN m USING (source_system, usage_day)",
)

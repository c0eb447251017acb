"""Hand-made bronze rows for rule and duplicate tests."""

import datetime as dt

from meterflow.schemas import BRONZE_COLUMNS, BRONZE_SCHEMA

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)

GOOD = dict(
    batch_id="BATCH_20240101_000000_MEDIATION_A",
    source_system="MEDIATION_A",
    source_file="cdr_mediation_a_20240101_000000.csv",
    cdr_id="MEDIATION_A_1",
    subscriber_msisdn="90531234567",
    other_party_msisdn="90547654321",
    event_type="VOICE",
    start_time_raw="2024-01-01 10:15:00",
    duration_raw="60",
    cell_id="CELL_100",
    switch_id="SW_1",
    roaming_flag="N",
    charge_amount_raw="1.50",
    currency="TRY",
    ingestion_ts=T0,
    ingest_seq=0,
)


def rows(spark, *overrides):
    """One bronze row per override dict; unique ``cdr_id``/``ingest_seq`` unless given."""
    out = []
    for i, o in enumerate(overrides):
        r = {**GOOD, "cdr_id": f"MEDIATION_A_{i}", "ingest_seq": i, **o}
        out.append(tuple(r[c] for c in BRONZE_COLUMNS))
    return spark.createDataFrame(out, BRONZE_SCHEMA)

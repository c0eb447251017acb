"""Type and standardise bronze records (one narrow projection, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions import parsing

TYPED_COLUMNS = [
    "event_ts",
    "event_date",
    "event_hour",
    "duration_sec",
    "charge_amount",
    "roaming_flag_bool",
    "record_hash",
    "processed_ts",
]


def standardise(bronze: DataFrame, as_of=None) -> DataFrame:
    """Bronze plus typed columns; raw strings are kept for the quarantine.

    ``event_ts`` is parsed once and the date and hour are derived from it, so
    Catalyst keeps a single parse below the projection.
    """
    parsed = bronze.withColumn("event_ts", parsing.parse_event_ts("start_time_raw"))
    return parsed.withColumns(
        {
            "event_date": F.to_date("event_ts"),
            "event_hour": F.hour("event_ts"),
            "duration_sec": parsing.to_int_or_null("duration_raw"),
            "charge_amount": parsing.to_double_or_null("charge_amount_raw"),
            "roaming_flag_bool": parsing.flag_to_bool("roaming_flag"),
            "record_hash": parsing.record_hash(),
            "processed_ts": parsing.wall_clock(as_of),
        }
    )

"""meterflow: call-detail-record usage batches on Spark.

Raw batches land in bronze under an explicit schema, every record is typed
and tagged with at most one reject reason, the tagged set splits into clean
and quarantined records without losing a row, clean records roll up into
hourly and subscriber-day usage, and every batch is reconciled from its
expected count through raw, clean and quarantined counts.

Everything is a plain ``DataFrame -> DataFrame`` function over built-in
Spark expressions; no Python runs on the data path.
"""

from meterflow.session import checkpoint_root, local_session

__all__ = ["checkpoint_root", "local_session"]

"""Safe conversions of raw strings: a bad value becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterflow import fixed


def parse_event_ts(raw: str | Column = "start_time_raw") -> Column:
    """Strict ``yyyy-MM-dd HH:mm:ss`` parse in the session zone; NULL on failure."""
    return F.try_to_timestamp(_col(raw), F.lit(fixed.EVENT_TIME_FORMAT))


def to_int_or_null(raw: str | Column) -> Column:
    """``try_cast(raw AS INT)``: '1.5', '1e2', '' and out-of-range values are NULL."""
    return _col(raw).try_cast("int")


def to_double_or_null(raw: str | Column) -> Column:
    """``try_cast(raw AS DOUBLE)``; 'NaN' and 'Infinity' are accepted, as Spark does."""
    return _col(raw).try_cast("double")


def flag_to_bool(raw: str | Column = "roaming_flag") -> Column:
    """Three-valued flag: Y -> true, N -> false, anything else (or NULL) -> NULL."""
    c = _col(raw)
    return F.when(c == fixed.ROAMING_YES, F.lit(True)).when(c == fixed.ROAMING_NO, F.lit(False))


def record_hash(columns: list[str] | None = None) -> Column:
    """Hex SHA-256 of the hash columns joined by the separator (NULL parts are skipped)."""
    cols = [F.col(c) for c in (columns or fixed.RECORD_HASH_COLUMNS)]
    return F.sha2(F.concat_ws(fixed.RECORD_HASH_SEPARATOR, *cols), 256)


def is_blank(c: str | Column) -> Column:
    """NULL, or empty after trimming spaces (tabs and other white space are not blank)."""
    c = _col(c)
    return c.isNull() | (F.trim(c) == "")


def wall_clock(as_of=None) -> Column:
    """One timestamp per query: the given ``as_of`` or the query start time."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast("timestamp")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c

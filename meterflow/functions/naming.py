"""Batch naming as column expressions.

A batch is named ``BATCH_<yyyyMMdd_HHmmss>_<source>``; its file
``<prefix>_<yyyyMMdd_HHmmss>.csv``. (The test fixture writes these formats, and those of
record keys and subscriber numbers, as SQL text that Spark and the oracle share.)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterflow import fixed


def stamp_from_file(file_name: Column) -> Column:
    """The ``yyyyMMdd_HHmmss`` stamp at the end of a batch file name, or NULL."""
    return F.nullif(F.regexp_extract(file_name, r"_(\d{8}_\d{6})\.[^./]+$", 1), F.lit(""))


def batch_id(stamp: Column, source_system: Column) -> Column:
    return F.concat(F.lit("BATCH_"), stamp, F.lit("_"), source_system)


def source_from_file(file_name: Column) -> Column:
    """The source system whose file prefix the name has, or NULL."""
    found = F.lit(None).cast("string")
    for source, prefix in fixed.SOURCE_FILE_PREFIXES.items():
        found = F.when(file_name.startswith(prefix + "_"), F.lit(source)).otherwise(found)
    return found

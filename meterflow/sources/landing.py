"""Landing: raw batch files -> bronze, and the per-batch ingestion log.

Raw files are read under the fixed 14-string schema (never inferred), so a bad
value can only make a later conversion NULL, not break the read. Lineage
(``source_file``) falls back to the file name Spark reports for each row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from meterflow import fixed
from meterflow.functions import naming
from meterflow.functions.parsing import wall_clock
from meterflow.schemas import BATCH_KEYS, BRONZE_COLUMNS, LANDING_SCHEMA, METADATA_COLUMNS

# Raw strings are kept as sent: no trimming (a blank number must stay blank). The header is
# checked against the column names, so a file with other or reordered columns fails loudly.
CSV_OPTIONS = {
    "header": "true",
    "enforceSchema": "false",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# The line of a malformed record, as it came.
RAW_LINE = "raw_line"
LINE_SCHEMA = StructType([*LANDING_SCHEMA.fields, StructField(RAW_LINE, StringType())])

# A dated landing area: <root>/<source_system>/<yyyy>/<mm>/<dd>/<file>.
DATED_GLOB = "*/[0-9][0-9][0-9][0-9]/[0-9][0-9]/[0-9][0-9]"


def read_landing(
    spark: SparkSession,
    paths: str | list[str],
    fmt: str = "csv",
    options: dict | None = None,
    as_of=None,
    dated: bool = False,
) -> DataFrame:
    """Read raw CDR files into the bronze layout.

    ``dated=True`` reads a ``source/yyyy/mm/dd`` tree under each root and takes a
    missing ``source_system`` from the first folder level.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if dated:
        paths = [f"{p.rstrip('/')}/{DATED_GLOB}" for p in paths]
    reader = spark.read.schema(LANDING_SCHEMA).format(fmt)
    if fmt == "csv":
        reader = reader.options(mode="PERMISSIVE", **CSV_OPTIONS)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return stamp_ingestion(with_lineage(reader.load(paths), dated), as_of)


def read_lines(
    spark: SparkSession, paths: str | list[str], options: dict | None = None, as_of=None, dated: bool = False
) -> DataFrame:
    """Raw CSV files as bronze with one more column, ``raw_line``: the line as it came if it is malformed.

    Malformed is a line with more or fewer fields than the schema, or with a quote that never
    closes. Nothing but its lineage is taken from it: the file's name where that names a batch,
    else its first fields. Spark judges a line by the columns that are asked for, so store the
    result whole before anything is selected from it.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    paths = [f"{p.rstrip('/')}/{DATED_GLOB}" for p in paths] if dated else paths
    reader = spark.read.schema(LINE_SCHEMA).options(mode="PERMISSIVE", **CSV_OPTIONS)
    raw = reader.option("columnNameOfCorruptRecord", RAW_LINE).options(**(options or {})).csv(paths)
    bad, file = F.col(RAW_LINE).isNotNull(), F.col("_metadata.file_name")
    named = naming.batch_id(naming.stamp_from_file(file), naming.source_from_file(file))
    rows = with_lineage(raw.withColumns({"_named": named, "_file": file}), dated)
    lineage = {
        "source_system": F.coalesce(F.when(bad & F.col("_named").isNotNull(), naming.source_from_file(F.col("_file"))), "source_system"),
        "source_file": F.when(bad & F.col("_named").isNotNull(), F.col("_file")).otherwise(F.col("source_file")),
        "batch_id": F.coalesce(F.when(bad, F.col("_named")), "batch_id"),
    }
    content = {c: F.when(~bad, F.col(c)) for c in LANDING_SCHEMA.fieldNames() if c not in BATCH_KEYS}
    return stamp_ingestion(rows.withColumns(lineage).withColumns(content), as_of, [RAW_LINE])


def split_malformed(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored lines of ``read_lines`` as bronze records and malformed ones (with ``raw_line``)."""
    bad = F.col(RAW_LINE).isNotNull()
    return lines.where(~bad).select(*BRONZE_COLUMNS), lines.where(bad).select(*BRONZE_COLUMNS, RAW_LINE)


def with_lineage(raw: DataFrame, dated: bool = False) -> DataFrame:
    """Fill missing lineage from the file a record came from, in batch reads and streams alike."""
    lineage = {"source_file": F.coalesce(F.col("source_file"), F.col("_metadata.file_name"))}
    if dated:
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/\d{4}/\d{2}/\d{2}/[^/]+$", 1)
        lineage["source_system"] = F.coalesce(F.col("source_system"), F.nullif(folder, F.lit("")))
    named = raw.withColumns(lineage)
    # A record without a batch id belongs to the batch its file names: BATCH_<file stamp>_<source>.
    derived = naming.batch_id(naming.stamp_from_file(F.col("source_file")), F.col("source_system"))
    return named.withColumn("batch_id", F.coalesce(F.col("batch_id"), derived))


def read_control(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The senders' announcements: batch keys, ``arrival_ts``, ``expected_record_count`` and, if the
    file has it, ``actual_generated_count``. Columns are taken by name; a missing key column is an error."""
    reader = spark.read.option("header", "true") if fmt == "csv" else spark.read
    raw = reader.format(fmt).load(path)
    optional = {"arrival_ts": "timestamp", "expected_record_count": "int", "actual_generated_count": "int"}
    return raw.select(
        *[F.col(k).cast("string").alias(k) for k in BATCH_KEYS],
        *[(F.col(c).try_cast(t) if c in raw.columns else F.lit(None).cast(t)).alias(c) for c, t in optional.items()],
    )


def stamp_ingestion(raw: DataFrame, as_of=None, more: list[str] = ()) -> DataFrame:
    """Add ``ingestion_ts`` (one value per load) and a unique ``ingest_seq``; ``more`` columns are kept.

    ``ingest_seq`` comes from ``monotonically_increasing_id`` and is only stable
    once written: write bronze before anything ranks on it (``plans.layers``).
    """
    return raw.withColumns(
        {"ingestion_ts": wall_clock(as_of), "ingest_seq": F.monotonically_increasing_id()}
    ).select(*BRONZE_COLUMNS, *more)


def batch_counts(bronze: DataFrame, name: str = "bronze_record_count") -> DataFrame:
    """Rows per batch (partial aggregate on the map side, one row per batch out)."""
    return bronze.groupBy(*BATCH_KEYS).agg(F.count(F.lit(1)).alias(name))


def file_counts(bronze: DataFrame) -> DataFrame:
    """Rows per (source_system, source_file)."""
    return bronze.groupBy("source_system", "source_file").agg(F.count(F.lit(1)).alias("bronze_record_count"))


def ingestion_log(control: DataFrame, bronze: DataFrame, created_ts=None, status: str | Column | None = None) -> DataFrame:
    """One row per announced batch: expected count next to what landed.

    ``control`` carries the batch keys, ``arrival_ts`` and ``expected_record_count``
    (what the source announced) and may carry the sender's ``actual_generated_count``;
    without it that column repeats what landed. Counts of batches that never landed are 0.
    """
    sent = F.col("actual_generated_count").cast("int") if "actual_generated_count" in control.columns else F.lit(None)
    landed = batch_counts(bronze, "_landed")
    n = F.coalesce(F.col("_landed"), F.lit(0)).cast("int")
    return control.join(landed, on=BATCH_KEYS, how="left").select(
        *BATCH_KEYS,
        F.col("arrival_ts").cast("timestamp").alias("arrival_ts"),
        F.col("expected_record_count").cast("int").alias("expected_record_count"),
        F.coalesce(sent, n).alias("actual_generated_count"),
        n.alias("bronze_count"),
        (status if isinstance(status, Column) else F.lit(status or fixed.BATCH_STATUS_GENERATED)).alias("status"),
        wall_clock(created_ts).alias("created_ts"),
    ).select(*METADATA_COLUMNS)

"""Test input: CDR batches projected from the driver's ``events`` table.

The raw generator of the original pipeline is a driver-side random loop; here
bronze is a deterministic, fully distributed projection of ``events`` (one
narrow map over the scan), with faults planted by fixed modulo rules so every
quality rule and every reconciliation status occurs with exact expected counts.
See FIXTURES.md for the table of expressions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow import fixed
from meterflow.schemas import BATCH_KEYS, BRONZE_COLUMNS, METADATA_COLUMNS

# Fixture parameters.
AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)  # the one wall-clock value of fixture runs
SHORT_BATCH_DAY = "20240115"  # batches of this day expect 20 more records than land
SHORT_BY = 20
UNREGISTERED_BATCH = "BATCH_20240102_000000_ROAMING_PARTNER"  # landed, never logged
LOST_DAY, LOST_DIGIT = "20240110", "7"  # the faulty split loses clean records of this day whose key ends so
REPEATED_DAY = "20240111"  # and writes the quarantined records of this day twice
EMPTY_BATCH_DAY = "20240131"  # logged for MEDIATION_A, nothing landed
EMPTY_BATCH_EXPECTED = 100
COPY_DELAY_SECONDS = 60  # copies land one minute after their original
REDELIVERED_DAY = "20240108"  # batches of this day came wrong at first: see first_delivery
LOAD_DAYS = 8  # days of a load when the fixture is played as loads
RESENT_EVERY, RESENT_REMAINDER = 53, 7  # events that come again with the next load
KEY_SHIFT = 333  # a multiple of the number of sources, so that a shifted key keeps its source


EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``events`` table, read with its known schema (no inference job)."""
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


# The projection, as SQL expressions that Spark and DuckDB both accept, so the
# Spark fixture and the DuckDB oracle share one definition. ``e, u, t, ts`` are
# the event columns, ``d`` the event day (yyyyMMdd, built from integers: the
# same text as the first ten characters of the timestamp without dashes, at a
# fraction of the cost), ``src`` the source system.
EVENT_COLUMNS = [
    "event_id AS e",
    "user_id AS u",
    "event_type AS t",
    "ts",
    "CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS STRING) AS d",
    "CASE event_id % 3 WHEN 0 THEN 'MEDIATION_A' WHEN 1 THEN 'MEDIATION_B' ELSE 'ROAMING_PARTNER' END AS src",
]
RECORD_COLUMNS = [
    ("batch_id", "'BATCH_' || d || '_000000_' || src"),
    ("source_system", "src"),
    ("source_file", "'cdr_' || lower(src) || '_' || d || '_000000.csv'"),
    ("cdr_id", "src || '_' || CAST(e AS STRING)"),
    (
        "subscriber_msisdn",
        "CASE WHEN e % 61 = 13 THEN NULL WHEN e % 503 = 27 THEN '  ' "
        "ELSE '9053' || lpad(CAST(u AS STRING), 7, '0') END",
    ),
    ("other_party_msisdn", "'9054' || lpad(CAST((e * 7919) % 10000000 AS STRING), 7, '0')"),
    (
        "event_type",
        "CASE WHEN e % 997 = 5 THEN NULL WHEN e % 67 = 3 THEN 'MMS' "
        "WHEN t = 'click' THEN 'VOICE' WHEN t = 'view' THEN 'SMS' WHEN t = 'purchase' THEN 'DATA' "
        "WHEN t = 'signup' THEN 'ROAMING' WHEN t = 'error' THEN 'VOICE' END",
    ),
    ("start_time_raw", "CASE WHEN e % 41 = 4 THEN 'invalid_timestamp' ELSE substr(CAST(ts AS STRING), 1, 19) END"),
    (
        "duration_raw",
        "CASE WHEN e % 83 = 5 THEN '0' WHEN e % 83 = 6 THEN '-10' WHEN e % 409 = 7 THEN 'abc' "
        "ELSE CAST(1 + (e * 13) % 600 AS STRING) END",
    ),
    ("cell_id", "'CELL_' || CAST(100 + e % 900 AS STRING)"),
    ("switch_id", "'SW_' || CAST(1 + e % 20 AS STRING)"),
    (
        "roaming_flag",
        "CASE WHEN e % 101 = 3 THEN 'X' WHEN t = 'signup' OR src = 'ROAMING_PARTNER' OR e % 4 = 0 THEN 'Y' ELSE 'N' END",
    ),
    (
        "charge_amount_raw",
        "CASE WHEN e % 71 = 9 THEN '-' ELSE '' END || CAST(1 + e % 24 AS STRING) || '.' "
        "|| lpad(CAST((e * 37) % 100 AS STRING), 2, '0')",
    ),
    ("currency", "'TRY'"),
    ("ingestion_ts", "CAST(ts AS TIMESTAMP)"),
]
COPY_EVERY = 89  # events with e % 89 = 1 land twice
COPY_REMAINDER = 1


def fixture_bronze(ev: DataFrame) -> DataFrame:
    """Bronze rows (schema ``BRONZE_SCHEMA``) from ``events``: one narrow map over one scan.

    Every event lands once; every 89th lands again a minute later, so each
    event row expands to its copies (0, or 0 and 1) instead of a second scan.
    The columns are made after the copies, so that a filter on the landing time or a
    batch comes before them.
    """
    copies = ev.selectExpr(*EVENT_COLUMNS).selectExpr(
        "*", f"explode(CASE WHEN e % {COPY_EVERY} = {COPY_REMAINDER} THEN array(0, 1) ELSE array(0) END) AS copy_no"
    )
    records = copies.selectExpr("e", *[f"{expr} AS {name}" for name, expr in RECORD_COLUMNS], "copy_no")
    return records.withColumns(
        {
            "ingestion_ts": F.timestamp_add("SECOND", F.col("copy_no") * COPY_DELAY_SECONDS, F.col("ingestion_ts")),
            "ingest_seq": F.col("e") * 2 + F.col("copy_no"),
        }
    ).select(*BRONZE_COLUMNS)


def fixture_control(spark: SparkSession, bronze: DataFrame) -> DataFrame:
    """What the sources announced per batch: keys, arrival time, expected count.

    Derived from bronze counts (one partial aggregate, one row per batch), with
    one short-delivered day, one batch never logged and one logged-but-empty batch.
    """
    counts = bronze.groupBy(*BATCH_KEYS).agg(F.count(F.lit(1)).alias("_n"))
    day = F.substring(F.col("batch_id"), 7, 8)
    announced = (
        counts.where(F.col("batch_id") != UNREGISTERED_BATCH)
        .select(
            *BATCH_KEYS,
            F.to_timestamp(day, "yyyyMMdd").alias("arrival_ts"),
            (F.col("_n") + F.when(day == SHORT_BATCH_DAY, SHORT_BY).otherwise(0)).cast("int").alias(
                "expected_record_count"
            ),
        )
    )
    src = fixed.SOURCE_SYSTEMS[0]
    stamp = f"{EMPTY_BATCH_DAY}_000000"
    empty = spark.range(1).select(
        F.lit(f"BATCH_{stamp}_{src}").alias("batch_id"),
        F.lit(src).alias("source_system"),
        F.lit(f"{fixed.SOURCE_FILE_PREFIXES[src]}_{stamp}.csv").alias("source_file"),
        F.to_timestamp(F.lit(EMPTY_BATCH_DAY), "yyyyMMdd").alias("arrival_ts"),
        F.lit(EMPTY_BATCH_EXPECTED).cast("int").alias("expected_record_count"),
    )
    return announced.unionByName(empty)


def fixture_metadata(spark: SparkSession, bronze: DataFrame) -> DataFrame:
    """Ingestion log of the fixture (schema ``METADATA_SCHEMA``)."""
    from meterflow.sources.landing import ingestion_log

    return ingestion_log(fixture_control(spark, bronze), bronze, created_ts=AS_OF).select(*METADATA_COLUMNS)


def faulty_split(clean: DataFrame, quarantine: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A silver split as a broken load leaves it: some clean records lost, some rejects written twice."""
    day = F.substring(F.col("batch_id"), 7, 8)
    lost = (day == LOST_DAY) & F.col("cdr_id").endswith(LOST_DIGIT)
    return clean.where(~F.coalesce(lost, F.lit(False))), quarantine.unionByName(quarantine.where(day == REPEATED_DAY))


def redelivered(bronze: DataFrame) -> DataFrame:
    """The records of the batches that ``first_delivery`` has wrong."""
    return bronze.where(F.substring("batch_id", 7, 8) == REDELIVERED_DAY)


def first_delivery(bronze: DataFrame) -> DataFrame:
    """Bronze before the redelivery of one day's batches.

    Some records of that day are missing, some have another type, and some carry the key of a
    later event, whose own record in a later batch is then the duplicate.
    """
    event, wrong = F.floor(F.col("ingest_seq") / 2), F.substring("batch_id", 7, 8) == REDELIVERED_DAY
    key = F.concat("source_system", F.lit("_"), (event + KEY_SHIFT).cast("string"))
    early = bronze.where(~(wrong & (event % 5 == 2)))
    return early.withColumns(
        {
            "cdr_id": F.when(wrong & (event % 7 == 1), key).otherwise(F.col("cdr_id")),
            "event_type": F.when(wrong & (event % 11 == 3), "MMS").otherwise(F.col("event_type")),
        }
    )


def _load() -> Column:
    return F.floor((F.dayofmonth("ingestion_ts") - 1) / LOAD_DAYS).cast("int")


def _again() -> Column:
    return F.floor(F.col("ingest_seq") / 2) % RESENT_EVERY == RESENT_REMAINDER


def loads(bronze: DataFrame) -> DataFrame:
    """Bronze as it would come in loads: ``load_no`` by the day it landed; some records come again a load later."""
    load = _load()
    return bronze.withColumn("load_no", F.explode(F.when(_again(), F.array(load, load + 1)).otherwise(F.array(load))))


def load_arrivals(bronze: DataFrame, load_no: int) -> DataFrame:
    """The records of ``loads`` in one load; those of other loads are left out before they are expanded."""
    near = bronze.where((_load() == load_no) | (_again() & (_load() == load_no - 1)))
    return loads(near).where(F.col("load_no") == load_no)


# A numbering plan over the other parties' numbers (90 54 and seven digits): ranges nest.
PARTNER_RANGES = [
    ("90540", "PARTNER_A"),
    ("90541", "PARTNER_A"),
    ("9054155", "PARTNER_B"),
    ("90542", "PARTNER_B"),
    ("905427", "PARTNER_C"),
    ("9054270", "PARTNER_A"),
    ("90543", "PARTNER_C"),
    ("90544", "PARTNER_D"),
    ("90545", "PARTNER_D"),
    ("90546", "PARTNER_E"),
    ("90547", "PARTNER_E"),
    ("905489", "PARTNER_F"),
]
# Cells of the records with their periods of service, by the cell's number.
CELLS_OPEN = "2023-06-01 00:00:00"
CELL_CLOSES = (7, 3, "2024-01-16 12:00:00")  # cells with number % 7 = 3 close then
CELL_REOPENS = (14, 3, "2024-01-20 06:30:00")  # half of them open again
CELL_UNKNOWN = (11, 5)  # not listed at all


def partner_ranges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PARTNER_RANGES, "prefix string, partner string")


def cell_periods(bronze: DataFrame) -> DataFrame:
    """The cells named by the records, with periods of service that overlap, end and begin again."""
    number = F.substring("cell_id", 6, 9).cast("int")
    cells = bronze.select("cell_id").distinct().where(number % CELL_UNKNOWN[0] != CELL_UNKNOWN[1])
    at = lambda text: F.lit(text).cast("timestamp")
    closes = number % CELL_CLOSES[0] == CELL_CLOSES[1]
    first = F.struct(
        at(CELLS_OPEN).alias("valid_from"), F.when(closes, at(CELL_CLOSES[2])).alias("valid_to")
    )
    again = F.struct(at(CELL_REOPENS[2]).alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    return cells.select(
        "cell_id",
        F.explode(F.when(number % CELL_REOPENS[0] == CELL_REOPENS[1], F.array(first, again)).otherwise(F.array(first))).alias("p"),
    ).select("cell_id", "p.*")


CENT_OFF = "BATCH_20240105_000000_MEDIATION_A"  # its sender's total is one cent more than its records'
ONE_LESS = "BATCH_20240106_000000_MEDIATION_B"  # its sender counted one record less


def control_totals(bronze: DataFrame) -> DataFrame:
    """Record counts and charge totals as the senders announce them, wrong for two batches."""
    batch = F.col("batch_id")
    totals = bronze.groupBy(*BATCH_KEYS).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col("charge_amount_raw").cast("decimal(18,2)")).alias("_charge")
    )
    return totals.select(
        *BATCH_KEYS,
        (F.col("_n") - (batch == ONE_LESS).cast("int")).alias("control_record_count"),
        (F.col("_charge") + F.when(batch == CENT_OFF, F.lit("0.01").cast("decimal(18,2)")).otherwise(0)).alias(
            "control_charge_total"
        ),
    )


EXTRA_FIELD, CUT_SHORT = (211, 9), (307, 11)  # events whose lines come with a field too many, or five fields only


def raw_lines(bronze: DataFrame) -> DataFrame:
    """The records as CSV lines without header, some of them malformed."""
    event, names = F.floor(F.col("ingest_seq") / 2), BRONZE_COLUMNS[:14]
    fields = F.array(*[F.coalesce(F.col(c), F.lit("")) for c in names])
    fields = F.when(event % EXTRA_FIELD[0] == EXTRA_FIELD[1], F.array_append(fields, F.lit("extra"))).otherwise(fields)
    fields = F.when(event % CUT_SHORT[0] == CUT_SHORT[1], F.slice(fields, 1, 5)).otherwise(fields)
    return bronze.select(F.array_join(fields, ",").alias("value"))


DIGEST_BLOCK = 4096  # bytes of a block of the day files below


def write_day_files(bronze: DataFrame, folder: str) -> None:
    """The records as text, one file for each landing day, in landing order."""
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in BRONZE_COLUMNS[:14]]).alias("value")
    day = F.date_format("ingestion_ts", "yyyyMMdd").alias("day")
    rows = bronze.select(line, day, "ingest_seq").repartition("day").sortWithinPartitions("day", "ingest_seq")
    rows.drop("ingest_seq").write.partitionBy("day").text(folder)

"""Delivery integrity: file checksums against a manifest, control totals per batch.

* ``file_checksums`` reads landed files with the ``binaryFile`` source (one row
  per file, content hashed on the executors) -- nothing passes the driver.
* ``block_digests`` is for files of any size: a tree of digests over lines, blocks of
  lines and files, from splits that tasks read apart; ``block_mismatches`` names the
  damaged blocks.
* ``checksum_mismatches`` joins them to the sender's manifest (file name,
  SHA-256): missing, unexpected and altered files.
* ``control_total_check`` compares what a source announced per batch (record
  count, total charge) with what landed in bronze.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterflow.schemas import BATCH_KEYS


def file_checksums(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    return files.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
        "path",
        "length",
        F.sha2("content", 256).alias("sha256"),
    )


def checksum_mismatches(checksums: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose checksum differs, or that are on only one side (``manifest``: file_name, sha256)."""
    m = manifest.select("file_name", F.col("sha256").alias("expected_sha256"))
    joined = checksums.select("file_name", F.col("sha256").alias("actual_sha256")).join(m, "file_name", "full_outer")
    problem = (
        F.when(F.col("actual_sha256").isNull(), F.lit("MISSING_FILE"))
        .when(F.col("expected_sha256").isNull(), F.lit("UNEXPECTED_FILE"))
        .when(F.col("actual_sha256") != F.col("expected_sha256"), F.lit("CHECKSUM_MISMATCH"))
    )
    return joined.withColumn("problem", problem).where(F.col("problem").isNotNull())


BLOCK_BYTES = 8 << 20  # a block holds the lines that begin in so many bytes of a file


def block_digests(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per file and block: number of lines, and SHA-256 over the hex SHA-256 digests of its lines in order.

    Block k holds the lines that begin in bytes [k * block_bytes, (k + 1) * block_bytes) of the
    file, lines ending with a line feed; the sender can make the same from its copy. No file and
    no split is one value: splits are read apart, a line's place is its place in its split plus
    the length of the splits before, and only digests are exchanged. An empty file has no block.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("file_bytes"),
        F.col("_metadata.file_block_start").alias("split"),
        (F.octet_length("value") + 1).cast("long").alias("size"),
        F.sha2(F.col("value").cast("binary"), 256).alias("digest"),
        F.monotonically_increasing_id().alias("place"),
    )
    lengths = raw.groupBy("path", "split").agg(F.sum("size").alias("length"))
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = lengths.select("path", "split", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("path", "split").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    lines = raw.withColumn("offset", F.coalesce(F.sum("size").over(within), F.lit(0))).join(starts, ["path", "split"])
    offset = F.col("start") + F.col("offset")
    blocks = lines.withColumns({"offset": offset, "block_no": F.floor(offset / block_bytes)}).groupBy("path", "block_no").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.max("file_bytes").alias("file_bytes"),
        F.array_sort(F.collect_list(F.struct("offset", "digest"))).alias("_lines"),
    )
    return blocks.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
        "path",
        "file_bytes",
        "block_no",
        "n_lines",
        F.sha2(F.array_join("_lines.digest", ""), 256).alias("block_sha256"),
    )


def tree_digests(blocks: DataFrame) -> DataFrame:
    """Per file the SHA-256 over its block digests in order: the root of the tree (a short row a block)."""
    leaves = F.array_sort(F.collect_list(F.struct("block_no", "block_sha256")))
    files = blocks.groupBy("path").agg(
        F.first("file_name").alias("file_name"), F.max("file_bytes").alias("file_bytes"), leaves.alias("_blocks")
    )
    return files.select("file_name", "path", "file_bytes", F.sha2(F.array_join("_blocks.block_sha256", ""), 256).alias("tree_sha256"))


def block_mismatches(blocks: DataFrame, manifest: DataFrame) -> DataFrame:
    """Blocks that differ from the sender's (``manifest``: file_name, block_no, block_sha256), or are on one side only."""
    sent = manifest.select("file_name", "block_no", F.col("block_sha256").alias("expected_sha256"))
    found = blocks.select("file_name", "block_no", F.col("block_sha256").alias("actual_sha256"))
    joined = found.join(sent, ["file_name", "block_no"], "full_outer")
    problem = (
        F.when(F.col("actual_sha256").isNull(), F.lit("MISSING_BLOCK"))
        .when(F.col("expected_sha256").isNull(), F.lit("UNEXPECTED_BLOCK"))
        .when(F.col("actual_sha256") != F.col("expected_sha256"), F.lit("BLOCK_MISMATCH"))
    )
    return joined.withColumn("problem", problem).where(F.col("problem").isNotNull())


MONEY = "decimal(28,6)"


def control_total_check(control: DataFrame, bronze: DataFrame) -> DataFrame:
    """Per announced batch: announced vs landed record count and charge total.

    ``control``: batch keys, ``control_record_count``, ``control_charge_total``. Charges
    are added up as decimals, so the total does not depend on the order of the records,
    and compared to the cent. Raw charges that are no decimal number count as nothing.
    """
    landed = bronze.groupBy(*BATCH_KEYS).agg(
        F.count(F.lit(1)).alias("landed_record_count"),
        F.sum(F.col("charge_amount_raw").try_cast(MONEY)).alias("landed_charge_total"),
    )
    cents = lambda c: F.round(F.col(c).cast("decimal(38,6)"), 2).cast("decimal(38,2)")
    out = control.join(landed, on=BATCH_KEYS, how="left").withColumns(
        {
            "control_charge_total": cents("control_charge_total"),
            "landed_record_count": F.coalesce("landed_record_count", F.lit(0).cast("bigint")),
            "landed_charge_total": F.coalesce(cents("landed_charge_total"), F.lit(0).cast("decimal(38,2)")),
        }
    )
    return out.withColumns(
        {
            "count_matched": F.col("control_record_count") == F.col("landed_record_count"),
            "charge_matched": F.col("control_charge_total") == F.col("landed_charge_total"),
        }
    )

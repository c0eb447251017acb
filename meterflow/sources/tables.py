"""Layer tables as partitioned Parquet folders under one root.

Paths, not a catalog: an in-memory catalog dies with the session while the
folders stay, so every layer is addressed by ``<root>/<table>``. Writes either
replace a whole table or, with ``batches`` replay, only the partitions present
in the data (dynamic partition overwrite).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.schemas import TABLE_SCHEMAS

# table -> partition columns. Bronze, tagged and quarantined records are kept per batch
# (the replay unit); clean and gold per event day (what reports filter on).
LAYOUT: dict[str, list[str]] = {
    "metadata_ingestion_log": [],
    "bronze_cdr_raw": ["batch_id"],
    "silver_cdr_tagged": ["batch_id", "quality_status"],
    "silver_cdr_clean": ["event_date"],
    "silver_cdr_quarantine": ["batch_id"],
    "gold_cdr_usage_hourly": ["usage_date"],
    "gold_subscriber_usage_daily": ["usage_date"],
    "gold_reconciliation_daily": [],
}
# Beside the layers: lines that no record could be read from, filters of each batch's record
# keys for replays, and every run of the reconciliation.
SIDE_LAYOUT = {
    "bronze_cdr_malformed": ["batch_id"],
    "bronze_key_filters": ["batch_id"],
    "reconciliation_history": ["run_id"],
}

# Layout of the incremental (streaming) tier: every table is kept per load (one
# micro-batch), so a retried micro-batch replaces exactly what it wrote before and
# a batch that arrives in several loads keeps them all. ``load_id`` is a folder
# only; it is not part of the tables' contract.
STREAM_LAYOUT: dict[str, list[str]] = {
    table: ["load_id"] for table in ["bronze_cdr_raw", "silver_cdr_tagged", "silver_cdr_clean", "silver_cdr_quarantine"]
}


def layer_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def write_layer(
    df: DataFrame, root: str, table: str, dynamic: bool = False, rebalance: bool = True, layout: dict | None = None
) -> None:
    """Write ``df`` as ``table``; ``dynamic`` replaces only the partitions it holds.

    ``rebalance`` adds an AQE rebalance on the partition columns first: skewed
    partitions are split and small ones merged, so file sizes follow the
    advisory size whatever the upstream partitioning was.
    """
    parts = (layout or LAYOUT | SIDE_LAYOUT)[table]
    out = df.hint("rebalance", *parts) if (rebalance and parts) else df
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(layer_path(root, table))


def read_layer(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The table under its fixed schema; a table written without rows reads as empty."""
    schema = TABLE_SCHEMAS[table]
    return spark.read.schema(schema).parquet(layer_path(root, table)).select(*schema.fieldNames())


def exists(spark: SparkSession, root: str, table: str) -> bool:
    """Whether the table has been written, in whatever file system ``root`` is."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(layer_path(root, table))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def read_side(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table beside the layers; one that was never written is empty."""
    if exists(spark, root, table):
        return read_layer(spark, root, table)
    return spark.createDataFrame([], TABLE_SCHEMAS[table])


def landed(spark: SparkSession, root: str) -> DataFrame:
    """Every landed line in the bronze columns: the records, and the malformed ones with their lineage only."""
    bronze = read_layer(spark, root, "bronze_cdr_raw")
    return bronze.unionByName(read_side(spark, root, "bronze_cdr_malformed").select(*bronze.columns))


def read_files(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The table with its file metadata (for ``files_of``)."""
    return spark.read.schema(TABLE_SCHEMAS[table]).parquet(layer_path(root, table))


def files_of(rows: DataFrame) -> list[str]:
    """The files that these rows of a stored table lie in (their paths only pass the driver)."""
    return [r.path for r in rows.select(F.col("_metadata.file_path").alias("path")).distinct().collect()]


def replace_partitions(rows: DataFrame, root: str, table: str, before: list[str], rebalance: bool = True) -> None:
    """Overwrite the partitions that ``rows`` holds, and take away what is left of ``before``.

    ``before`` are the files of all partitions that the rows replace (``files_of``). A partition
    that has rows now lost its old files to the overwrite; one that has none left loses them here.
    """
    write_layer(rows, root, table, dynamic=True, rebalance=rebalance)
    sc = rows.sparkSession.sparkContext
    for name in before:
        path = sc._jvm.org.apache.hadoop.fs.Path(sc._jvm.java.net.URI(name))
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, False)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a partition's folder, in whatever file system it is."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def merge_layer(fresh: DataFrame, root: str, table: str, keys: list[str], keep: list[str] = ()) -> None:
    """Replace the rows of ``table`` whose keys ``fresh`` has and leave the others.

    A column of ``keep`` that is NULL in a fresh row keeps its stored value. The result is
    staged beside the table before it takes its place, since the table is also its input.
    """
    spark = fresh.sparkSession
    schema = TABLE_SCHEMAS[table]
    if exists(spark, root, table):
        stored = read_layer(spark, root, table)
        same = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
        is_new = F.col("n._fresh").isNotNull()
        merged = fresh.withColumn("_fresh", F.lit(1)).alias("n").join(
            stored.alias("o"), reduce(lambda a, b: a & b, same), "full"
        )
        fresh = merged.select(
            *[
                F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c)
                if c in keep
                else F.when(is_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
                for c in schema.fieldNames()
            ]
        )
    staged = f"{root.rstrip('/')}/_staging/{table}-{uuid.uuid4().hex}"
    fresh.select(*schema.fieldNames()).write.parquet(staged)
    write_layer(spark.read.schema(schema).parquet(staged), root, table)


def register_views(spark: SparkSession, root: str | None = None, layers=None) -> list[str]:
    """Expose the layer tables as temp views under their table names.

    SQL written against the seven tables (dashboards, checks) then runs as-is
    with ``spark.sql``. Views come from written tables under ``root``, or from
    an in-memory ``LayerSet``.
    """
    if layers is not None:
        frames = {
            "metadata_ingestion_log": layers.metadata,
            "bronze_cdr_raw": layers.bronze,
            "silver_cdr_tagged": layers.tagged,
            "silver_cdr_clean": layers.clean,
            "silver_cdr_quarantine": layers.quarantine,
            "gold_cdr_usage_hourly": layers.hourly,
            "gold_subscriber_usage_daily": layers.daily,
            "gold_reconciliation_daily": layers.recon,
        }
    else:
        frames = {table: read_layer(spark, root, table) for table in LAYOUT}
    for table, df in frames.items():
        df.createOrReplaceTempView(table)
    return list(frames)

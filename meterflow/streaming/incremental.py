"""Incremental ingestion and quality on Structured Streaming.

* ``landing_stream``: raw files as a stream, with the batch reader's schema checks
  and lineage (a missing batch id comes from the file name, a missing source from a
  dated tree).
* ``IncrementalQuality``: a ``foreachBatch`` step. Every micro-batch is a load of its
  own: bronze, tagged, clean and quarantined records are kept per load, so a retried
  micro-batch replaces exactly what it wrote, and a batch that arrives in several
  files or is delivered again keeps all its records. Duplicates are judged against a
  table of the keys that earlier loads brought first: the first arrival of a key is
  its one candidate for the clean table, whatever batch it names.
* ``publish``: gold, ingestion log and reconciliation from the stored loads.
* ``hourly_usage_stream``: hourly usage over a stream of clean records, with a
  watermark; windows are emitted once closed. Distinct subscribers are
  approximate here: exact distinct counts are not supported on streams.

Window functions are not supported on streams, which is one more reason the
duplicate flag is built from aggregates and joins.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions.metrics import count_when, money_sum
from meterflow.operators import keyfilter, quality
from meterflow.operators.dedup import DEFAULT_KEY
from meterflow.plans import layers
from meterflow.schemas import LANDING_SCHEMA
from meterflow.sources.landing import CSV_OPTIONS, DATED_GLOB, stamp_ingestion, with_lineage
from meterflow.sources.tables import STREAM_LAYOUT, drop_folder, exists, layer_path, read_layer, write_layer

KEY = list(DEFAULT_KEY)

# Keys by the load that brought them first, and Bloom filters of each load's keys. A
# micro-batch asks the filters; of the keys it reads the buckets that may hold one of its
# own, none if all its keys are new. Loads of a size are merged into one (``compact``), so
# that the number of filters asked grows with the logarithm of the number of loads.
SEEN_KEYS = "seen_keys"
SEEN_SCHEMA = "source_system string, cdr_id string, load_id string, bucket int"
SEEN_BUCKETS = 64
SEEN_FILTERS = "seen_filters"
FILTER_SCHEMA = "level int, block long, bitmap binary, load_id string"
#: So many loads of a level (a power of two of keys) are merged into one.
FANOUT = 8


def landing_stream(
    spark: SparkSession, path: str, fmt: str = "csv", max_files_per_trigger: int | None = None, dated: bool = False
) -> DataFrame:
    reader = spark.readStream.schema(LANDING_SCHEMA).format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return with_lineage(reader.load(f"{path.rstrip('/')}/{DATED_GLOB}" if dated else path), dated)


def _bucket():
    return F.pmod(F.xxhash64(*KEY), F.lit(SEEN_BUCKETS)).cast("int")


class IncrementalQuality:
    """``foreachBatch`` function: micro-batch -> bronze, tagged, clean, quarantine under ``root``.

    The load id is the stream's query id and the epoch: a new stream over the same root
    never meets the loads of an older one. ``run`` names the stream of direct calls.
    """

    def __init__(self, root: str, as_of=None, rules=None, run: str = "manual", fanout: int = FANOUT):
        self.root, self.as_of, self.rules, self.run, self.fanout = root, as_of, rules, run, fanout

    def load_id(self, spark: SparkSession, epoch_id: int) -> str:
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        return f"{stream or self.run}-{epoch_id:012d}"

    def _write(self, rows: DataFrame, table: str, load: str) -> None:
        rows = rows.withColumn("load_id", F.lit(load))
        write_layer(rows, self.root, table, dynamic=True, rebalance=False, layout=STREAM_LAYOUT)

    def _read(self, spark: SparkSession, table: str, load: str) -> DataFrame:
        stored = spark.read.schema(read_layer(spark, self.root, table).schema.add("load_id", "string"))
        return stored.parquet(layer_path(self.root, table)).where(F.col("load_id") == load).drop("load_id")

    def _seen(self, spark: SparkSession, current: DataFrame, load: str) -> DataFrame | None:
        """Keys of earlier loads, from the files that may hold keys of this one; None if there is no such file."""
        if not exists(spark, self.root, SEEN_FILTERS):
            return None
        filters = spark.read.schema(FILTER_SCHEMA).parquet(layer_path(self.root, SEEN_FILTERS))
        hits = keyfilter.may_contain(current, KEY, filters.where(F.col("load_id") != load), ["load_id"])
        folders = hits.select("load_id", _bucket().alias("bucket")).distinct()  # loads times buckets at most
        wanted = [(F.col("load_id") == r.load_id) & (F.col("bucket") == r.bucket) for r in folders.collect()]
        if not wanted:
            return None
        return _seen_keys(spark, self.root).where(reduce(lambda a, b: a | b, wanted)).select(*KEY)

    def __call__(self, micro: DataFrame, epoch_id: int) -> None:
        spark = micro.sparkSession
        load = self.load_id(spark, epoch_id)
        self._write(stamp_ingestion(micro, self.as_of), "bronze_cdr_raw", load)
        # Read back: ingest_seq is fixed once written.
        current = self._read(spark, "bronze_cdr_raw", load)
        seen = self._seen(spark, current, load)
        self._write(quality.tag_quality(current, rules=self.rules, as_of=self.as_of, seen=seen), "silver_cdr_tagged", load)
        tagged = self._read(spark, "silver_cdr_tagged", load)
        self._write(quality.clean_records(tagged), "silver_cdr_clean", load)
        self._write(quality.quarantine_records(tagged, self.as_of), "silver_cdr_quarantine", load)
        # The records that are first of their key bring it; the others were seen before.
        first = tagged.where(~F.col("is_duplicate")).select(*KEY)
        _write_seen(first.withColumn("load_id", F.lit(load)), self.root)
        compact(spark, self.root, newest=load, fanout=self.fanout)


def _seen_keys(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(SEEN_SCHEMA).parquet(layer_path(root, SEEN_KEYS))


def _write_seen(keys: DataFrame, root: str) -> None:
    """Add keys under their ``load_id``, then the filters that make them known.

    The keys of a bucket come together first: a load has a few files for each bucket, not one
    from each task that held some of its keys.
    """
    for rows, table, parts in [
        (keys.withColumn("bucket", _bucket()).hint("rebalance", "load_id", "bucket"), SEEN_KEYS, ["load_id", "bucket"]),
        (keyfilter.build(keys, KEY, ["load_id"]), SEEN_FILTERS, ["load_id"]),
    ]:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*parts).parquet(layer_path(root, table))


def compact(spark: SparkSession, root: str, newest: str | None = None, fanout: int = FANOUT) -> list[str]:
    """Merge loads of a level wherever there are ``fanout`` of them; returns the loads that were merged.

    ``newest`` may still be retried and stays. The merged keys and their filters are written
    before the old ones go, filters first: a key is known at every moment, at times twice,
    which changes nothing.
    """
    if not exists(spark, root, SEEN_FILTERS):
        return []
    filters = spark.read.schema(FILTER_SCHEMA).parquet(layer_path(root, SEEN_FILTERS))
    loads: dict[int, list[str]] = {}
    for row in filters.where(F.col("load_id") != (newest or "")).select("load_id", "level").distinct().collect():
        loads.setdefault(row.level, []).append(row.load_id)
    merged = sorted(load for of_level in loads.values() if len(of_level) >= fanout for load in of_level)
    if merged:
        keys = _seen_keys(spark, root).where(F.col("load_id").isin(merged)).select(*KEY)
        _write_seen(keys.withColumn("load_id", F.lit(f"merged-{uuid.uuid4().hex}")), root)
        for table in (SEEN_FILTERS, SEEN_KEYS):
            for load in merged:
                drop_folder(spark, f"{layer_path(root, table)}/load_id={load}")
    return merged


def publish(spark: SparkSession, root: str, control: DataFrame | None = None, as_of=None) -> None:
    """Merge the stored loads into the ingestion log, then rebuild gold and reconciliation."""
    layers.log_landed(read_layer(spark, root, "bronze_cdr_raw"), root, control, as_of=as_of)
    layers.build_gold(spark, root, as_of=as_of)


def run_incremental(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    as_of=None,
    rules=None,
    max_files_per_trigger=None,
    dated: bool = False,
):
    """Process every landed file available now, then stop (``availableNow``)."""
    query = (
        landing_stream(spark, landing, max_files_per_trigger=max_files_per_trigger, dated=dated)
        .writeStream.foreachBatch(IncrementalQuality(root, as_of=as_of, rules=rules))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def hourly_usage_stream(clean: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Hourly usage per source and event type on a stream of clean records."""
    return (
        clean.withWatermark("event_ts", watermark)
        .groupBy(F.window("event_ts", "1 hour").alias("w"), "source_system", "event_type")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.sum("duration_sec").alias("total_duration_sec"),
            money_sum("charge_amount").alias("total_charge"),
            F.approx_count_distinct("subscriber_msisdn").alias("approx_unique_subscribers"),
            count_when(F.col("roaming_flag")).alias("roaming_events"),
        )
        .select(
            F.to_date(F.col("w.start")).alias("usage_date"),
            F.hour(F.col("w.start")).alias("usage_hour"),
            "source_system",
            "event_type",
            "total_events",
            "total_duration_sec",
            "total_charge",
            "approx_unique_subscribers",
            "roaming_events",
        )
    )


def hourly_usage_stream_exact(clean: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Hourly gold on a stream, distinct subscribers exact: the columns of ``usage.usage_hourly``.

    Two stateful aggregates in a row. The first keeps a row for each subscriber of an open
    hour, so an hour with a third of all records is spread over its subscribers; when the
    watermark closes the hour, the second adds these rows up and counts them.
    """
    keys = ["source_system", "event_type"]
    per_subscriber = (
        clean.withWatermark("event_ts", watermark)
        .groupBy(F.window("event_ts", "1 hour").alias("hour"), *keys, "subscriber_msisdn")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum("duration_sec").alias("duration"),
            F.sum(F.col("charge_amount").cast("decimal(28,6)")).alias("charge"),
            count_when(F.col("roaming_flag")).alias("roaming"),
        )
    )
    hourly = per_subscriber.groupBy(F.window("hour", "1 hour").alias("hour"), *keys).agg(
        F.sum("events").alias("total_events"),
        F.sum("duration").alias("total_duration_sec"),
        F.round(F.sum("charge").cast("double"), 2).alias("total_charge"),
        F.count("subscriber_msisdn").alias("unique_subscribers"),
        F.sum("roaming").alias("roaming_events"),
    )
    start = F.col("hour.start")
    return hourly.select(
        F.to_date(start).alias("usage_date"), F.hour(start).alias("usage_hour"), *keys, "total_events",
        "total_duration_sec", "total_charge", "unique_subscribers", "roaming_events",
    )

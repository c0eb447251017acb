"""The seven layer tables of one run, as lazily built DataFrames.

A ``LayerSet`` starts from bronze and the ingestion log, either projected from
the driver's test tables (``from_fixture``) or read back from written layer
tables (``from_tables``). Every derived layer is built once per ``LayerSet``
object and shared by all reports that use it, so one query plan never tags the
same records twice under different shapes (Spark reuses the identical
exchanges inside a plan).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from meterflow.operators import quality, reconcile, usage
from meterflow.sources import fixture


@dataclass
class LayerSet:
    spark: SparkSession
    bronze: DataFrame
    metadata_source: DataFrame | Callable[[], DataFrame]
    as_of: object = None
    rules: list | None = None
    source: str | None = None
    _tagged: DataFrame | None = field(default=None, repr=False)
    _clean: DataFrame | None = field(default=None, repr=False)
    _quarantine: DataFrame | None = field(default=None, repr=False)
    _hourly: DataFrame | None = field(default=None, repr=False)
    _daily: DataFrame | None = field(default=None, repr=False)
    _recon: DataFrame | None = field(default=None, repr=False)

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str, as_of=fixture.AS_OF, rules=None) -> "LayerSet":
        bronze = fixture.fixture_bronze(fixture.events(spark, sf_dir))
        return cls(spark, bronze, lambda: fixture.fixture_metadata(spark, bronze), as_of=as_of, rules=rules, source=sf_dir)

    @classmethod
    def from_tables(cls, spark: SparkSession, root: str, as_of=None) -> "LayerSet":
        """Layers written by ``plans.layers.write_layers`` under ``root``."""
        from meterflow.sources.tables import read_layer

        return cls(
            spark,
            read_layer(spark, root, "bronze_cdr_raw"),
            read_layer(spark, root, "metadata_ingestion_log"),
            as_of=as_of,
            _tagged=read_layer(spark, root, "silver_cdr_tagged"),
            _clean=read_layer(spark, root, "silver_cdr_clean"),
            _quarantine=read_layer(spark, root, "silver_cdr_quarantine"),
            _hourly=read_layer(spark, root, "gold_cdr_usage_hourly"),
            _daily=read_layer(spark, root, "gold_subscriber_usage_daily"),
            _recon=read_layer(spark, root, "gold_reconciliation_daily"),
        )

    @property
    def derived(self) -> bool:
        """Whether every layer is still a plan over bronze, so that one pass over it can answer for several."""
        return all(t is None for t in (self._tagged, self._clean, self._quarantine, self._hourly, self._daily))

    @cached_property
    def metadata(self) -> DataFrame:
        src = self.metadata_source
        return src() if callable(src) else src

    @cached_property
    def tagged(self) -> DataFrame:
        if self._tagged is not None:
            return self._tagged
        return quality.tag_quality(self.bronze, rules=self.rules, as_of=self.as_of)

    @cached_property
    def clean(self) -> DataFrame:
        return self._clean if self._clean is not None else quality.clean_records(self.tagged)

    @cached_property
    def quarantine(self) -> DataFrame:
        return self._quarantine if self._quarantine is not None else quality.quarantine_records(self.tagged, self.as_of)

    @cached_property
    def hourly(self) -> DataFrame:
        return self._hourly if self._hourly is not None else usage.usage_hourly(self.clean)

    @cached_property
    def daily(self) -> DataFrame:
        return self._daily if self._daily is not None else usage.subscriber_daily(self.clean)

    @cached_property
    def recon(self) -> DataFrame:
        if self._recon is not None:
            return self._recon
        if self._clean is None and self._quarantine is None:
            return reconcile.reconcile_tagged(self.metadata, self.tagged, as_of=self.as_of)
        return reconcile.reconcile(self.metadata, self.bronze, self.clean, self.quarantine, as_of=self.as_of)

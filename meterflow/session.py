"""Session helpers.

The library never changes cluster-wide settings of a session it did not make.
``local_session`` is for tests, the bench and the entry module; on a cluster the
session comes from the platform and only ``checkpoint_root`` is consulted.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the pipeline relies on for correct results (not tuning).
REQUIRED_CONF = {
    # Parsing and hour extraction share the session zone; pin it.
    "spark.sql.session.timeZone": "UTC",
}

# Tuning for a local run; a cluster session sets its own.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.driver.memory": "8g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_session(app: str = "meterflow") -> SparkSession:
    """The platform's session: no master and no tuning, only what results depend on."""
    spark = SparkSession.builder.appName(app).getOrCreate()
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", app: str = "meterflow", extra: dict | None = None) -> SparkSession:
    """A ``local[cpus]`` session with the UI off."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {**LOCAL_CONF, **REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (what a cluster names); only when that is
    unset and the master is local, as in tests, a fresh scratch folder is made and
    registered. On a cluster a machine-local folder would lose files: that is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="meterflow-ckpt-", dir=os.environ.get("METERFLOW_SCRATCH", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()

"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may leave it unset (tests); a scratch folder is then made.
    On a cluster a machine-local folder would lose files, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    known = spark.sparkContext.getCheckpointDir()
    if not known:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="meterflow-llm-"))
        known = spark.sparkContext.getCheckpointDir()
    return known.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage, survives lost executors and tells the planner the
    real size, so that it broadcasts only what is below its threshold.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shielded(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let an operator use column names that begin with ``_`` whatever its first table has.

    Such columns of the table are renamed while the operator runs and get their names back.
    """

    @functools.wraps(operator)
    def run(table: DataFrame, *args, **kwargs) -> DataFrame:
        taken = set(table.columns)
        free = (name for name in (f"given{i}" for i in range(len(taken) * 2 + 1)) if name not in taken)
        own = {c: next(free) for c in table.columns if c.startswith("_")}
        done = operator(table.withColumnsRenamed(own), *args, **kwargs)
        return done.withColumnsRenamed({new: old for old, new in own.items()})

    return run

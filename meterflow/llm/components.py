"""Connected components of an edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm import scratch


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; the component is its smallest node.

    Every round hangs the larger neighbours of a node, then the smaller ones, below the
    smallest it sees. Rounds go on until no edge changes; about the logarithm of the
    longest chain are needed. Each round's edges and minima are tables in the shared folder,
    so that the joins are plain ones: minima that are small are broadcast, and where they are
    not, AQE can split the edges of a hot node.
    """
    now = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    now = scratch.materialise(now, "edges")
    before = _fingerprint(now)
    while before[0]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = scratch.materialise(least, "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.materialise(large.where("a <> b").distinct(), "edges")
        least = scratch.materialise(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = scratch.materialise(small.union(least.select("a", "m")).distinct(), "edges")
        after = _fingerprint(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)

"""Duplicate flagging: every record of a key except the first is a duplicate.

Semantics are those of ``row_number() OVER (PARTITION BY key ORDER BY order) > 1``
with a total order (the last order column must be unique per record), but the
plan never gathers one key's records into one task:

1. per key, ``count`` -- a hash aggregate with partial aggregation, so a key
   holding a third of all rows costs one row per map task before the shuffle,
   and only (key, count) crosses the network for the records of unique keys;
2. keep keys seen more than once; only their records (a left semi join) are
   reduced to ``min(struct(order))`` per key -- the first record;
3. left-join that table back on the key (NULL-safe: NULL keys form a group, as
   in a window) and flag rows whose order differs from the key's first.

The tables of steps 2 and 3 have one row per repeated key. AQE measures them
after their shuffle and broadcasts them when they are under the broadcast
threshold; above that the joins stay sort-merge and AQE splits a hot key on
the record side. Nothing here collects a group into one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_KEY = ("source_system", "cdr_id")
DEFAULT_ORDER = ("ingestion_ts", "batch_id", "source_file", "ingest_seq")


def _on_key(left: DataFrame, right: DataFrame, key: list[str], prefix: str):
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"{prefix}{i}"]) for i, k in enumerate(key)])


def repeated_keys(df: DataFrame, key=DEFAULT_KEY, order=DEFAULT_ORDER) -> DataFrame:
    """One row per key that occurs more than once: key, occurrences, first order."""
    key, order = list(key), list(order)
    counts = (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
        .select(*[F.col(k).alias(f"_rk_{i}") for i, k in enumerate(key)], "occurrences")
    )
    candidates = df.join(counts, on=_on_key(df, counts, key, "_rk_"), how="left_semi")
    first = F.struct(*[F.col(c) for c in order])
    return candidates.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences"), F.min(first).alias("first_order"))


def flag_duplicates(
    df: DataFrame,
    key=DEFAULT_KEY,
    order=DEFAULT_ORDER,
    flag: str = "is_duplicate",
    seen: DataFrame | None = None,
) -> DataFrame:
    """``df`` plus a non-NULL boolean ``flag``: true for all but the first record of a key.

    ``seen`` (optional) holds records loaded earlier (at least the key columns);
    a key found there makes every record of ``df`` with that key a duplicate.
    Only the seen keys that also occur in ``df`` are kept (a semi join), so an
    incremental load never deduplicates the whole history.
    """
    key, order = list(key), list(order)
    reps = repeated_keys(df, key, order).select(
        *[F.col(k).alias(f"_dk_{i}") for i, k in enumerate(key)], F.col("first_order").alias("_first")
    )
    on = _on_key(df, reps, key, "_dk_")
    mine = F.struct(*[F.col(c) for c in order])
    out = df.join(reps, on=on, how="left")
    dup = F.coalesce(mine != F.col("_first"), F.lit(False))
    drop = ["_first", *[f"_dk_{i}" for i in range(len(key))]]
    if seen is not None:
        earlier = seen.select(*[F.col(k).alias(f"_sk_{i}") for i, k in enumerate(key)])
        earlier = earlier.join(df, on=_on_seen(earlier, df, key), how="left_semi")
        earlier = earlier.groupBy(*[f"_sk_{i}" for i in range(len(key))]).agg(F.lit(True).alias("_seen"))
        out = out.join(earlier, on=_on_key(out, earlier, key, "_sk_"), how="left")
        dup = dup | F.coalesce(F.col("_seen"), F.lit(False))
        drop += ["_seen", *[f"_sk_{i}" for i in range(len(key))]]
    return out.withColumn(flag, dup).drop(*drop)


def _on_seen(earlier: DataFrame, df: DataFrame, key: list[str]):
    return reduce(lambda a, b: a & b, [earlier[f"_sk_{i}"].eqNullSafe(df[k]) for i, k in enumerate(key)])

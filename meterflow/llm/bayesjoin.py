"""Jaccard join of word n-grams with Bayesian pruning of candidate pairs.

1. Every text gets a MinHash signature of its distinct five-word shingles. Equal texts
   are one node from here on.
2. Nodes that agree on a band of the signature share a bucket; 32 bands of 4 miss a
   pair at the threshold with a probability below 1e-7. A bucket is not expanded into
   pairs: its nodes hang on its smallest node if their signatures agree on at least
   ``LOOSE`` of the values. Components of these links are the groups within which pairs
   are looked for, so that no group is judged by its representative alone.
3. Groups are cut into tiles of about ``TILE`` nodes; a unit of work holds two tiles (or
   several small groups), so a hot group spreads over many tasks and none exceeds a bound.
   In a unit all pairs meet: signatures are compared ``STEP`` values at a time, and a pair
   is dropped once the posterior probability (uniform prior) that its similarity reaches
   the threshold is below ``TOLERANCE``. The shingle sets of the rest are compared exactly.
   A unit returns counts and one row per node, never its pairs.
4. Components of the verified links are the classes.

The links of a group of M different texts are counted one by one, so step 3 costs M^2
signature comparisons (a few nanoseconds each) and M^2 / TILE shipped rows; equal texts cost
nothing.

Defined results: a text of fewer than five words has one shingle, all its words; a null
text or one without words links to nothing and is its own class. The class id is the
smallest doc_id of the class. Equal texts are linked with each other, so repeated rows
count as links. A null doc_id sorts after all others; a class with no other id is null.
Other columns are kept; columns named like those added are replaced. Very long texts are
hashed in slices. Empty tables give empty results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.llm import hashing, scratch
from meterflow.llm.components import components

WORDS = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 32, 4
VALUES = BANDS * BAND_ROWS
LOOSE = 0.3
STEP = 32
TOLERANCE = 1e-6
TILE = 1024
TILE_SHINGLES = 1 << 19
_FACTORS = np.random.default_rng(8191).integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_matches(values: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """The fewest equal values of ``values`` that leave P(similarity >= threshold) at ``tolerance``.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1); its upper tail at t is the
    probability that a binomial of n + 1 trials with chance t is at most m.
    """
    tail, n = 0.0, values + 1
    for m in range(values + 1):
        tail += math.comb(n, m) * threshold**m * (1 - threshold) ** (n - m)
        if tail >= tolerance:
            return m
    return values


def shingles(texts: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes by row, row of each); a short text has one shingle of all its words."""
    hashes, rows, _, _ = hashing.words(texts)
    grams, first = hashing.windows(hashes, rows, n)
    owner = rows[first]
    counts = np.bincount(rows, minlength=len(texts)) if len(rows) else np.zeros(len(texts), int)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        begin = np.searchsorted(rows, short)
        extra = np.array([hashing.mix(np.bitwise_xor.reduce(_ranked(hashes[b : b + counts[r]])).reshape(1))[0]
                          for r, b in zip(short, begin)], np.uint64)
        grams, owner = np.concatenate([grams, extra]), np.concatenate([owner, short])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[fresh], owner[fresh]


def _ranked(hashes: np.ndarray) -> np.ndarray:
    """Hashes that depend on their place."""
    return hashing.mix(hashes + np.arange(1, len(hashes) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def signatures(grams: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """(n, VALUES) MinHash values; rows without a shingle keep the largest value."""
    out = np.full((n, VALUES), 2**32 - 1, np.uint32)
    if not len(grams):
        return out
    begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    low = 0
    while low < len(begin):  # a few thousand shingles at a time stay in the cache
        high = max(low + 1, int(np.searchsorted(begin, begin[low] + 16384)))
        stop = begin[high] if high < len(begin) else len(grams)
        part, at = grams[begin[low] : stop], begin[low:high] - begin[low]
        rows = owner[begin[low:high]]
        for k in range(VALUES):
            out[rows, k] = np.minimum.reduceat(part * _FACTORS[k], at) >> np.uint64(32)
        low = high
    return out


def _sign(n: int):
    @F.arrow_udf(T.StructType().add("n_shingles", T.IntegerType()).add("sig", T.BinaryType()))
    def apply(texts: pa.Array) -> pa.Array:
        counts, sigs = [np.zeros(0, np.int32)], []
        for low, high in hashing.slices(texts):
            grams, owner = shingles(texts.slice(low, high - low), n)
            sigs += [row.tobytes() for row in signatures(grams, owner, high - low)]
            counts.append(np.bincount(owner, minlength=high - low).astype(np.int32))
        hashing.give_back()
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(counts)), pa.array(sigs, pa.binary())], ["n_shingles", "sig"]
        )

    return apply


@F.arrow_udf(T.FloatType())
def _agreement(a: pa.Array, b: pa.Array) -> pa.Array:
    """Share of equal values of two signatures."""
    left = np.frombuffer(b"".join(a.to_pylist()), np.uint32).reshape(-1, VALUES)
    right = np.frombuffer(b"".join(b.to_pylist()), np.uint32).reshape(-1, VALUES)
    return pa.array((left == right).mean(axis=1).astype(np.float32))


def _bands(sig: Column) -> Column:
    """One bucket id per band."""
    width = 4 * BAND_ROWS
    return F.array(*[F.xxhash64(F.lit(i), F.substring(sig, i * width + 1, width)) for i in range(BANDS)])


def similar_pairs(keys, sigs: np.ndarray, grams: list[np.ndarray], split: int | None, threshold: float):
    """Verified pairs (i, j) of one group; with ``split`` only pairs across that index."""
    n = len(sigs)
    steps = [(k, least_matches(k + STEP, threshold)) for k in range(0, VALUES, STEP)]
    left, right = [], []
    stop = n if split is None else split
    block = max(1, (1 << 21) // (STEP * max(n, 1)))
    for low in range(0, stop, block):
        high = min(stop, low + block)
        base = low + 1 if split is None else split
        same = (sigs[low:high, None, :STEP] == sigs[None, base:, :STEP]).sum(axis=2, dtype=np.int16)
        i, j = np.nonzero(same >= steps[0][1])
        agreed, i, j = same[i, j], i + low, j + base
        if split is None:
            ahead = j > i
            agreed, i, j = agreed[ahead], i[ahead], j[ahead]
        for at, least in steps[1:]:
            agreed = agreed + (sigs[i, at : at + STEP] == sigs[j, at : at + STEP]).sum(axis=1, dtype=np.int16)
            stay = agreed >= least
            agreed, i, j = agreed[stay], i[stay], j[stay]
        left.append(i)
        right.append(j)
    left, right = np.concatenate(left), np.concatenate(right)
    if not len(left):
        return left, right
    sizes = np.array([len(g) for g in grams], np.int64)
    shared = _shared(grams, left, right)
    found = shared >= threshold * (sizes[left] + sizes[right] - shared) - 1e-9
    return left[found], right[found]


def _shared(grams: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of these pairs, by bit sets over the shingles that two sets hold."""
    used = np.unique(np.concatenate([left, right]))
    place = np.searchsorted(used, np.arange(len(grams)))
    every = np.concatenate([grams[k] for k in used])
    owner = np.repeat(np.arange(len(used)), [len(grams[k]) for k in used])
    _, ids, counts = np.unique(every, return_inverse=True, return_counts=True)
    again = counts > 1
    ids, owner = (np.cumsum(again) - 1)[ids][again[ids]], owner[again[ids]]
    total, width, shared = int(again.sum()), 1 << 13, np.zeros(len(left), np.int64)
    l, r = place[left], place[right]
    for low in range(0, total, width):
        here = (ids >= low) & (ids < low + width)
        bits = np.zeros((len(used), min(width, -(-(total - low) // 64) * 64)), np.uint8)
        bits[owner[here], ids[here] - low] = 1
        packed = np.packbits(bits, axis=1).view(np.uint64)
        del bits
        step = max(1, (1 << 19) // packed.shape[1])
        for at in range(0, len(l), step):
            both = packed[l[at : at + step]] & packed[r[at : at + step]]
            shared[at : at + step] += np.bitwise_count(both).sum(axis=1, dtype=np.int64)
    return shared


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each index is linked to, over any number of links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _unit(threshold: float, n: int):
    """Compares the nodes of a unit: per node its verified links and the smallest node it reaches."""

    def apply(table: pa.Table) -> pa.Table:
        table = table.sort_by([("component", "ascending"), ("second", "ascending"), ("key", "ascending")])
        out = {"key": [], "root": [], "links": []}
        component = np.array(table["component"].to_pylist(), object)
        edges = np.flatnonzero(np.r_[True, component[1:] != component[:-1], True])
        for low, high in zip(edges, edges[1:]):
            part = table.slice(low, high - low)
            keys = part["key"].to_pylist()
            grams, owner = shingles(part["text"], n)
            sets = np.split(grams, np.searchsorted(owner, np.arange(1, len(keys))))
            sigs = np.frombuffer(b"".join(part["sig"].to_pylist()), np.uint32).reshape(-1, VALUES)
            copies = part["copies"].to_numpy()
            split = None
            if part["crossed"][0].as_py():
                split = len(keys) - int(np.asarray(part["second"]).sum())
                if split in (0, len(keys)):  # one of the two tiles is empty
                    continue
            i, j = similar_pairs(keys, sigs, sets, split, threshold)
            links = np.bincount(i, copies[j], len(keys)) + np.bincount(j, copies[i], len(keys))
            root = _roots(len(keys), i, j)
            linked = np.flatnonzero(links)
            out["key"] += [keys[k] for k in linked]
            out["root"] += [keys[root[k]] for k in linked]
            out["links"] += [int(links[k]) for k in linked]
        hashing.give_back()
        return pa.table(out, schema=pa.schema([("key", pa.binary()), ("root", pa.binary()), ("links", pa.int64())]))

    return apply


def _units(groups: DataFrame) -> DataFrame:
    """Each node with the units it takes part in: (unit, component, crossed, second) rows.

    ``crossed`` marks a pair of different tiles, of which a hash can leave one without nodes;
    ``second`` is 1 for nodes of its second tile.
    """
    sizes = groups.groupBy("component").agg(
        F.ceil(F.greatest(F.count("*") / TILE, F.sum("n_shingles") / TILE_SHINGLES)).cast("int").alias("tiles"),
    )
    total = groups.agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s")).first()
    packs = max(1, -(-total.n // TILE), -(-(total.s or 0) // TILE_SHINGLES))
    tiled = groups.join(sizes, "component").withColumn("tile", F.pmod(F.xxhash64(F.lit(1), "key"), F.col("tiles")))
    partner = F.when(F.col("tiles") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("tiles") - 1))
    low, high = F.least("tile", "partner"), F.greatest("tile", "partner")
    alone = F.concat_ws(":", F.lit("pack"), F.pmod(F.xxhash64("component"), F.lit(packs)))
    paired = F.concat_ws(":", F.hex("component"), low, high)
    return (
        tiled.withColumn("partner", F.explode(partner))
        .withColumn("unit", F.when(F.col("tiles") == 1, alone).otherwise(paired))
        .withColumn("crossed", (F.col("tiles") > 1) & (F.col("partner") != F.col("tile")))
        .withColumn("second", F.when(F.col("crossed") & (F.col("partner") < F.col("tile")), 1).otherwise(0))
        .drop("tiles", "tile", "partner")
    )


def classes(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD, n: int = WORDS):
    """The key of every row of ``docs``, and per key its component, class id and links."""
    key = F.unhex(F.md5(F.col(text).cast("string").cast("binary")))
    signed = docs.select(F.col("doc_id"), key.alias("key"), _sign(n)(F.col(text).cast("string")).alias("s"))
    signed = scratch.materialise(signed.select("doc_id", "key", "s.n_shingles", "s.sig"), "signatures")
    nodes = signed.where("n_shingles > 0").groupBy("key").agg(
        F.min("doc_id").alias("least_id"), F.count("*").alias("copies"),
        F.any_value("n_shingles").alias("n_shingles"), F.any_value("sig").alias("sig"),
    )
    nodes = scratch.materialise(nodes, "nodes")
    banded = nodes.select("key", F.explode(_bands(F.col("sig"))).alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("key").alias("head")).where("n > 1")
    buckets = scratch.materialise(buckets.drop("n"), "buckets")
    hung = banded.join(buckets, "bucket").where("key <> head").select("key", "head").distinct()
    sigs = nodes.select("key", "sig")
    hung = hung.join(sigs, "key").join(sigs.select(F.col("key").alias("head"), F.col("sig").alias("head_sig")), "head")
    loose = scratch.materialise(
        hung.where(_agreement("sig", "head_sig") >= LOOSE).select("key", "head"), "loose-links"
    )
    groups = components(loose, "key", "head").withColumnRenamed("node", "key").join(nodes, "key")
    groups = scratch.materialise(groups.drop("least_id"), "groups")
    texts = docs.select(key.alias("key"), F.col(text).cast("string").alias("text"))
    # copies are reduced before they meet anything: a text that a third of all rows hold is one row per task
    members = texts.groupBy("key").agg(F.any_value("text").alias("text"))
    members = members.join(groups.select("key").distinct(), "key", "left_semi")
    members = scratch.materialise(members, "group-texts")
    units = _units(groups).join(members, "key")
    units = units.select("unit", "component", "crossed", "second", "key", "sig", "copies", "text")
    verified = scratch.materialise(
        units.groupBy("unit").applyInArrow(_unit(threshold, n), "key binary, root binary, links long"), "links"
    )
    linked = components(verified.where("key <> root"), "key", "root")
    found = nodes.join(linked.withColumnRenamed("node", "key"), "key", "left").join(
        verified.groupBy("key").agg(F.sum("links").alias("links")), "key", "left"
    )
    found = found.select(
        "key", F.coalesce("component", "key").alias("component"), "least_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    ids = found.groupBy("component").agg(F.min("least_id").alias("class_id"))
    found = found.join(ids, "component").select("key", "component", "class_id", "n_links")
    return signed, scratch.materialise(found, "classes")


def near_duplicates(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, n_links) of every row of ``docs``."""
    signed, found = classes(docs, text, threshold)
    rows = signed.select("doc_id", F.when(F.col("n_shingles") > 0, F.col("key")).alias("key"))
    return rows.join(found.drop("component"), "key", "left").select(
        "doc_id",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


@scratch.shielded
def keep_one(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest doc_id, then of the smallest hash of the row.

    Rows that agree in every column are one row. Rows without words all stay. The rows meet the
    classes in one join, on the key of their text; only rows that stand several times shuffle again.
    """
    _, found = classes(docs, text, threshold)
    keyed = docs.withColumns(
        {
            "_key": F.unhex(F.md5(F.col(text).cast("string").cast("binary"))),
            "_rank": F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", F.xxhash64(*docs.columns).alias("h")),
        }
    )
    found = found.select(F.col("key").alias("_key"), "component")
    ranks = keyed.groupBy("_key", "_rank").agg(F.count("*").alias("_n")).join(found, "_key")
    first = ranks.groupBy("component").agg(F.min(F.struct("_rank", "_n")).alias("_first"))
    first = scratch.materialise(found.join(first, "component").select("_key", "_first"), "first-of-class")
    joined = keyed.join(first, "_key", "left")
    kept = joined.where(F.col("_first").isNull() | (F.col("_rank") == F.col("_first._rank")))
    several = F.coalesce(F.col("_first._n") > 1, F.lit(False))
    once = kept.where(~several).select(*docs.columns)
    return once.unionByName(kept.where(several).dropDuplicates(["_key", "_rank"]).select(*docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


#: All pairs, for tables of test size; a doc_id stands once there.
ORACLE_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
                               ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE shared.n >= 0.8 * (x.n + y.n - shared.n)
), reached AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, least(d.doc_id, coalesce(r.m, d.doc_id)) AS class_id, coalesce(l.n, 0) AS n_links
FROM docs d LEFT JOIN (SELECT a, min(b) AS m FROM reached GROUP BY a) r ON r.a = d.doc_id
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = d.doc_id
"""

"""Benchmark decontamination by a BM25 index of the test items with block-max pruning.

The items, cut into segments of at most ``SEGMENT`` words, form an inverted index whose
postings carry BM25 impacts divided by the segment's own score, so that a passage that
holds the whole segment scores 1. Every passage of every text (windows of two segment
lengths, one length apart, so that a segment never falls between two) is a query:

1. per window and block of ``BLOCK`` segments the sum of the block's largest impacts is an
   upper bound; windows without a block that can reach the threshold are passed over;
2. the others are searched by block-max WAND, which returns all segments that reach
   ``SCORE`` and skips blocks that cannot;
3. for what is found, the five-word shingles of the item's question (all but its last
   sentence) and answer (its last sentence) are looked up in the text: both must be found
   to ``OVERLAP``, or the whole item must.

Words are compared without case and punctuation of ASCII. The index is broadcast; it holds
at most ``SHARD_ITEMS`` items and ``SHARD_CHARS`` characters. A larger benchmark is worked
off shard by shard, each over all texts: its hits are written before the next index is
made, so one index is in memory at a time. What impacts and windows depend on beyond a
segment itself (how many segments hold a term, mean and largest length) is counted over
all items in Spark first, so scores do not depend on the shards.

Defined results: a null or wordless text or item matches nothing. Parts of fewer than five
words are compared by one shingle of all their words; an item of one sentence is its own
question and answer. Equal items are reported each; a repeated (item_id, text) row once.
Rows are independent, so repeated rows repeat their results. Other columns are kept.
Empty tables give empty results.
"""

from __future__ import annotations

import heapq
import math
import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.llm import hashing, scratch

K1, B = 1.2, 0.75
SEGMENT = 64
BLOCK = 4
SCORE = 0.7
SHINGLE = 5
OVERLAP = 0.8
SHARD_ITEMS = 20_000
SHARD_CHARS = 16 << 20
_SENTENCE = re.compile(r"(?<=[.!?\n])\s+(?=\S)")


def _hashes(text: str) -> np.ndarray:
    return hashing.words(pa.array([text]), fold=True)[0]


def _grams(words: np.ndarray) -> np.ndarray:
    n = min(SHINGLE, len(words))
    if not n:
        return np.zeros(0, np.uint64)
    return np.unique(hashing.windows(words, np.zeros(len(words), np.int64), n)[0])


class Item:
    """A test item: its words and the shingles of question, answer and whole."""

    def __init__(self, item_id: int, text: str):
        self.item_id = item_id
        self.words = _hashes(text)
        cut = [m.start() for m in _SENTENCE.finditer(text.strip())]
        question, answer = (text.strip()[: cut[-1]], text.strip()[cut[-1] :]) if cut else (text, text)
        parts = [_hashes(question), _hashes(answer)]
        if not all(map(len, parts)):
            parts = [self.words, self.words]
        self.sizes = [min(SHINGLE, len(p)) for p in [*parts, self.words]]
        self.parts = [_grams(p) for p in [*parts, self.words]]


def segments_of(words: np.ndarray) -> list[np.ndarray]:
    """An item's words in parts of about equal length."""
    return np.array_split(words, -(-len(words) // SEGMENT)) if len(words) else []


@dataclass
class Statistics:
    """What all segments of a benchmark have in common: number, mean and largest length, holders of each term."""

    n: int
    mean: float
    largest: int
    terms: np.ndarray  # sorted
    holders: np.ndarray


class Index:
    """Segments in blocks, postings by term, with list and block maxima.

    ``whole`` has the statistics of the benchmark that ``items`` are a part of; by default they are all of it.
    """

    def __init__(self, items: list[Item], whole: Statistics | None = None):
        self.items = [i for i in items if len(i.words)]
        segments = [(k, part) for k, item in enumerate(self.items) for part in segments_of(item.words)]
        self.owner = np.array([k for k, _ in segments], np.int64)
        self.step = whole.largest if whole else max((len(p) for _, p in segments), default=1)
        terms = [np.unique(p, return_counts=True) for _, p in segments]
        every = np.concatenate([t for t, _ in terms]) if terms else np.zeros(0, np.uint64)
        segment = np.repeat(np.arange(len(terms)), [len(t) for t, _ in terms])
        times = np.concatenate([c for _, c in terms]) if terms else np.zeros(0, np.int64)
        self.vocabulary, term = np.unique(every, return_inverse=True)
        lengths = np.array([len(p) for _, p in segments], float)
        if whole:
            n, mean, holders = whole.n, whole.mean, whole.holders[np.searchsorted(whole.terms, self.vocabulary)]
        else:
            n, mean = len(segments), lengths.mean() if len(lengths) else 1.0
            holders = np.bincount(term, minlength=len(self.vocabulary))
        idf = np.log(1 + (n - holders + 0.5) / (holders + 0.5))
        weight = idf[term] * times * (K1 + 1)
        weight /= times + K1 * (1 - B + B * lengths[segment] / max(mean, 1.0))
        weight /= np.bincount(segment, weight, len(segments))[segment] if len(segments) else 1.0
        order = np.lexsort((segment, term))
        self.segment, self.impact, term = segment[order], weight[order], term[order]
        self.begin = np.searchsorted(term, np.arange(len(self.vocabulary) + 1))
        # per term its blocks and the largest impact in each
        self.n_blocks = -(-len(segments) // BLOCK)
        pair, at = np.unique(term * max(self.n_blocks, 1) + self.segment // BLOCK, return_index=True)
        self.block = pair % max(self.n_blocks, 1)
        self.block_max = np.maximum.reduceat(self.impact, at) if len(at) else self.impact
        self.block_begin = np.searchsorted(pair // max(self.n_blocks, 1), np.arange(len(self.vocabulary) + 1))
        self.term_max = np.maximum.reduceat(self.impact, self.begin[:-1]) if len(self.vocabulary) else self.impact
        # terms in many blocks are bounded together by the most they add up to in a segment
        wide = np.diff(self.block_begin) > max(4, self.n_blocks // 16)
        self.wide = wide
        shared = np.bincount(self.segment, np.where(wide[term], self.impact, 0), len(segments))
        self.wide_most = np.zeros(self.n_blocks)
        np.maximum.at(self.wide_most, np.arange(len(segments)) // BLOCK, shared)
        self.narrow_blocks = np.where(wide, 0, np.diff(self.block_begin))
        self.present = np.zeros(1 << 22, bool)
        self.present[(self.vocabulary & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def terms(self, hashes: np.ndarray) -> np.ndarray:
        """The vocabulary's index of each word, -1 for others."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.present[(hashes & np.uint64((1 << 22) - 1)).astype(np.int64)])
        at = np.searchsorted(self.vocabulary, hashes[maybe])
        at[at == len(self.vocabulary)] = 0
        same = self.vocabulary[at] == hashes[maybe] if len(self.vocabulary) else np.zeros(len(maybe), bool)
        out[maybe[same]] = at[same]
        return out

    def hopeful(self, term: np.ndarray, window: np.ndarray, n: int, least: float) -> np.ndarray:
        """The windows of which some block's bound reaches ``least``; ``term`` and ``window`` of each known word."""
        narrow = self.narrow_blocks[term]
        some = narrow > 0
        term, window, narrow = term[some], window[some], narrow[some]
        total = int(narrow.sum())
        base = np.repeat(self.block_begin[term] - np.r_[0, np.cumsum(narrow)[:-1]], narrow) + np.arange(total)
        cell = np.repeat(window, narrow) * self.n_blocks + self.block[base]
        found = np.zeros(n, bool)
        if n * self.n_blocks <= 1 << 24:
            sums = np.bincount(cell, self.block_max[base], n * self.n_blocks).reshape(n, self.n_blocks)
            found = (sums + self.wide_most >= least - 1e-9).any(axis=1)
        else:
            cells, inverse = np.unique(cell, return_inverse=True)
            sums = np.bincount(inverse, self.block_max[base])
            found[cells[sums + self.wide_most[cells % self.n_blocks] >= least - 1e-9] // self.n_blocks] = True
            if (self.wide_most >= least - 1e-9).any():
                found[:] = True
        return found

    def wand(self, terms: np.ndarray, least: float) -> list[tuple[int, float]]:
        """All (segment, score) with a score of at least ``least``, by block-max WAND."""
        lists = [[int(self.segment[self.begin[t]]), int(self.begin[t]), int(t)] for t in terms]
        heapq.heapify(lists)
        found = []
        while lists:
            lists.sort()
            bound, pivot = 0.0, None
            for entry in lists:
                bound += self.term_max[entry[2]]
                if bound >= least - 1e-9:
                    pivot = entry[0]
                    break
            if pivot is None:
                return found
            upto = [e for e in lists if e[0] <= pivot]
            block = pivot // BLOCK
            best = sum(self._block_bound(e[2], block) for e in upto)
            if best < least - 1e-9:
                # no segment of this block up to the next list's head can reach it
                rest = [e[0] for e in lists if e[0] > pivot]
                target = min([(block + 1) * BLOCK, *rest])
                for e in upto:
                    self._seek(e, max(target, pivot + 1))
            elif lists[0][0] == pivot:
                score = float(sum(self.impact[e[1]] for e in upto))
                if score >= least - 1e-9:
                    found.append((pivot, score))
                for e in upto:
                    self._seek(e, pivot + 1)
            else:
                for e in upto:
                    if e[0] < pivot:
                        self._seek(e, pivot)
            lists = [e for e in lists if e[1] >= 0]
        return found

    def _block_bound(self, term: int, block: int) -> float:
        low, high = self.block_begin[term], self.block_begin[term + 1]
        at = low + np.searchsorted(self.block[low:high], block)
        return float(self.block_max[at]) if at < high and self.block[at] == block else 0.0

    def _seek(self, entry: list, segment: int) -> None:
        """Move a list to its first posting at or after ``segment``; -1 at its end."""
        stop = int(self.begin[entry[2] + 1])
        at = entry[1] + int(np.searchsorted(self.segment[entry[1] : stop], segment))
        entry[1] = at if at < stop else -1
        entry[0] = int(self.segment[at]) if at < stop else -1


def search(index: Index, texts: pa.Array, least: float = SCORE, overlap: float = OVERLAP) -> list[list[tuple]]:
    """Per text (item_id, score, question and answer overlap) of every item that it holds."""
    hashes, rows, _, _ = hashing.words(texts, fold=True)
    found: list[list[tuple]] = [[] for _ in range(len(texts))]
    if not len(hashes) or not index.items:
        return found
    begin = np.searchsorted(rows, np.arange(len(texts) + 1))
    place = np.arange(len(hashes)) - begin[rows]
    # window k of a text begins at word k * step and is two steps long
    first = np.r_[0, np.cumsum(-(-np.diff(begin) // index.step))]
    window = first[rows] + place // index.step
    term = index.terms(hashes)
    known = np.flatnonzero(term >= 0)
    late = known[place[known] >= index.step]
    pairs = np.r_[term[known], term[late]], np.r_[window[known], window[late] - 1]
    hopeful = np.flatnonzero(index.hopeful(*pairs, int(first[-1]), least))
    best: dict[tuple[int, int], float] = {}
    for w, row in zip(hopeful, np.searchsorted(first, hopeful, "right") - 1):
        low = begin[row] + (w - first[row]) * index.step
        seen = term[low : min(low + 2 * index.step, begin[row + 1])]
        for segment, score in index.wand(np.unique(seen[seen >= 0]), least):
            key = int(row), int(index.owner[segment])
            best[key] = max(best.get(key, 0.0), score)
    grams: dict[tuple[int, int], np.ndarray] = {}
    for (row, k), score in sorted(best.items()):
        item, shares = index.items[k], []
        for size, part in zip(item.sizes, item.parts):
            if (row, size) not in grams:
                words = hashes[begin[row] : begin[row + 1]]
                grams[row, size] = hashing.windows(words, np.zeros(len(words), np.int64), size)[0]
            shares.append(float(np.isin(part, grams[row, size]).mean()))
        if min(shares[:2]) >= overlap or shares[2] >= overlap:
            found[row].append((item.item_id, min(score, 1.0), shares[0], shares[1]))
    return found


_HIT = T.ArrayType(
    T.StructType().add("item_id", T.LongType()).add("score", T.DoubleType())
    .add("question_overlap", T.DoubleType()).add("answer_overlap", T.DoubleType())
)
_ARROW_HIT = pa.list_(
    pa.struct(
        [("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())]
    )
)


def _looker(index, least: float, overlap: float):
    @F.arrow_udf(_HIT)
    def look(texts: pa.Array) -> pa.Array:
        names = ("item_id", "score", "question_overlap", "answer_overlap")
        hits = []
        for low, high in hashing.slices(texts):
            hits += search(index.value, texts.slice(low, high - low), least, overlap)
        hashing.give_back()
        return pa.array([[dict(zip(names, h)) for h in row] for row in hits], _ARROW_HIT)

    return look


def _shards(benchmark: DataFrame, text: str) -> list[DataFrame]:
    """The items in parts that keep to the bounds of one index."""
    items = benchmark.where(F.col(text).isNotNull()).select("item_id", F.col(text).alias("text")).distinct()
    size = items.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("c")).first()
    most = max(size.n / SHARD_ITEMS, (size.c or 0) / SHARD_CHARS)
    n = 1 if most <= 1 else math.ceil(1.2 * most)
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def _term_rows(items: DataFrame) -> DataFrame:
    """(term, size): a row for each term of each segment, and one with a null term for the segment itself."""

    def task(batches):
        for batch in batches:
            terms, sizes = [], []
            for text in batch.column(0).to_pylist():
                for part in segments_of(_hashes(text)):
                    found = np.unique(part).astype(np.int64).tolist()
                    terms += [None, *found]
                    sizes += [len(part)] * (len(found) + 1)
            yield pa.RecordBatch.from_pydict({"term": pa.array(terms, pa.int64()), "size": pa.array(sizes, pa.int64())})

    return items.select("text").mapInArrow(task, "term long, size long")


def _statistics(shard: DataFrame, holders: DataFrame, totals) -> Statistics:
    """Statistics of the whole benchmark for the terms of a shard; only these reach the driver."""
    own = _term_rows(shard).select("term").where("term IS NOT NULL").distinct().join(holders, "term").toPandas()
    terms = own["term"].to_numpy(np.int64).astype(np.uint64)
    order = np.argsort(terms)
    return Statistics(totals.n, totals.length / totals.n, totals.largest, terms[order], own["n"].to_numpy(np.int64)[order])


def _index(shard: DataFrame, whole: Statistics | None = None) -> Index:
    return Index([Item(r.item_id, r.text) for r in shard.orderBy("item_id", "text").collect()], whole)


def _in_turn(docs: DataFrame, shards: list[DataFrame], text: str, to: str, bounds: tuple[float, float]) -> DataFrame:
    """``matches`` with several indexes: rows get a number, each index's hits are a table of their own."""
    sc = docs.sparkSession.sparkContext
    rows = _term_rows(reduce(DataFrame.unionByName, shards))
    totals = rows.where("term IS NULL").agg(F.count("*").alias("n"), F.sum("size").alias("length"), F.max("size").alias("largest")).first()
    holders = scratch.materialise(rows.where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("n")), "benchmark-terms")
    numbered = scratch.materialise(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    hits = []
    for shard in shards:
        shared = sc.broadcast(_index(shard, _statistics(shard, holders, totals) if totals.n else None))
        found = numbered.select("_row", _looker(shared, *bounds)(F.col(text).cast("string")).alias("_hits")).where(F.size("_hits") > 0)
        hits.append(scratch.materialise(found, "benchmark-hits"))
        shared.destroy()
    every = reduce(DataFrame.unionByName, hits).groupBy("_row").agg(F.flatten(F.collect_list("_hits")).alias("_hits"))
    # the order of one index: by item
    every = every.withColumn("_hits", F.array_sort("_hits"))
    return numbered.join(every, "_row", "left").withColumn(to, F.coalesce("_hits", F.array().cast(_HIT))).drop("_row", "_hits")


@scratch.shielded
def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    to: str = "benchmark_items",
    least: float = SCORE,
    overlap: float = OVERLAP,
) -> DataFrame:
    """``docs`` with the array of the test items that each text holds."""
    shards = _shards(benchmark, "text")
    if len(shards) > 1:
        return _in_turn(docs, shards, text, to, (least, overlap))
    index = docs.sparkSession.sparkContext.broadcast(_index(shards[0]))
    return docs.withColumn(to, _looker(index, least, overlap)(F.col(text).cast("string")))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", least: float = SCORE, overlap: float = OVERLAP
) -> DataFrame:
    """One row per row of ``docs`` and test item that it holds: doc_id, item_id and scores."""
    hit = matches(docs.select("doc_id", F.col(text).alias("text")), benchmark, least=least, overlap=overlap)
    return hit.select("doc_id", F.explode("benchmark_items").alias("h")).select("doc_id", "h.*")


@scratch.shielded
def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a test item."""
    return matches(docs, benchmark, text, "_items").where(F.size("_items") == 0).drop("_items")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

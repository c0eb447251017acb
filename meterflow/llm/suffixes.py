"""Repeated passages by sparse suffix arrays.

1. Of each text only the suffixes that begin at a minimiser are kept: the position of the
   smallest hash of ``GRAM`` words among ``WINDOW`` consecutive ones. Equal passages keep equal
   positions, and a passage of ``MIN_WORDS`` words keeps one with at least ``KEY_WORDS`` words
   to its right.
2. The kept suffixes of all texts are sorted by the hash of their first ``KEY_WORDS`` words, and
   neighbours are compared. Sorting is by range over (hash, text, position), so that a passage
   that a third of all texts hold is spread over many tasks; what a range's first and last run
   share with other ranges is settled from one row per run.
3. Matches are extended to the left and right over whole words: every run of ``MIN_WORDS`` words
   around a matched suffix is hashed, sorted and compared with its neighbours in the same way.
   Runs that another text holds too are joined to maximal spans.

A span is thus a passage of which every run of ``MIN_WORDS`` words also stands in another
document. Equal texts are one text here; a text that several rows hold is repeated as a whole.

Words are compared by 64-bit hashes. Spans count words: runs of characters other than ASCII
white space.

Defined results: null texts and texts under ``MIN_WORDS`` words have no spans. A passage that
repeats within one document only is none. Repeated rows, also of one doc_id, count as copies.
Other columns are not needed; long texts are hashed in slices. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import hashing, scratch

MIN_WORDS = 50
GRAM = 6
WINDOW = 32
KEY_WORDS = MIN_WORDS - WINDOW + 1
ROW_SCHEMA = "key long, node long, pos int"
_ARROW = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("pos", pa.int32())])
_MARKED = pa.schema([*_ARROW, ("other", pa.int64()), ("state", pa.int8())])
#: States of what a range returns: a row that is repeated, one that its neighbours may decide, a run at its edge.
REPEATED, OPEN, EDGE = 0, 1, 2


def minimisers(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Indices of the words at which a kept suffix begins."""
    grams, first = hashing.windows(hashes, rows, GRAM)
    if len(grams) < WINDOW:
        return np.zeros(0, np.int64)
    whole = np.flatnonzero(rows[first[: len(grams) - WINDOW + 1]] == rows[first[WINDOW - 1 :]])
    least = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)[whole].argmin(axis=1)
    return np.unique(first[whole + least])


def _table(keys, nodes, pos) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(keys.astype(np.uint64).view(np.int64)), pa.array(nodes.astype(np.int64)), pa.array(pos.astype(np.int32))],
        schema=_ARROW,
    )


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kept suffixes of each text; a row without key gives the words of a text that has enough."""
    for batch in batches:
        nodes, texts = batch.column(0).to_numpy(), batch.column(1)
        for low, high in hashing.slices(texts):
            hashes, rows, _, _ = hashing.words(texts.slice(low, high - low))
            counts = np.bincount(rows, minlength=high - low)
            begin = np.r_[0, np.cumsum(counts)]
            keys, first = hashing.windows(hashes, rows, KEY_WORDS)
            at = minimisers(hashes, rows)
            found = np.searchsorted(first, at)
            inside = (found < len(first)) & (counts[rows[at]] >= MIN_WORDS)
            inside[inside] = first[found[inside]] == at[inside]
            at, found = at[inside], found[inside]
            if len(at):
                yield _table(keys[found], nodes[low + rows[at]], at - begin[rows[at]])
            long = np.flatnonzero(counts >= MIN_WORDS)
            sizes = [pa.nulls(len(long), pa.int64()), pa.array(nodes[low + long]), pa.array(counts[long].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(sizes, schema=_ARROW)
        hashing.give_back()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per node, text and matched positions in: the hashes of the runs of words around them."""
    for batch in batches:
        nodes, texts, spots = batch.column(0).to_numpy(), batch.column(1), batch.column(2)
        for low, high in hashing.slices(texts):
            hashes, rows, _, _ = hashing.words(texts.slice(low, high - low))
            begin = np.r_[0, np.cumsum(np.bincount(rows, minlength=high - low))]
            keys, first = hashing.windows(hashes, rows, MIN_WORDS)
            marks = spots.slice(low, high - low)
            owner = np.repeat(np.arange(high - low), marks.value_lengths().to_numpy())
            at = begin[owner] + marks.flatten().to_numpy()
            near = np.zeros(len(hashes) + WINDOW, np.int32)  # +1 where a stretch of wanted starts begins, -1 behind it
            np.add.at(near, np.maximum(at - WINDOW + 1, begin[owner]), 1)
            np.add.at(near, at + 1, -1)
            chosen = np.flatnonzero(np.cumsum(near)[first] > 0)
            if len(chosen):
                at = first[chosen]
                yield _table(keys[chosen], nodes[low + rows[at]], at - begin[rows[at]])
        hashing.give_back()


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by (key, node, pos): the rows whose key another node has too.

    Of an open run only the rows of its first node are held back; later nodes settle it.
    """

    def marked(keys, nodes, pos, other, state):
        return pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(nodes), pa.array(pos), pa.array(other), pa.array(np.full(len(keys), state, np.int8))],
            schema=_MARKED,
        )

    def held(key, node, rows, state):
        rows = np.concatenate(rows)
        n = len(rows)
        return marked(np.full(n, key), np.full(n, node), rows, np.full(n, node), state)

    def edge(key, low, high):
        return marked(*(np.array([x], np.int64) for x in (key, low)), np.array([-1], np.int32), np.array([high], np.int64), EDGE)

    run = None  # key, first node, held rows of it, last node, whether it is the range's first run
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, nodes, pos = (batch.column(i).to_numpy() for i in range(3))
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        ends = np.r_[starts[1:], len(keys)]
        low_node, high_node = nodes[starts], nodes[ends - 1]
        # runs inside the batch are settled together; the first and last may go on
        size = ends - starts
        inner = np.ones(len(starts), bool)
        inner[[0, -1]] = False
        twice = np.repeat(inner & (low_node != high_node), size)
        if twice.any():
            yield marked(keys[twice], nodes[twice], pos[twice], nodes[twice], REPEATED)
        for k in dict.fromkeys((0, len(starts) - 1)):
            s, e = starts[k], ends[k]
            if run is None or run[0] != keys[s]:
                if run is not None:
                    yield from _close(run, held, edge, False)
                run = [keys[s], nodes[s], [], nodes[s], run is None]
            own = nodes[s:e] == run[1]
            if run[2] is not None:
                run[2].append(pos[s:e][own])
                if not own.all():
                    yield held(run[0], run[1], run[2], REPEATED)
                    run[2] = None
            else:
                own[:] = False
            if not own.all():
                rest = ~own
                yield marked(keys[s:e][rest], nodes[s:e][rest], pos[s:e][rest], nodes[s:e][rest], REPEATED)
            run[3] = nodes[e - 1]
    if run is not None:
        yield from _close(run, held, edge, True)


def _close(run, held, edge, last):
    key, first, rows, node, opening = run
    if opening or last:
        yield edge(key, first, node)
        if rows is not None:
            yield held(key, first, rows, OPEN)


def repeated(rows: DataFrame) -> DataFrame:
    """The (node, pos) of ``rows`` (key, node, pos) whose key two different nodes have."""
    order = ["key", "node", "pos"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = ROW_SCHEMA + ", other long, state byte"
    marked = scratch.materialise(ranged.mapInArrow(_neighbours, schema), "neighbours")
    shared = marked.where(F.col("state") == EDGE).groupBy("key").agg(F.min("node").alias("a"), F.max("other").alias("b"))
    settled = marked.where(F.col("state") == OPEN).join(shared.where("a <> b").select("key"), "key", "left_semi")
    return marked.where(F.col("state") == REPEATED).select("node", "pos").union(settled.select("node", "pos")).distinct()


def spans_of(starts, length: int):
    """Maximal spans of the union of [start, start + length) over an array of starts."""
    return [
        F.filter(starts, lambda p, i: (i == 0) | (p > F.get(starts, i - 1) + length)),
        F.transform(
            F.filter(starts, lambda p, i: (i == F.size(starts) - 1) | (F.get(starts, i + 1) > p + length)),
            lambda p: p + length,
        ),
    ]


def repeated_passages(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, start_word, end_word) of every maximal repeated span of every row of ``docs``."""
    held = docs.where(F.col(text).isNotNull()).select(
        "doc_id", F.col(text).cast("string").alias("text"), F.xxhash64(F.col(text).cast("string")).alias("node")
    )
    kept = scratch.materialise(held.select("node", "text").mapInArrow(_suffixes, ROW_SCHEMA), "suffixes")
    spots = repeated(kept.where("key IS NOT NULL")).groupBy("node").agg(F.collect_list("pos").alias("spots"))
    spots = scratch.materialise(spots, "matched-suffixes")
    texts = held.groupBy("node").agg(F.any_value("text").alias("text"))
    around = texts.join(spots, "node").select("node", "text", "spots")
    runs = scratch.materialise(around.mapInArrow(_runs, ROW_SCHEMA), "runs")
    starts = repeated(runs).groupBy("node").agg(F.array_sort(F.collect_list("pos")).alias("starts"))
    starts = starts.withColumn("begin", spans_of(F.col("starts"), MIN_WORDS)[0])
    starts = starts.withColumn("end", spans_of(F.col("starts"), MIN_WORDS)[1])
    copied = (
        kept.where("key IS NULL").groupBy("node").agg(F.count("*").alias("n"), F.max("pos").alias("words")).where("n > 1")
    )
    whole = copied.select("node", F.array(F.struct(F.lit(0).alias("start_word"), F.col("words").alias("end_word"))).alias("whole"))
    parts = starts.select(
        "node",
        F.zip_with("begin", "end", lambda a, b: F.struct(a.alias("start_word"), b.alias("end_word"))).alias("parts"),
    )
    spans = scratch.materialise(
        parts.join(whole, "node", "full").select("node", F.coalesce("whole", "parts").alias("spans")), "spans"
    )
    return held.select("doc_id", "node").join(spans, "node").select("doc_id", F.inline("spans"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of at least ``MIN_WORDS`` words that another document holds too."""
    return repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


#: All runs of words, for tables of test size; a doc_id stands once there.
ORACLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), runs AS (
  SELECT doc_id, i, md5(array_to_string(w[i + 1:i + 50], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(generate_series(0, len(w) - 50)) AS i FROM docs WHERE len(w) >= 50)
), held AS (
  SELECT h FROM runs GROUP BY h HAVING count(DISTINCT doc_id) > 1
), hits AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh
  FROM runs SEMI JOIN held USING (h)
), spans AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM hits
)
SELECT doc_id, CAST(min(i) AS INTEGER) AS start_word, CAST(max(i) + 50 AS INTEGER) AS end_word FROM spans GROUP BY doc_id, span
"""

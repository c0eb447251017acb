"""Language ID by a small convolutional network over bytes.

Bytes are embedded, filters of several widths slide over fixed-length windows, each
filter keeps its maximum over the window, and a softmax layer gives the languages.
The network is trained here, in numpy, on a bounded sample of labelled texts
(``SAMPLE_DOCS`` documents in all, spread evenly over the languages and drawn by a
hash of the text; ``SAMPLE_WINDOWS`` windows of each). Prediction covers every byte
of every text: the text is cut into windows, and the windows' probabilities are
averaged by the letters they hold.

Embedding and filters are linear, so for prediction they are folded into one table
per filter offset: a window is then a few table look-ups, additions and a maximum.

``trained_on(docs, junk=True)`` learns one more class, ``JUNK``: texts made from the sample by
mixing up the letters of their words, or drawing them at random, which are no language.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so
is every text if there is nothing to learn from. Texts with a null label are not
learned from. Ties go to the language that sorts first. Equal rows get equal
results; other columns are kept, and columns named like those added are replaced.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import scratch
from meterflow.llm.hashing import utf8

UNKNOWN = "und"
#: The class of texts that are no language; no language has this label.
JUNK = "~junk"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 8
SAMPLE_DOCS = 3000
SAMPLE_WINDOWS = 4
#: Characters of a text that training reads; prediction reads all.
SAMPLE_CHARS = 20_000
#: Characters of a text that may be told as junk; a few words may be anything.
JUNK_CHARS = 100
EPOCHS = 6
BATCH = 64
#: Small samples are gone through more often, up to this number of steps.
LEAST_STEPS = 200
#: Windows that are worked on at once.
BLOCK = 48
_LETTER = regex.compile(r"\p{L}")
_IS_LETTER = np.zeros(256, np.float32)
_IS_LETTER[[*range(65, 91), *range(97, 123), *range(0xC3, 0x100)]] = 1


@dataclass
class Network:
    """Trained weights; ``labels`` in the order of the softmax outputs."""

    labels: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    filter_bias: list[np.ndarray]
    dense: np.ndarray
    dense_bias: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """Per width and offset the contribution of each byte to each filter."""
        return [[self.embedding @ w[k] for k in range(len(w))] for w in self.filters]


def byte_windows(raw: np.ndarray) -> np.ndarray:
    """Consecutive windows over the bytes, the last one filled up with zeros."""
    out = np.zeros((max(1, -(-len(raw) // WINDOW)), WINDOW), np.uint8)
    out.reshape(-1)[: len(raw)] = raw
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def fit(texts: list[str], labels: list[str], seed: int = 7) -> Network:
    """Train a network by Adam on windows of these texts; equal input gives an equal network."""
    names = sorted(set(labels))
    x = [byte_windows(np.frombuffer(t.encode(), np.uint8)) for t in texts]
    rng = np.random.default_rng(seed)
    picks = [rng.permutation(len(w))[:SAMPLE_WINDOWS] for w in x]
    y = np.repeat([names.index(n) for n in labels], [len(p) for p in picks])
    x = np.concatenate([w[p] for w, p in zip(x, picks)])
    weights = [rng.normal(0, 0.5, (256, EMBEDDING))]
    weights += [rng.normal(0, (w * EMBEDDING) ** -0.5, (w, EMBEDDING, FILTERS)) for w in WIDTHS]
    weights += [np.zeros(FILTERS) for _ in WIDTHS]
    weights += [rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(names))), np.zeros(len(names))]
    weights = [w.astype(np.float32) for w in weights]
    n, moment, speed, step = len(WIDTHS), [0 * w for w in weights], [0 * w for w in weights], 0
    for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // len(x)))):
        order = rng.permutation(len(x))
        for low in range(0, len(x), BATCH):
            at = order[low : low + BATCH]
            grads = _gradients(weights, x[at], y[at], n)
            step += 1
            for w, g, m, v in zip(weights, grads, moment, speed):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return Network(names, weights[0], weights[1 : 1 + n], weights[1 + n : 1 + 2 * n], weights[-2], weights[-1])


def _gradients(weights, x: np.ndarray, y: np.ndarray, n: int) -> list[np.ndarray]:
    """Gradients of the mean cross-entropy; only the place of each maximum passes one back."""
    embedding, dense = weights[0], weights[-2]
    e, rows = embedding[x], np.arange(len(x))
    pooled, places = [], []
    for width, (w, b) in enumerate(zip(weights[1 : 1 + n], weights[1 + n : 1 + 2 * n])):
        span = WINDOW - len(w) + 1
        out = sum(e[:, k : k + span] @ w[k] for k in range(len(w)))
        place = out.argmax(axis=1)
        pooled.append(np.maximum(np.take_along_axis(out, place[:, None], 1)[:, 0] + b, 0))
        places.append(place)
    hidden = np.concatenate(pooled, axis=1)
    error = _softmax(hidden @ dense + weights[-1])
    error[rows, y] -= 1
    error /= len(x)
    grads = [np.zeros_like(w) for w in weights]
    grads[-2], grads[-1] = hidden.T @ error, error.sum(axis=0)
    back = np.split((error @ dense.T) * (hidden > 0), n, axis=1)
    for width in range(n):
        w, place, g = weights[1 + width], places[width], back[width]
        grads[1 + n + width] = g.sum(axis=0)
        for k in range(len(w)):
            seen = x[rows[:, None], place + k]
            grads[1 + width][k] = np.einsum("bfe,bf->ef", embedding[seen], g)
            np.add.at(grads[0], seen, g[..., None] * w[k].T[None])
    return grads


def window_probabilities(net: Network, tables, windows: np.ndarray) -> np.ndarray:
    """Softmax outputs of each window."""
    out = np.empty((len(windows), len(net.labels)), np.float32)
    for low in range(0, len(windows), BLOCK):
        x = np.ascontiguousarray(windows[low : low + BLOCK].T)
        pooled = []
        for table, bias in zip(tables, net.filter_bias):
            span = WINDOW - len(table) + 1
            total = table[0].take(x[:span], axis=0)
            for k in range(1, len(table)):
                total += table[k].take(x[k : k + span], axis=0)
            pooled.append(np.maximum(total.max(axis=0) + bias, 0))
        out[low : low + BLOCK] = _softmax(np.concatenate(pooled, axis=1) @ net.dense + net.dense_bias)
    return out


def predict(net: Network, tables, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of every whole text of a batch."""
    raw, at = utf8(texts)
    labels, scores = [], np.zeros(len(texts))
    for i, text in enumerate(texts):
        if not net.labels or not _LETTER.search(text.as_py() or ""):
            labels.append(UNKNOWN)
            continue
        windows = byte_windows(raw[at[i] : at[i + 1]])
        weight = _IS_LETTER[windows].sum(axis=1) + 1e-3
        mean = weight @ window_probabilities(net, tables, windows) / weight.sum()
        best = int(mean.argmax())
        labels.append(net.labels[best])
        scores[i] = min(1.0, float(mean[best]))
    return labels, scores


def sample(docs: DataFrame, text: str = "text", label: str = "lang") -> pd.DataFrame:
    """At most ``SAMPLE_DOCS`` labelled texts, evenly over the languages, the same for the same rows.

    Rows are drawn by the hash of their text below a share that their language's
    count sets; the driver receives no more than about twice the bound.
    """
    known = docs.where(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counts = docs.where(F.col(label).isNotNull()).groupBy(label).count()
    counts = counts.orderBy(F.desc("count"), label).limit(SAMPLE_DOCS).collect()
    if not counts:
        return pd.DataFrame({"text": [], "label": []})
    each = max(1, SAMPLE_DOCS // len(counts))
    draw = (F.xxhash64(text) / F.lit(2.0**63) + 1) / 2
    share = F.create_map(*[F.lit(v) for r in counts for v in (r[label], min(1.0, 2 * each / r["count"]))])
    drawn = known.select(F.substring(text, 1, SAMPLE_CHARS).alias("text"), F.col(label).alias("label"), draw.alias("u"))
    rows = drawn.where(F.col("u") < share[F.col("label")]).dropDuplicates(["text", "label"])
    rows = rows.orderBy("u", "label").limit(2 * SAMPLE_DOCS).toPandas()
    return rows.sort_values(["label", "u", "text"]).groupby("label").head(each)[["text", "label"]]


@scratch.shielded
def identify(docs: DataFrame, net: Network, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` of every whole text."""
    tables = net.tables()

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def apply(texts: pa.Array) -> pa.Array:
        labels, scores = predict(net, tables, texts)
        return pa.StructArray.from_arrays([pa.array(labels, pa.string()), pa.array(scores)], ["lang_pred", "score"])

    found = docs.withColumn("_lang", apply(F.col(text).cast("string")))
    return found.withColumns({"lang_pred": F.col("_lang.lang_pred"), "score": F.col("_lang.score")}).drop("_lang")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def junk_of(text: str, rng: random.Random, kind: int) -> str:
    """A text that is no language, as long as ``text`` and with its white space."""
    if kind == 0:  # its own letters in any order
        letters = [c for c in text if not c.isspace()]
        rng.shuffle(letters)
        given = iter(letters)
        return "".join(c if c.isspace() else next(given) for c in text)
    pool = ["abcdefghijklmnopqrstuvwxyz", "".join(map(chr, range(33, 127)))][kind - 1]
    return "".join(c if c.isspace() else rng.choice(pool) for c in text)


def trained_on(docs: DataFrame, junk: bool = False) -> Network:
    """The network learned from the documents that are not held out; ``junk`` adds a class as large as a language's."""
    learn = sample(docs.where(~held_out(F.col("doc_id"))))
    if not len(learn):
        return Network([], *[np.zeros((0, 0))] * 5)
    texts, labels = list(learn["text"]), list(learn["label"])
    if junk:
        rng = random.Random(11)
        made = [junk_of(t, rng, i % 3) for i, t in enumerate(texts[:: len(set(labels))]) if len(t) >= JUNK_CHARS]
        texts, labels = texts + made, labels + [JUNK] * len(made)
    return fit(texts, labels)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = identify(docs.drop("lang"), trained_on(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

"""op3: held-out accuracy, exactness of the folded tables, and defined cases."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from meterflow.llm import bytecnn
from tests.llm import tables

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def net(documents):
    return bytecnn.trained_on(documents)


def test_held_out_accuracy(spark, documents):
    rows = bytecnn.query(spark, SF).collect()
    lang = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r.held_out]
    assert len(out) > 200 and np.mean([r.lang_pred == lang[r.doc_id] for r in out]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_tables_equal_the_convolution(net):
    windows = bytecnn.byte_windows(np.frombuffer(("été de la plume " * 60).encode(), np.uint8))
    got = bytecnn.window_probabilities(net, net.tables(), windows)
    hidden = []
    for w, b in zip(net.filters, net.filter_bias):
        span = bytecnn.WINDOW - len(w) + 1
        out = np.stack([np.einsum("bke,kef->bf", net.embedding[windows[:, i : i + len(w)]], w) for i in range(span)])
        hidden.append(np.maximum(out.max(axis=0) + b, 0))
    want = np.concatenate(hidden, axis=1) @ net.dense + net.dense_bias
    want = np.exp(want - want.max(axis=1, keepdims=True))
    assert np.allclose(got, want / want.sum(axis=1, keepdims=True), atol=1e-4)


def test_training_is_repeatable():
    texts, labels = [tables.prose(i, 60) for i in range(6)] + ["ñandú óé " * 20] * 3, ["en"] * 6 + ["es"] * 3
    a, b = bytecnn.fit(texts, labels), bytecnn.fit(texts, labels)
    assert (a.dense == b.dense).all() and (a.embedding == b.embedding).all()
    assert bytecnn.predict(a, a.tables(), pa.array(["óé ñandú ñ óé " * 9]))[0] == ["es"]


def test_whole_text_counts(net):
    english, german = "the of and to with that " * 40, "über der die das größe nicht schön für " * 400
    labels, _ = bytecnn.predict(net, net.tables(), pa.array([english, german, english + german]))
    assert labels[0] == "en" and labels[1] == labels[2] == "de"  # the long rest outweighs the beginning


def test_awkward_rows(spark, net):
    rows = tables.awkward(spark)
    got = bytecnn.identify(rows, net)
    assert got.columns == [*rows.columns, "lang_pred", "score"]
    by_id = {r.doc_id: r for r in got.collect()}
    assert {i for i, r in by_id.items() if r.lang_pred == "und"} == {1, 2, 3, 9}
    assert all(by_id[i].score == 0 for i in (1, 2, 3, 9)) and by_id[8].lang_pred in net.labels


def test_nothing_to_learn(spark):
    rows = tables.docs(spark, [(1, "some words", None, "a"), (2, None, "en", "a")])
    none = bytecnn.trained_on(rows)
    assert [r.lang_pred for r in bytecnn.identify(rows, none).collect()] == ["und", "und"]
    assert bytecnn.identify(tables.no_rows(spark), bytecnn.trained_on(tables.no_rows(spark))).count() == 0


def test_sample_is_bounded(spark, documents, monkeypatch):
    monkeypatch.setattr(bytecnn, "SAMPLE_DOCS", 40)
    drawn = bytecnn.sample(documents)
    assert len(drawn) <= 40 and set(drawn.groupby("label").size()) <= set(range(1, 11))
    assert drawn.equals(bytecnn.sample(documents.repartition(7)))

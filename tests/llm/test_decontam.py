"""op5: block-max WAND against full scoring, and planted items against plain search."""

import numpy as np
import pyarrow as pa
import pytest

from meterflow.llm import decontam
from tests.llm import tables

ITEMS = "item_id long, text string"


def index_of(n, words=30):
    return decontam.Index([decontam.Item(i, tables.prose(i, words + i % 90)) for i in range(n)])


@pytest.mark.parametrize("block", [1, 4, 16])
def test_wand_returns_all_above_the_threshold(monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK", block)
    index, rng = index_of(120), np.random.default_rng(1)
    assert max(np.bincount(index.owner)) > 1  # long items are several segments
    for _ in range(150):
        item = index.items[rng.integers(len(index.items))]
        terms = np.unique(np.r_[index.terms(item.words)[: rng.integers(2, 60)], rng.integers(0, len(index.vocabulary), 40)])
        least = rng.choice([0.1, 0.3, 0.7])
        scores = np.zeros(len(index.owner))
        for t in terms:
            np.add.at(scores, index.segment[index.begin[t] : index.begin[t + 1]], index.impact[index.begin[t] : index.begin[t + 1]])
        found = dict(index.wand(terms, least))
        assert set(found) == set(np.flatnonzero(scores >= least - 1e-9))
        assert all(abs(scores[s] - v) < 1e-9 for s, v in found.items())


def test_window_bound_never_loses(monkeypatch):
    index = index_of(60)
    texts = [tables.prose(900 + i, 40 + 3 * i) + " " + tables.prose(i, 30 + i % 90) + " " + tables.prose(800 + i, 70) for i in range(60)]
    found = decontam.search(index, pa.array([*texts, None, "", "x"]))
    assert [i in [h[0] for h in row] for i, row in enumerate(found[:60])] == [True] * 60
    assert found[60:] == [[], [], []]


def test_benchmark_of_the_test_data(spark):
    sf = "/root/testdata/sf0.01"
    got = {(r.doc_id, r.item_id) for r in decontam.query(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    want = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in (d.text or "")}
    assert want and want <= got
    for doc, item in got - want:  # what else is reported holds most of the item's five-word runs
        words = [tables.words(r.text.lower()) for r in (docs[doc], items[item])]
        runs = [set(zip(*[w[k:] for k in range(5)])) for w in words]
        assert len(runs[0] & runs[1]) >= 0.7 * len(runs[1])


def test_question_and_answer_must_be_found(spark):
    item = tables.prose(5, 30).replace(".", "") + ". " + tables.prose(6, 12).replace(".", "") + "."
    question, answer = item.split(". ")
    rows = tables.docs(spark, [(1, f"x y. {item.upper()} z"), (2, question), (3, answer), (4, None), (5, item), (5, item)])
    bench = spark.createDataFrame([(1, item), (1, item), (2, item), (3, None), (4, ""), (None, "a b c")], ITEMS)
    got = decontam.contaminated(rows, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == sorted([(1, 1), (1, 2)] + [(5, 1), (5, 2)] * 2)
    assert all(0.99 < r.score <= 1 and r.question_overlap == r.answer_overlap == 1 for r in got)
    kept = decontam.clean(rows, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4] and kept.columns == rows.columns


def test_shards_and_empty_tables(spark, monkeypatch):
    bench = spark.createDataFrame([(i, tables.prose(i, 40)) for i in range(12)], ITEMS)
    rows = tables.docs(spark, [(i, tables.prose(i, 40)) for i in range(12)])
    whole = sorted((r.doc_id, r.item_id) for r in decontam.contaminated(rows, bench).collect())
    assert whole == [(i, i) for i in range(12)]
    monkeypatch.setattr(decontam, "SHARD_ITEMS", 4)
    assert len(decontam._shards(bench, "text")) > 2
    assert sorted((r.doc_id, r.item_id) for r in decontam.contaminated(rows, bench).collect()) == whole
    assert decontam.contaminated(rows, bench.limit(0)).count() == 0
    assert decontam.contaminated(tables.no_rows(spark), bench).count() == 0
    assert decontam.clean(tables.awkward(spark), bench.where("item_id > 3")).count() == 10


def noisy(text, rng, share):
    """The text with some of its words replaced."""
    return " ".join("zz%d" % rng.integers(10**6) if rng.random() < share else w for w in text.split())


def test_scores_do_not_depend_on_the_shards(spark, monkeypatch):
    """Passages near the threshold of the score, and near that of the overlap: the same rows at 1, 3 and 12 shards."""
    rng = np.random.default_rng(6)
    items = [(i, tables.prose(i, int(rng.integers(30, 62)))) for i in range(36)]
    bench = spark.createDataFrame(items, ITEMS)
    texts = [(1000 * k + i, f"x {noisy(t, rng, share)} y") for i, t in items for k, share in enumerate([0, 0.05, 0.15, 0.25, 0.35])]
    texts += [(10**6, None), (10**6, items[0][1])]
    rows = tables.docs(spark, texts)

    def found():
        got = decontam.contaminated(rows, bench, overlap=0.1).collect()
        return sorted((r.doc_id, r.item_id, round(r.score, 9), round(r.question_overlap, 9), round(r.answer_overlap, 9)) for r in got)

    whole = found()
    assert 36 < len(whole) < 200 and any(r[2] < 0.8 for r in whole)
    for most in (18, 9):
        monkeypatch.setattr(decontam, "SHARD_ITEMS", most)
        assert len(decontam._shards(bench, "text")) >= 36 // most
        assert found() == whole
    assert decontam.clean(rows, bench).columns == rows.columns

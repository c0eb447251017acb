"""The stages of the pipeline: order, columns, and that their decisions take effect."""

import random

import pytest

import corpus_pipeline
from meterflow.llm import bytecnn, decontam, mixing, secrets
from meterflow.llm.guesscost import Ranks
from tests.llm import tables
from tests.llm.test_mixing import brute as mixture
from tests.llm.test_mixing import by_number
from tests.llm.test_pairs import brute_classes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        rows = [r.asDict() for r in docs.collect()]
        result = stage(spark, docs, SF)
        after = [r.asDict() for r in result.collect()]
        out.append((name, rows, after, result.columns))
        docs = spark.createDataFrame([tuple(r[c] for c in corpus_pipeline.COLUMNS) for r in after], docs.schema)
    return {name: rest for name, *rest in out}


def test_order_and_columns(staged):
    assert list(staged) == ["language_id", "near_duplicates", "decontaminate", "mask_secrets", "mix_sources"]
    for name, (_, _, columns) in staged.items():
        assert columns[:5] == corpus_pipeline.COLUMNS and (len(columns) == 5 or name == "mix_sources")


def test_decisions(staged, spark):
    before, after, _ = staged["language_id"]
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    assert {r["doc_id"] for r in before if not bytecnn._LETTER.search(r["text"] or "")} <= gone
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(labels.get(i) != 1 for i in gone)
    before, after, _ = staged["near_duplicates"]
    assert {r["doc_id"] for r in after} == {c for _, c, _ in brute_classes([(r["doc_id"], r["text"]) for r in before])}
    before, after, _ = staged["decontaminate"]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r["doc_id"] for r in after}
    assert all(r["doc_id"] not in left for r in before if any(i in r["text"] for i in items))
    index = decontam.Index([decontam.Item(k, t) for k, t in enumerate(items)])
    held = decontam.search(index, __import__("pyarrow").array([r["text"] for r in before]))
    assert left == {r["doc_id"] for r, h in zip(before, held) if not h}
    before, after, _ = staged["mask_secrets"]
    old = {r["doc_id"]: r["text"] for r in before}
    ranks = Ranks(secrets.ranked_words(tables.docs(spark, [(r["doc_id"], r["text"]) for r in before])))
    assert {r["doc_id"] for r in after} == set(old)
    for r in after:
        assert (r["text"] == old[r["doc_id"]]) == (not secrets.spans_of(old[r["doc_id"]], ranks=ranks))
        assert not secrets.spans_of(r["text"], ranks=ranks) and r["n_chars"] == len(r["text"])
    before, after, _ = staged["mix_sources"]
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in before]
    want = mixture(rows, by_number, mixing.QUERY_WEIGHTS, mixing.BUDGET_SHARE, mixing.MAX_EPOCHS, mixing.SEED)
    assert sorted(((r["doc_id"], r["n_epochs"]) for r in after), key=str) == want


def test_stages_take_awkward_and_empty_tables(spark):
    for rows in (tables.awkward(spark), tables.no_rows(spark)):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, rows, SF).count() <= rows.count(), name


def test_a_null_language_is_filled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*corpus_pipeline.COLUMNS)
    unlabelled = [(10**9 + r.doc_id, r.text, None, r.source, r.n_chars) for r in docs.where("lang = 'de'").limit(5).collect()]
    rows = docs.unionByName(spark.createDataFrame(unlabelled, docs.schema))
    out = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, rows, SF).collect()}
    assert [out[r[0]] for r in unlabelled] == ["de"] * 5
    given = {r.doc_id: r.lang for r in docs.collect()}
    assert all(given[i] == lang for i, lang in out.items() if i in given)


def test_the_network_rejects_junk_and_no_good_document(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    long = docs.where("length(text) BETWEEN 300 AND 3000").orderBy("doc_id").limit(90).collect()
    rng = random.Random(99)
    planted = [(10**9 + i, bytecnn.junk_of(r.text, rng, i % 3), None, r.source, r.n_chars) for i, r in enumerate(long)]
    coded = "".join(map(chr, range(0x61, 0x7B)))  # code: a kind of junk that training has not seen
    planted += [
        (2 * 10**9 + i, " ".join("".join(rng.choice(coded + "0123456789_") for _ in range(9)) + "();" for _ in range(60)), None, "x", 1)
        for i in range(30)
    ]
    out = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.unionByName(spark.createDataFrame(planted, docs.schema)), sf).collect()}
    for low, high, share in [(10**9, 2 * 10**9, 0.95), (2 * 10**9, 3 * 10**9, 0.9)]:
        gone = [r[0] not in out for r in planted if low <= r[0] < high]
        assert sum(gone) >= share * len(gone), (sum(gone), len(gone))
    good = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").select("doc_id").collect()
    assert all(r.doc_id in out for r in good)

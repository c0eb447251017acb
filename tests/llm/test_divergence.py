"""op8: base figures against plain loops, divergences against numpy."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterflow.llm import divergence
from tests.llm import tables

SF = "/root/testdata/sf0.001"


def base(text):
    w = tables.words(text)
    tri = list(zip(w, w[1:], w[2:]))
    times, covered, seen, dup = Counter(tri), set(), set(), 0
    for i, t in enumerate(tri):
        if times[t] > 1:
            covered |= {i, i + 1, i + 2}
    for line in (text or "").split("\n"):
        if tables.words(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    n, r = len(w), len(covered)
    return n, sum(map(len, w)), symbols, dup, r, n < 50 or 100 * r > 50 * n


def figures(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


@pytest.mark.parametrize("listed", [64, 0])
def test_base_figures(spark, monkeypatch, listed):
    monkeypatch.setattr(divergence, "LISTED", listed)
    texts = ["a a a a", "a b c a b c d", "x\nx\n \n \ny\nx", "é#é <|> \x0b z", "a b a b a b", " lead", "a\x85b c d", "a\r\nb\r\n a\r\n"]
    texts += [tables.prose(1, 300) + " " + tables.prose(1, 200), "w " * 400, tables.prose(4, 70)]
    rows = tables.docs(spark, list(enumerate(texts, 100))).unionByName(tables.awkward(spark))
    for r in divergence.judge(rows, []).collect():
        assert figures(r) == base(r.text), r.text
        assert r.kept == (not r.base_failed) and r.js_chars is None


def test_query_on_whole_documents(spark):
    got = {r.doc_id: r for r in divergence.query(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    total, common, chars = {}, {}, {}
    patterns = [p.rstrip("+") for p in divergence.CLASSES.values()]

    def classes(t):
        t = "".join(tables.words(t))
        c = [len(re.findall(p, t)) for p in patterns]
        return np.array([*c, len(t) - sum(c)], float)

    for lang in {d.lang for d in docs}:
        own = Counter(w for d in docs if d.lang == lang for w in tables.words(d.text))
        total[lang] = sum(own.values())
        common[lang] = {w: n for w, n in own.items() if n >= divergence.COMMON_SHARE * total[lang]}
        chars[lang] = sum(classes(d.text) for d in docs if d.lang == lang)

    def js(p, q):
        m = (p + q) / 2
        part = [np.sum(x[x > 0] * np.log2(x[x > 0] / m[x > 0])) for x in (p, q)]
        return sum(part) / 2

    for d in docs:
        w, c = Counter(tables.words(d.text)), classes(d.text)
        n = sum(w.values())
        p = np.array([w[x] for x in common[d.lang]], float)
        q = np.array(list(common[d.lang].values()), float)
        p, q = np.append(p, n - p.sum()) / max(n, 1), np.append(q, total[d.lang] - q.sum()) / total[d.lang]
        r = got[d.doc_id]
        assert figures(r) == base(d.text)
        if n:
            words, letters = js(p, q), js(c / c.sum(), chars[d.lang] / chars[d.lang].sum())
            assert abs(r.js_words - words) < 1e-6 and abs(r.js_chars - letters) < 1e-6  # six digits
            odd = letters > divergence.CHARS_LIMIT + divergence.CHARS_SLACK / n
            blank = js(np.append(0 * q[:-1], 1), q)
            odd |= words > min(divergence.WORDS_LIMIT, divergence.BLANK_SHARE * blank) + divergence.WORDS_SLACK / n
            assert r.kept == (not r.base_failed and not odd)


def test_clean_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    good = spark.read.parquet(f"{sf}/labels.parquet")
    rows = divergence.query(spark, sf).join(good, "doc_id").where("NOT base_failed").groupBy("quality", "kept").count()
    counts = {(r.quality, r.kept): r["count"] for r in rows.collect()}
    assert counts.get((1, False), 0) <= 0.005 * counts[1, True]
    assert counts.get((0, True), 0) <= 0.05 * counts[0, False]


def test_a_text_without_label_takes_the_nearest(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    refs = divergence.references(divergence.word_counts(docs))
    rows = docs.where("lang = 'de'").withColumn("lang", F.lit(None).cast("string"))
    def total(frame):
        return {r.doc_id: r.js_chars + r.js_words for r in divergence.judge(frame, refs).collect()}

    nearest, own = total(rows), total(docs.where("lang = 'de'"))
    each = [total(docs.where("lang = 'de'").withColumn("lang", F.lit(r["lang"]))) for r in refs]
    assert all(abs(nearest[i] - min(e[i] for e in each)) < 1e-12 and nearest[i] <= own[i] + 1e-12 for i in own)


def test_wrong_languages_and_non_words_go(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    refs = divergence.references(divergence.word_counts(docs))
    good = docs.join(spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").select("doc_id"), "doc_id")
    english = good.where("lang = 'en'").withColumn("lang", F.lit("de"))
    # letters moved on by one place make words that no language has
    moved = F.translate("text", "abcdefghijklmnopqrstuvwxyz", "bcdefghijklmnopqrstuvwxyza")
    for rows in (english, good.withColumn("text", moved)):
        judged = divergence.judge(rows, refs).where("NOT base_failed AND n_words >= 100")
        counts = {r.kept: r["count"] for r in judged.groupBy("kept").count().collect()}
        assert counts.get(True, 0) <= 0.1 * counts.get(False, 0), counts
    judged = divergence.judge(good, refs).where("NOT base_failed")
    assert judged.where("NOT kept").count() == 0


def test_empty_tables(spark):
    none = tables.no_rows(spark)
    assert divergence.references(divergence.word_counts(none)) == []
    assert divergence.judge(none, []).count() == 0


def test_the_sql_judges_mislabelled_texts_and_non_words_alike(spark, tmp_path):
    import duckdb

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    good = docs.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1").select("doc_id"), "doc_id")
    wrong = good.where("lang = 'en'").orderBy("doc_id").limit(30).withColumn("lang", F.lit("de"))
    moved = F.translate("text", "abcdefghijklmnopqrstuvwxyz", "bcdefghijklmnopqrstuvwxyza")
    junk = good.where("lang = 'fr'").orderBy("doc_id").limit(30).withColumn("text", moved)
    rows = docs.unionByName(wrong.withColumn("doc_id", F.col("doc_id") + 10**6)).unionByName(
        junk.withColumn("doc_id", F.col("doc_id") + 2 * 10**6)
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.kept, r.base_failed) for r in divergence.query(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    result = con.execute(f"SELECT doc_id, kept, base_failed FROM ({divergence.ORACLE_SQL})").fetchall()
    assert got == {i: (kept, failed) for i, kept, failed in result}
    assert sum(not got[i][0] and not got[i][1] for i in got if i >= 10**6) > 30


def test_seventy_languages_and_small_ones_lose_no_text_to_a_foreign_reference(spark, tmp_path):
    """Each language has letters and words of its own; those without a reference are judged by the base rules alone."""
    import duckdb

    rows = []
    for n in range(70):
        letters = "".join(chr(0x400 + 3 * n + k) for k in range(12))
        rng = random.Random(n)
        known = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(150)]
        for k in range(3 if n else 1):  # language 0 has too few words for a reference
            words = [rng.choice(known) for _ in range(400 + 5 * n)]
            rows.append((100 * n + k, " ".join(words), f"l{n:02d}"))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    frame.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    refs = divergence.references(divergence.word_counts(frame))
    assert len(refs) == 64 and "l00" not in {r["lang"] for r in refs}
    got = {r.doc_id: r for r in divergence.query(spark, str(tmp_path)).collect()}
    assert all(r.kept == (not r.base_failed) for r in got.values())
    without = {lang for _, _, lang in rows} - {r["lang"] for r in refs}
    assert {i for i, r in got.items() if r.js_chars is None} == {i for i, _, lang in rows if lang in without}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    result = con.execute(f"SELECT doc_id, kept, js_words FROM ({divergence.ORACLE_SQL})").fetchall()
    assert {(i, kept) for i, kept, _ in result} == {(i, r.kept) for i, r in got.items()}
    assert all((js is None) == (got[i].js_words is None) for i, _, js in result)

"""op2 and op6: repeated passages and similar texts against all pairs."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from meterflow.llm import bayesjoin, suffixes
from meterflow.llm.components import components
from tests.llm import tables

LONG = suffixes.MIN_WORDS


def family(seed, n, words, edits):
    """A text and ``n`` copies with up to ``edits`` words replaced."""
    rng, base = random.Random(seed), tables.prose(seed, words, 3000).split()
    out = [" ".join(base)]
    for k in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(words)] = f"new{rng.randrange(9999)}"
        out.append(" ".join(own))
    return out


@pytest.fixture(scope="module")
def corpus():
    texts = family(1, 12, 80, 6) + family(2, 4, 400, 30) + family(3, 3, 12, 1)
    passage = tables.prose(77, 60, 3000)
    just_short = tables.prose(78, LONG - 1, 3000)
    texts += [f"{tables.prose(100 + i, 90, 3000)} {passage} {tables.prose(200 + i, 50, 3000)}" for i in range(4)]
    texts += [f"{tables.prose(300 + i, 90, 3000)} {just_short} tail{i} {tables.prose(400 + i, 50, 3000)}" for i in range(3)]
    inner = tables.prose(500, 70, 3000)
    texts += [f"{inner} between {inner}", texts[0], texts[0], "one two", "one two", "one two three", "", None, " \n"]
    return list(enumerate(texts, 1))


def shingles(text):
    w = tables.words(text)
    return frozenset(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset()


def brute_classes(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = sets[a][1] & sets[b][1]
            if both and len(both) >= 0.8 * len(sets[a][1] | sets[b][1]):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)].append(i)
    return sorted(((i, min(least[find(k)], default=None), links[k]) for k, (i, _) in enumerate(rows)), key=str)


def brute_spans(rows, length=LONG):
    held = defaultdict(set)
    words = [tables.words(t) for _, t in rows]
    for k, w in enumerate(words):
        for i in range(len(w) - length + 1):
            held[tuple(w[i : i + length])].add(k)
    out = []
    for (doc, _), w in zip(rows, words):
        spans = []
        for i in range(len(w) - length + 1):
            if len(held[tuple(w[i : i + length])]) > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        out += [(doc, *s) for s in spans]
    return sorted(out, key=str)


@pytest.mark.parametrize("tile", [1024, 4])
def test_classes_and_links(spark, corpus, monkeypatch, tile):
    monkeypatch.setattr(bayesjoin, "TILE", tile)
    rows = corpus + [(7, corpus[6][1]), (None, corpus[0][1])]
    got = bayesjoin.near_duplicates(tables.docs(spark, rows)).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute_classes(rows)


def test_few_long_texts_leave_tiles_empty(spark, monkeypatch):
    """Tiles cut by shingles: two or three nodes over several tiles, some of them without a node."""
    monkeypatch.setattr(bayesjoin, "TILE_SHINGLES", 256)
    texts = [t for seed in range(20, 28) for t in family(seed, 1 + seed % 2, 300, 6)]
    rows = list(enumerate(texts, 1))
    got = bayesjoin.near_duplicates(tables.docs(spark, rows)).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute_classes(rows)


def test_one_of_each_class_stays(spark, corpus):
    rows = tables.docs(spark, corpus + [(7, corpus[6][1]), (90, None), (90, None)])
    kept = bayesjoin.keep_one(rows)
    assert kept.columns == rows.columns
    want = {c for _, c, _ in brute_classes(corpus)}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(got) == sorted([*want, 90, 90])


def test_posterior_bound():
    for n in (32, 64, 128):
        m = bayesjoin.least_matches(n)
        rng = np.random.default_rng(n)
        # the share of similarities of at least 0.8 among those that give so few matches, by simulation
        s = rng.random(400_000)
        agreed = rng.binomial(n, s)
        below = s[agreed < m - 2]
        assert (below >= 0.8).mean() < 1e-4 and 0.4 * n < m < 0.8 * n
    a, b = "a b c d e f g".split(), "a b c d e f x".split()
    assert len(bayesjoin.shingles(pa.array([" ".join(a), " ".join(b), "x", None]))[0]) == 7


@pytest.mark.parametrize("partitions", ["8", "23"])
def test_repeated_passages(spark, corpus, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = corpus + [(3, corpus[2][1])]
        got = suffixes.repeated_passages(tables.docs(spark, rows)).collect()
        assert sorted(((r.doc_id, r.start_word, r.end_word) for r in got), key=str) == brute_spans(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_awkward_and_empty(spark):
    rows = tables.awkward(spark)
    plain = [(r.doc_id, r.text) for r in rows.collect()]
    got = bayesjoin.near_duplicates(rows).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute_classes(plain)
    spans = suffixes.repeated_passages(rows).collect()
    assert sorted(((r.doc_id, r.start_word, r.end_word) for r in spans), key=str) == brute_spans(plain)
    none = tables.no_rows(spark)
    assert bayesjoin.near_duplicates(none).count() == 0 and bayesjoin.keep_one(none).count() == 0
    assert suffixes.repeated_passages(none).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}

"""op7: budgets and prefixes against a plain walk down the tree."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from meterflow.llm import mixing
from tests.llm import tables


def share(budget, children):
    out, left = {k: 0.0 for k in children}, dict(children)
    if all(w <= 0 for w, _ in left.values()):
        left = {k: (1.0, c) for k, (_, c) in left.items()}
    heavy = {k: x for k, x in left.items() if x[0] > 0}
    while heavy and budget > 1e-9:
        total = sum(w for w, _ in heavy.values())
        full = [k for k, (w, c) in heavy.items() if c <= budget * w / total]
        if not full:
            return out | {k: budget * w / total for k, (w, _) in heavy.items()}
        for k in full:
            out[k] = heavy.pop(k)[1]
        budget -= sum(out[k] for k in full)
    rest = {k: (c, c) for k, (w, c) in left.items() if w <= 0 and c > 0}
    return out | (share(budget, rest) if rest and budget > 1e-9 else {})


def brute(rows, domain, weights, budget_share, epochs, seed):
    leaves = defaultdict(list)
    for doc, text, lang, source in rows:
        leaves[domain(source), lang or "unknown", source or "unknown"].append((doc, text or "", len(tables.words(text))))
    limits = {k: float(epochs * sum(x[2] for x in v)) for k, v in leaves.items()}

    def down(path, budget):
        if len(path) == 3:
            return {path: budget}
        kids = {k[: len(path) + 1] for k in limits if k[: len(path)] == path}
        known = {k: (weights.get(k, 1.0), sum(c for q, c in limits.items() if q[: len(k)] == k)) for k in kids}
        return {leaf: b for k, x in share(budget, known).items() for leaf, b in down(k, x).items()}

    total = sum(limits.values())
    budgets = down((), min(budget_share * total / epochs, total))
    out = []
    for leaf, docs in leaves.items():
        tokens, budget = sum(x[2] for x in docs), round(budgets[leaf], 3)
        full = int(budget // tokens) if tokens else 1
        rest, before = round(budget - full * tokens, 3), 0

        def place(x, full=full):
            key = [str(seed), str(full), "" if x[0] is None else str(x[0]), hashlib.md5(x[1].encode()).hexdigest()]
            return int(hashlib.md5("\x1f".join(key).encode()).hexdigest()[:15], 16)

        order = sorted(docs, key=place)
        for x in order:
            first = sum(y[2] for y in order if place(y) < place(x))
            times = full + (tokens > 0 and first < rest)
            if times:
                out.append((x[0], times))
    return sorted(out, key=str)


def by_number(source):
    digit = (source or "")[-1:]
    return "other" if not digit.isdigit() else "even" if int(digit) % 2 == 0 else "odd"


@pytest.mark.parametrize(
    ("weights", "budget_share", "epochs"),
    [
        (mixing.QUERY_WEIGHTS, 0.5, 4),
        (mixing.QUERY_WEIGHTS, 2.5, 3),
        ({}, 0.3, 1),
        ({("even",): 0.0, ("odd", "en"): 0.0, ("odd", "de"): 50.0}, 0.9, 1),
        ({}, 99.0, 2),
    ],
)
def test_against_the_tree(spark, weights, budget_share, epochs):
    rows = [(i, tables.prose(i, 5 + i * 7 % 60), ["en", "de", "fr", None][i % 4], f"src{i % 7}" if i % 11 else None) for i in range(90)]
    rows += [(200, None, "en", "src1"), (201, "", "xx", "src9"), (202, tables.prose(3, 900), "de", "src1"), (5, *rows[5][1:])]
    docs = tables.docs(spark, rows)
    got = mixing.mix(docs, mixing.domain_of(F.col("source")), weights, budget_share, max_epochs=epochs)
    assert got.columns == [*docs.columns, "domain", "n_tokens", "n_epochs"]
    want = brute(rows, by_number, weights, budget_share, epochs, mixing.SEED)
    assert sorted(((r.doc_id, r.n_epochs) for r in got.collect()), key=str) == want


def test_few_buckets_give_the_same(spark, monkeypatch):
    rows = tables.docs(spark, [(i, tables.prose(i, 30), "en", "src0") for i in range(50)])
    one = sorted(map(tuple, mixing.mix(rows, F.lit("d"), {}, 0.4).select("doc_id", "n_epochs").collect()))
    monkeypatch.setattr(mixing, "BUCKETS", 4)
    assert sorted(map(tuple, mixing.mix(rows, F.lit("d"), {}, 0.4).select("doc_id", "n_epochs").collect())) == one


def test_awkward_and_empty(spark):
    rows = tables.awkward(spark)
    plain = [(r.doc_id, r.text, r.lang, r.source) for r in rows.collect()]
    got = mixing.mix(rows, mixing.domain_of(F.col("source")), {}, 0.5).collect()
    assert sorted(((r.doc_id, r.n_epochs) for r in got), key=str) == brute(plain, by_number, {}, 0.5, 4, mixing.SEED)
    assert mixing.mix(tables.no_rows(spark), F.lit("d"), {}, 0.5).count() == 0

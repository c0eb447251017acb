"""op11: cross-products, deviations and whitened values against plain integer and numpy arithmetic."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterflow.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, _x string, n string"


def integer_rows(vectors):
    return [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]


def good(vector):
    return vector is not None and all(c is not None and math.isfinite(c) for c in vector)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "own", "n") for i, v in rows], SCHEMA)


def brute(xs):
    """Covariance with exact integer centring, over distinct rows."""
    fit = sorted({tuple(x) for x in xs})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(dims)]
    top = [[n * sum(x[i] * x[j] for x in fit) - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]
    return fit, n, sums, np.array([[v / n**2 for v in row] for row in top])


def test_scatter_is_exact():
    rng = random.Random(1)
    for rows, dims, spread in [(1, 1, 0), (63, 3, 5), (64, 2, 100), (130, 5, 2**20), (200, 3, 2**60)]:
        x = np.array([[1_000_000 + rng.randint(-spread, spread) for _ in range(dims)] for _ in range(rows)], np.int64)
        got = whitening.scatter(x)
        full = [[*(int(v) - 1_000_000 for v in row), 1] for row in x]
        want = [[sum(r[i] * r[j] for r in full) for j in range(dims + 1)] for i in range(dims + 1)]
        assert got.tolist() == want


def test_rows_against_brute_force(spark):
    rng = random.Random(2)
    vectors = [[rng.gauss(0, 0.1 + 0.05 * d) for d in range(20)] for _ in range(300)]
    rows = list(enumerate(vectors)) + [(1000 + i, vectors[i]) for i in range(0, 300, 3)]
    rows += [(2000, None), (2001, [None, *vectors[0][1:]]), (2002, [float("nan")] * 20), (2003, [float("inf")] * 20)]
    rows += [(None, vectors[5]), (2004, vectors[0][:7]), (2005, [])]
    kept = [(i, v) for i, v in rows if good(v) and len(v) == 20]
    got = whitening.whiten(table(spark, rows).repartition(5)).collect()
    xs = integer_rows([v for _, v in kept])
    fit, n, sums, covariance = brute(xs)
    assert len(got) == len(kept) and {r.n for r in got} == {n}
    assert {(r._x, r.label) for r in got} == {("own", 1)}
    value, axes = np.linalg.eigh(covariance)
    value, axes = value[::-1][:16], axes[:, ::-1][:, :16]
    centre = np.array([s / n for s in sums])
    want = {tuple(x): (np.array(x) - centre) @ axes / np.sqrt(value) for x in xs}
    far = {tuple(x): sum((n * a - s) ** 2 for a, s in zip(x, sums)) for x in xs}
    signs = None
    for row in sorted(got, key=lambda r: (r.vec_id is None, r.vec_id)):
        x = tuple(integer_rows([row.embedding])[0])
        assert row.deviation == far[x]
        ours = np.array(row.whitened)
        signs = np.sign(ours * want[x]) if signs is None else signs
        np.testing.assert_allclose(ours * signs, want[x], atol=1e-7)
        np.testing.assert_allclose(row.explained, value / np.trace(covariance), rtol=1e-9)
    assert len({r.identity_error for r in got}) == 1 and 0 <= got[0].identity_error < 1e-9


def test_degenerate_tables(spark):
    same = [(i, [0.5, -0.25]) for i in range(4)]
    got = whitening.whiten(table(spark, same)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(1, 0, [0.0, 0.0], [0.0, 0.0], 0.0)] * 4
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None), (2, []), (3, [])])).count() == 0
    # a dimension that never varies, and entries at the bound
    flat = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()
    assert [round(abs(r.whitened[0]), 9) for r in flat] == [1.0, 1.0] and {r.whitened[1] for r in flat} == {0.0}
    vast = whitening.whiten(table(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 0.0])])).collect()
    assert all(math.isfinite(w) for r in vast for w in r.whitened)
    assert [r.deviation for r in sorted(vast, key=lambda r: r.vec_id)][:2] == [None, None]


def test_deviation_at_the_edge_of_long():
    model = whitening.Whitener(1, [0, 0], np.eye(2), np.ones(2), [0.5, 0.5])
    root = math.isqrt(2**63 - 1)
    got = model.deviation(np.array([[root, 0], [root + 1, 0], [root, 3], [0, 2**40]], np.int64)).to_pylist()
    assert got == [root**2, None, root**2 + 9 if root**2 + 9 < 2**63 else None, None]


def test_blocks_do_not_matter(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(500)]
    kept, dims = whitening.vectors_of(table(spark, rows), "embedding")
    fit = kept.select("_x")
    whole = whitening.cross_products(fit.coalesce(1), dims)
    x = np.array([r._x for r in fit.collect()])
    monkeypatch.setattr(whitening, "BLOCK", 1)
    parts = sum(whitening.scatter(x[low : low + 64]) for low in range(0, 500, 64))
    assert (whole == parts).all() and (whitening.cross_products(fit.repartition(7), dims) == whole).all()


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_query(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    rows = [(i, v) for i, v in rows if good(v)]
    fit, n, sums, covariance = brute(integer_rows([v for _, v in rows]))
    got = whitening.query(spark, path)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 16 * len(rows)
    seen = got.groupBy("component").agg(F.max("explained").alias("e"), F.max("identity_error").alias("i")).collect()
    value = np.linalg.eigvalsh(covariance)[::-1]
    for row in seen:
        assert row.e == pytest.approx(value[row.component - 1] / np.trace(covariance), rel=1e-9) and row.i < 1e-9

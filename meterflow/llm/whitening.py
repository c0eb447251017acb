"""Embedding whitening from exact integer cross-products (bit-sliced scatter).

Entries become integers ``floor(64 * c) + 1000000``. Over the fit list, each distinct
integer vector once, the matrix of cross-products is exact:

* a task takes a block of vectors, subtracts each dimension's smallest value in the
  block and cuts what is left into bit planes, packed across rows into 64-bit words.
  A cross-product is then the sum over pairs of planes of 2^(a+b) times the popcount
  of their AND. A plane of ones stands for one more dimension, which gives sums and
  the number of rows. The block's shift is undone in integers.
* Spark adds up the blocks' matrices, as digits of ``DIGIT`` bits, so that no sum
  overflows; the driver gets one matrix of dimensions times dimensions, whatever the
  number of rows, centres it as integers (n * sum(xy) - sum(x) * sum(y)) and only then
  divides, for ``eigh``.

Memory of a task: ``BLOCK`` entries and their planes. Rows shuffle once, for the
distinct vectors, with equal ones merged before the shuffle; the fit list is written
in the shared folder and read twice (the scatter, and the check that the whitened fit
list has the identity as covariance).

Defined results: vectors that are null or hold a null, NaN or infinite entry are left
out, as are those whose length is not the most frequent one (of equally frequent ones
the longer). Entries beyond 2^61 / 64 count as that bound. Components without variance
(an eigenvalue not above rounding) are whitened to 0 and not part of the identity
check. The sign of a component makes its largest entry positive. A deviation beyond the
range of long is null. An empty table, or vectors without entries, give no rows.
Repeated rows have a result each; other columns are kept, and columns named like those
added are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import scratch

SCALE = 64
ORIGIN = 1_000_000
LIMIT = 2.0**61
COMPONENTS = 16
#: Entries of a block; a block has 64 rows at least.
BLOCK = 1 << 21
#: Bits of a digit in which cross-products are summed up, and the number of digits.
DIGIT, DIGITS = 40, 5


def usable(vector: Column) -> Column:
    """Whether a vector holds finite entries only."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(good, F.lit(False))


def integers(vector: Column) -> Column:
    """The entries as integers; Spark's floor gives a long."""

    def one(c: Column) -> Column:
        scaled = F.lit(float(SCALE)) * c.cast("double")
        return F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), scaled))) + F.lit(ORIGIN).cast("long")

    return F.transform(vector, one)


def matrix_of(vectors: pa.Array, dims: int) -> np.ndarray:
    """A list column, without nulls and of one length, as rows of int64."""
    flat = vectors.flatten() if isinstance(vectors, pa.Array) else vectors.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dims)


def scatter(x: np.ndarray) -> np.ndarray:
    """Exact cross-products of the columns of ``x - ORIGIN`` and a column of ones, as Python integers."""
    rows, dims = x.shape
    low = x.min(axis=0)
    left = (x - low).astype(np.uint64).T
    words = -(-rows // 64)
    planes, dim, bit = [], [], []
    for d in range(dims):
        for b in range(int(left[d].max()).bit_length()):
            planes.append(np.packbits((left[d] >> np.uint64(b)) & np.uint64(1) != 0))
            dim.append(d)
            bit.append(b)
    planes.append(np.packbits(np.ones(rows, bool)))
    dim, bit = np.array([*dim, dims]), np.array([*bit, 0])
    packed = np.zeros((len(planes), words * 8), np.uint8)
    packed[:, : len(planes[0])] = planes
    packed = packed.view(np.uint64)
    small = 2 * int(bit.max()) + rows.bit_length() + 8 < 62
    weight = np.array([1 << int(b) for b in bit], np.int64 if small else object)
    first = np.flatnonzero(np.r_[True, dim[1:] != dim[:-1]])
    total = np.zeros((dims + 1, dims + 1), object)
    row = np.zeros(dims + 1, weight.dtype)
    for k in range(len(dim)):
        count = np.bitwise_count(packed[k] & packed[k:]).sum(axis=1, dtype=np.int64)
        value = count.astype(weight.dtype) * weight[k:] * weight[k]
        value[1:][dim[k + 1 :] == dim[k]] *= 2  # both orders of two planes of one dimension
        starts = np.r_[0, first[first > k] - k]
        row[dim[k + starts]] += np.add.reduceat(value, starts)
        if k + 1 == len(dim) or dim[k + 1] != dim[k]:
            total[dim[k]] += row.astype(object)
            row[:] = 0
    shift = np.append(low.astype(object) - ORIGIN, 0)
    total = np.triu(total) + np.triu(total, 1).T
    sums = total[dims].copy()
    sums[dims] = 0  # the ones are not shifted
    return total + np.outer(shift, sums) + np.outer(sums, shift) + np.outer(shift, shift) * rows + _ones(shift, rows)


def _ones(shift: np.ndarray, rows: int) -> np.ndarray:
    """What the shift adds to the products with the column of ones."""
    out = np.zeros((len(shift), len(shift)), object)
    out[-1, :] = out[:, -1] = shift * rows
    return out


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    """Rows of a task in blocks of about ``BLOCK`` entries."""
    held, rows, most = [], 0, max(64, BLOCK // dims)
    for batch in batches:
        x = matrix_of(batch.column(0), dims)
        for low in range(0, len(x), most):
            held.append(x[low : low + most])
            rows += len(held[-1])
            if rows >= most:
                yield np.concatenate(held)
                held, rows = [], 0
    if rows:
        yield np.concatenate(held)


def _digits(i: np.ndarray, j: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    columns = {"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32())}
    for k in range(DIGITS):
        digit = values & ((1 << DIGIT) - 1) if k < DIGITS - 1 else values
        columns[f"d{k}"] = pa.array(digit.astype(np.int64))
        values = values >> DIGIT
    return pa.RecordBatch.from_pydict(columns)


def cross_products(fit: DataFrame, dims: int) -> np.ndarray:
    """The exact matrix of cross-products over all rows, with a last row for the sums and the count."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _blocks(batches, dims):
            part = scatter(x)
            total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(dims + 1)
            yield _digits(i, j, total[i, j])

    digits = [f"d{k}" for k in range(DIGITS)]
    parts = fit.mapInArrow(task, "i int, j int, " + ", ".join(f"{d} long" for d in digits))
    out = np.zeros((dims + 1, dims + 1), object)
    for row in parts.groupBy("i", "j").agg(*[F.sum(d).alias(d) for d in digits]).collect():
        value = sum(row[d] << (DIGIT * k) for k, d in enumerate(digits))
        out[row.i, row.j] = out[row.j, row.i] = value
    return out


@dataclass
class Whitener:
    """Fitted on ``n`` distinct vectors; ``axes`` has a column per component."""

    n: int
    sums: list[int]
    axes: np.ndarray
    scale: np.ndarray
    explained: list[float]
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Integer distance to the floor of the mean, what is left of the mean, and the rest in units of 1/n."""
        mean = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        return x - mean, rest / self.n, rest

    def project(self, x: np.ndarray) -> np.ndarray:
        whole, fraction, _ = self.centred(x)
        return ((whole - fraction) @ self.axes) * self.scale

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n*x - S)^2: exact in 64-bit arithmetic wherever the result fits."""
        whole, _, rest = self.centred(x)
        about = ((self.n * whole.astype(float) - rest) ** 2).sum(axis=1)
        moved = whole * self.n - rest  # these wrap around, and so does the sum: exact modulo 2^64
        exact = (moved * moved).sum(axis=1)
        for k in np.flatnonzero(np.abs(about / 2.0**63 - 1) < 1e-6):
            full = sum((int(w) * self.n - int(r)) ** 2 for w, r in zip(whole[k], rest))
            about[k], exact[k] = (0, full) if full < 2**63 else (2.0**64, 0)
        return pa.array(exact, mask=about >= 2.0**63)


def eigen(products: np.ndarray, components: int) -> Whitener:
    """Centre the cross-products as integers, then take the leading components."""
    dims = len(products) - 1
    n, moved = products[dims, dims], products[dims, :dims]
    scatter_n = products[:dims, :dims] * n - np.outer(moved, moved)
    covariance = np.array([[v / (n * n) for v in row] for row in scatter_n], float)
    value, axes = np.linalg.eigh(covariance)
    order = np.argsort(-value, kind="stable")[: min(components, dims)]
    trace = float(np.trace(covariance))
    noise = max(float(value.max()), 0.0) * dims * np.finfo(float).eps
    value, axes = value[order], axes[:, order]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    scale = np.array([v**-0.5 if v > noise else 0.0 for v in value.tolist()])
    explained = [max(v, 0.0) / trace if trace > 0 else 0.0 for v in value.tolist()]
    return Whitener(n, [s + n * ORIGIN for s in moved], axes, scale, explained)


def identity_error(fit: DataFrame, model: Whitener, dims: int) -> float:
    """Largest distance of the whitened fit list's covariance from the identity, measured over all its rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for x in _blocks(batches, dims):
            w = model.project(x)
            w = np.column_stack([w, np.ones(len(w))])
            total = total + w.T @ w
        if not np.isscalar(total):
            i, j = np.triu_indices(len(total))
            rows = {"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "v": pa.array(total[i, j])}
            yield pa.RecordBatch.from_pydict(rows)

    k = len(model.scale)
    total = np.zeros((k + 1, k + 1))
    for row in fit.mapInArrow(task, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[row.i, row.j] = total[row.j, row.i] = row.v
    mean = total[k, :k] / model.n
    apart = total[:k, :k] / model.n - np.outer(mean, mean) - np.eye(k)
    live = model.scale > 0
    return float(np.abs(apart[np.ix_(live, live)]).max()) if live.any() else 0.0


def vectors_of(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The rows with usable vectors of the most frequent length, with ``_x``, and that length."""
    kept = rows.where(usable(F.col(vector)))
    sizes = kept.groupBy(F.size(vector).alias("_size")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("_size")).first()
    dims = top["_size"] if top else 0
    return kept.where(F.size(vector) == dims).withColumn("_x", integers(F.col(vector))), dims


def fit_whitener(rows: DataFrame, dims: int, components: int = COMPONENTS) -> Whitener:
    """Fit on the distinct vectors ``_x`` of ``rows``."""
    fit = scratch.materialise(rows.select("_x").distinct(), "whitening-fit")
    model = eigen(cross_products(fit, dims), components)
    model.identity_error = identity_error(fit, model, dims)
    return model


@scratch.shielded
def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Rows with usable vectors, with ``whitened`` (an array), ``explained`` (an array), ``deviation``, ``n`` and ``identity_error``."""
    kept, dims = vectors_of(rows, vector)
    model = fit_whitener(kept, dims, components) if dims else Whitener(0, [], np.zeros((0, 0)), np.zeros(0), [])

    @F.arrow_udf("struct<deviation:bigint,whitened:array<double>>")
    def apply(vectors: pa.Array) -> pa.Array:
        x = matrix_of(vectors, dims)
        w = model.project(x)
        ends = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
        whitened = pa.ListArray.from_arrays(ends, pa.array(w.reshape(-1)))
        return pa.StructArray.from_arrays([model.deviation(x), whitened], ["deviation", "whitened"])

    found = kept.withColumn("_w", apply("_x")) if dims else kept.limit(0).withColumn(
        "_w", F.lit(None).cast("struct<deviation:bigint,whitened:array<double>>")
    )
    added = {
        "whitened": F.col("_w.whitened"),
        "explained": F.lit(model.explained).cast("array<double>") if model.explained else F.array().cast("array<double>"),
        "deviation": F.col("_w.deviation"),
        "n": F.lit(model.n).cast("long"),
        "identity_error": F.lit(model.identity_error),
    }
    return found.withColumns(added).drop("_x", "_w")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every usable embedding, a row for each component."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    found = whiten(rows).select("*", F.posexplode(F.arrays_zip("whitened", "explained")))
    return found.select(
        "vec_id",
        (F.col("pos") + 1).alias("component"),
        "n",
        "deviation",
        F.col("col.whitened").alias("whitened"),
        F.col("col.explained").alias("explained"),
        "identity_error",
    )

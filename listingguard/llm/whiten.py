"""Whitening of embeddings from exact integer cross-products, counted on bit slices.

Every entry is put on a grid of 1/256, so that a vector is a row of integers. The distinct rows are the fit list. A task shifts each
dimension to start at zero, packs bit k of a dimension across the rows of a block into 64-bit words, and counts the common bits of
every two planes; weighted by their powers of two these counts are the exact cross-products. Sums over tasks are decimals, and the
covariance is centred as integers (n x products - sum x sum) before it becomes floating point for the eigenvectors.

A task keeps one d x d table per vector length and a block of ``BLOCK`` rows; the driver gets d x (d + 1) / 2 sums per length.

Defined cases: a null vector, or one with a null or non-finite entry, gives no rows; a vector without entries has no component and gives
none; vectors of different lengths are fitted apart, each length with its own n; entries beyond the range of a long after scaling
are held at its ends; a component whose eigenvalue is zero to double precision (one distinct vector, say) has a null ``whitened``, and
``explained`` and ``identity_error`` are null where no variance is left; a ``deviation`` beyond 38 digits is an error. Repeated rows and repeated or null
ids each give their own rows. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingguard.sources.stage import materialize

SCALE = 256
COMPONENTS = 4
#: Rows that are packed together, a multiple of 64.
BLOCK = 16_384
#: Products and sums below this many bits are kept in 64-bit integers.
NARROW_BITS = 62
WIDE = pa.decimal128(38, 0)


def integer_rows(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vectors`` with a usable vector, as the column ``x`` of longs in place of it."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    kept = vectors.where(F.col(vector).isNotNull() & finite)
    return kept.select("vec_id", F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE)).alias("x"))


def blocks(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, their vectors as one matrix) for each vector length of a batch."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        if d:
            yield rows, values[starts[rows][:, None] + np.arange(d)]


def _limits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per vector length: number of rows, least and largest value of each dimension."""
    seen: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for rows, x in blocks(batch.column("x")):
            n, low, high = seen.get(x.shape[1], (0, x[0], x[0]))
            seen[x.shape[1]] = (n + len(rows), np.minimum(low, x.min(0)), np.maximum(high, x.max(0)))
    for d, (n, low, high) in seen.items():
        yield pa.RecordBatch.from_pydict({"d": [d], "n": [n], "low": [low.tolist()], "high": [high.tolist()]})


def bit_planes(y: np.ndarray, planes: int) -> np.ndarray:
    """(dimension x plane, word) matrix: bit k of every dimension across the rows of ``y``, 64 rows a word."""
    pad = -len(y) % 64
    if pad:
        y = np.vstack((y, np.zeros((pad, y.shape[1]), y.dtype)))
    out = np.empty((y.shape[1], planes, len(y) // 64), np.uint64)
    for k in range(planes):
        bits = ((y >> np.uint64(k)) & np.uint64(1)).astype(np.uint8)
        out[:, k] = np.ascontiguousarray(np.packbits(bits, axis=0).T).view(np.uint64)
    return out.reshape(-1, out.shape[2])


def cross_products(y: np.ndarray, planes: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums of y_i and of y_i x y_j (upper triangle) of unsigned rows, from AND-popcounts of their bit planes."""
    d = y.shape[1]
    if not planes:
        return np.zeros(d, object), np.zeros((d, d), object)
    words = bit_planes(y, planes)
    common = np.zeros((d * planes, d * planes), np.int64)
    for i in range(d * planes):
        first = i // planes * planes
        common[i, first:] = np.bitwise_count(words[i] & words[first:]).sum(axis=1, dtype=np.int64)
    narrow = 2 * planes + int(len(y)).bit_length() <= NARROW_BITS
    weight = np.array([1 << k for k in range(planes)], np.int64 if narrow else object)
    left = np.tensordot(common.reshape(d, planes, d, planes).astype(weight.dtype), weight, (3, 0))
    sums = np.bitwise_count(words).sum(axis=1, dtype=np.int64).reshape(d, planes).astype(weight.dtype) @ weight
    return sums.astype(object), np.tensordot(left, weight, (1, 0)).astype(object)


def _scatter(low: dict[int, np.ndarray], planes: dict[int, int]):
    """Per task and vector length: row i of the cross-products from j = i on, and the sums as row -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        products: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in blocks(batch.column("x")):
                d = x.shape[1]
                y = x.view(np.uint64) - low[d].view(np.uint64)  # exact modulo 2^64, and never negative
                for at in range(0, len(y), BLOCK):
                    s, p = cross_products(y[at : at + BLOCK], planes[d])
                    sums[d], products[d] = sums.get(d, 0) + s, products.get(d, 0) + p
        for d in sums:
            found = [(-1, sums[d]), *((i, products[d][i, i:]) for i in range(d))]
            values = pa.array([[Decimal(int(v)) for v in row] for _, row in found], pa.list_(WIDE))
            at = pa.array([i for i, _ in found], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(found), pa.int32()), at, values], ["d", "i", "sums"])

    return run


@dataclass(frozen=True)
class Fitted:
    """What was learned of one vector length: n distinct rows, their sums, and the components in columns."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    values: np.ndarray
    explained: tuple[float | None, ...]
    identity_error: float | None = None

    def usable(self) -> np.ndarray:
        top = self.values[0] if len(self.values) else 0.0
        return self.values > max(top, 0.0) * len(self.sums) * np.finfo(float).eps

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        most = self.n * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, self.sums))
        kind = np.int64 if most < 1 << NARROW_BITS else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def deviations(self, u: np.ndarray) -> list[int]:
        most = max(abs(int(u.max())), abs(int(u.min())))
        if u.dtype == object or most * most * u.shape[1] >= 1 << NARROW_BITS:
            u = u.astype(object)
        return [int(v) for v in (u * u).sum(axis=1)]

    def whitened(self, u: np.ndarray) -> np.ndarray:
        """NaN where the component's eigenvalue is zero."""
        ok = self.usable()
        scale = np.where(ok, np.sqrt(np.where(ok, self.values, 1.0)), np.nan)
        return (u / self.n).astype(np.float64) @ self.axes / scale


def eigen(n: int, low: list[int], sums: list[int], products: dict[tuple[int, int], int], most: int) -> Fitted:
    """The first ``most`` components from exact sums of the shifted rows."""
    d = len(low)
    cov = np.empty((d, d))
    trace = 0
    for i in range(d):
        for j in range(i, d):
            centred = n * products[i, j] - sums[i] * sums[j]
            cov[i, j] = cov[j, i] = centred / (n * n)
            trace += centred if i == j else 0
    values, vectors = np.linalg.eigh(cov)
    values, axes = values[::-1][:most].copy(), vectors[:, ::-1][:, :most].copy()
    axes *= np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])
    explained = tuple(float(max(v, 0.0) / (trace / (n * n))) if trace else None for v in values)
    return Fitted(n, tuple(s + n * a for s, a in zip(sums, low)), axes, values, explained)


def fit(rows: DataFrame, most: int = COMPONENTS) -> dict[int, Fitted]:
    """Components of every vector length, from the distinct rows."""
    distinct = materialize(rows.select("x").distinct(), "whiten_fit")
    limits = distinct.mapInArrow(_limits, "d long, n long, low array<long>, high array<long>")
    spread = limits.select("d", "n", F.posexplode(F.arrays_zip("low", "high")).alias("i", "v"))
    ends = spread.groupBy("d", "i").agg(F.min("v.low").alias("low"), F.max("v.high").alias("high"), F.sum("n").alias("n"))
    found: dict[int, dict[int, tuple[int, int, int]]] = {}
    for r in ends.collect():  # one row per dimension and vector length
        found.setdefault(r.d, {})[r.i] = (r.low, r.high, r.n)
    low = {d: np.array([v[i][0] for i in range(d)], np.int64) for d, v in found.items()}
    planes = {d: max((hi - lo).bit_length() for lo, hi, _ in v.values()) for d, v in found.items()}
    parts = distinct.mapInArrow(_scatter(low, planes), "d int, i int, sums array<decimal(38,0)>")
    whole = parts.select("d", "i", F.posexplode("sums").alias("j", "v")).groupBy("d", "i", "j").agg(F.sum("v").alias("v"))
    sums: dict[int, dict[int, int]] = {}
    products: dict[int, dict[tuple[int, int], int]] = {}
    for r in whole.collect():  # d x (d + 3) / 2 sums per vector length
        if r.i < 0:
            sums.setdefault(r.d, {})[r.j] = int(r.v)
        else:
            products.setdefault(r.d, {})[r.i, r.i + r.j] = int(r.v)
    fitted = {
        d: eigen(v[0][2], low[d].tolist(), [sums[d][i] for i in range(d)], products[d], most) for d, v in found.items()
    }
    return with_identity_error(distinct, fitted)


def with_identity_error(distinct: DataFrame, fitted: dict[int, Fitted]) -> dict[int, Fitted]:
    """``fitted`` with the largest absolute entry of (covariance of the whitened fit list - identity)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in blocks(batch.column("x")):
                f = fitted[x.shape[1]]
                w = f.whitened(f.centred(x))[:, f.usable()]
                yield pa.RecordBatch.from_pydict({"d": [x.shape[1]] * len(w), "w": list(w)}, pa.schema({"d": pa.int32(), "w": pa.list_(pa.float64())}))

    table = materialize(distinct.mapInArrow(run, "d int, w array<double>"), "whitened_fit")
    means: dict[tuple[int, int], float] = {
        (r.d, r.i): r.m
        for r in table.select("d", F.posexplode("w").alias("i", "v")).groupBy("d", "i").agg(F.avg("v").alias("m")).collect()
    }
    out = dict(fitted)
    for d, f in fitted.items():
        k = int(f.usable().sum())
        if not k:
            continue
        gap = [F.col("w")[i] - F.lit(means[d, i]) for i in range(k)]
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        row = table.where(F.col("d") == d).agg(*[F.avg(gap[i] * gap[j]) for i, j in pairs]).first()
        out[d] = replace(f, identity_error=max(abs(v - (i == j)) for v, (i, j) in zip(row, pairs)))
    return out


def whiten(vectors: DataFrame, vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation decimal(38,0), whitened, explained and identity_error of every usable vector."""
    rows = integer_rows(vectors, vector)
    fitted = fit(rows, most)
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in blocks(batch.column("x")):
                f = fitted[x.shape[1]]
                k = len(f.values)
                u = f.centred(x)
                far = pa.array([Decimal(v) for v in f.deviations(u)], WIDE)
                each = np.repeat(np.arange(len(at)), k)
                columns = {
                    "vec_id": batch.column("vec_id").take(pa.array(at[each])),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    "n": pa.array(np.full(len(each), f.n, np.int64)),
                    "deviation": far.take(pa.array(each)),
                    "whitened": pa.array(f.whitened(u).ravel(), from_pandas=True),
                    "explained": pa.array(list(f.explained) * len(at), pa.float64()),
                    "identity_error": pa.array([f.identity_error] * len(each), pa.float64()),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return rows.mapInArrow(run, schema)

"""Whitening against plain numpy and Python integers."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from listingguard.llm import queries, whiten


def grid(v):
    return [math.floor(256 * c) for c in v]


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def plain(rows):
    """{d: (n, S, V as fractions)} of the distinct rows."""
    out = {}
    for d in {len(v) for v in rows if v}:
        fit = sorted({tuple(grid(v)) for v in rows if len(v) == d})
        n, s = len(fit), [sum(c) for c in zip(*fit)]
        cov = [[Fraction(n * sum(x[i] * x[j] for x in fit) - s[i] * s[j], n * n) for j in range(d)] for i in range(d)]
        out[d] = n, s, cov, np.array(fit, np.float64)
    return out


def test_against_plain_integers(spark):
    rnd = random.Random(4)
    rows = [[rnd.gauss(0, 1 + j / 3) for j in range(6)] for _ in range(300)]
    rows += [rows[0]] * 150 + [[x * 1.0001 for x in rows[1]], None, [], [1.0, None] * 3, [math.nan] * 6, [math.inf] * 6, [-0.0] * 6]
    rows += [[rnd.random(), 5.0] for _ in range(40)] + [[2.0]] + [[1e6 * rnd.random() for _ in range(3)] for _ in range(30)]
    ids = [i if i % 7 else None for i in range(len(rows))]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in zip(ids, rows)], "vec_id long, embedding array<double>, component string, n int")
    got = whiten.whiten(table.repartition(6)).collect()
    fitted = plain([v for v in rows if usable(v)])
    want = {}
    for i, v in zip(ids, rows):
        if usable(v) and v:
            n, s, _, _ = fitted[len(v)]
            far = sum((n * x - t) ** 2 for x, t in zip(grid(v), s))
            for k in range(min(4, len(v))):
                want.setdefault((i, k + 1, n, far), []).append(v)
    assert sorted((str(r.vec_id), r.component, r.n, int(r.deviation)) for r in got) == sorted((str(k[0]), *k[1:]) for k, vs in want.items() for _ in vs)
    for d, (n, s, cov, fit) in fitted.items():
        values, axes = np.linalg.eigh(np.array([[float(x) for x in row] for row in cov]))
        values, axes = values[::-1], axes[:, ::-1]
        trace = float(sum(cov[i][i] for i in range(d)))
        mine = {(r.vec_id, r.component, int(r.deviation)): r for r in got if r.n == n}
        for i, v in zip(ids, rows):
            if not usable(v) or len(v) != d:
                continue
            far = sum((n * x - t) ** 2 for x, t in zip(grid(v), s))
            for k in range(min(4, d)):
                r = mine[i, k + 1, far]
                if values[k] <= values[0] * d * 2.3e-16:
                    assert r.whitened is None
                    continue
                project = (np.array(grid(v)) - np.array(s) / n) @ axes[:, k] / math.sqrt(values[k])
                if i is not None:  # null ids repeat
                    assert abs(r.whitened) == pytest.approx(abs(project), abs=1e-9)
                assert r.explained == pytest.approx(values[k] / trace, rel=1e-9)
                assert r.identity_error < 1e-9


def test_wide_values_stay_exact():
    rnd = random.Random(1)
    for bits in (0, 1, 9, 33, 63):
        y = [[rnd.getrandbits(bits) if bits else 0 for _ in range(3)] for _ in range(130)]
        sums, products = whiten.cross_products(np.array(y, np.uint64), bits)
        assert [int(x) for x in sums] == [sum(c) for c in zip(*y)]
        for i in range(3):
            for j in range(i, 3):
                assert int(products[i, j]) == sum(r[i] * r[j] for r in y)


def test_query_and_empty(spark, sf_dir):
    got = queries.op11_whitening(spark, sf_dir)
    assert dict(got.dtypes)["deviation"] == "bigint"
    rows = got.collect()
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    assert len(rows) == 4 * vectors and {r.component for r in rows} == {1, 2, 3, 4}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-4
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whiten.whiten(none).collect() == []

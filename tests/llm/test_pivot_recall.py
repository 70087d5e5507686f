"""Recall of the pivot index against brute force: a hot group of near copies, pairs between 0.90 and 0.95, several lengths."""

import numpy as np

from listingguard.llm import pivots


def near(rnd, x, cosines):
    g = rnd.normal(size=x.shape)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    g -= (g * x).sum(1, keepdims=True) * x
    g /= np.linalg.norm(g, axis=1, keepdims=True)
    return cosines[:, None] * x + np.sqrt(1 - cosines**2)[:, None] * g


def counted(spark, vectors):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got = pivots.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)).collect()
    assert len(got) == len(vectors)
    return np.array([r.n_links for r in sorted(got)])


def brute(x):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return (x @ x.T >= pivots.COSINE).sum(1) - 1


def test_hot_third_and_loose_pairs(spark):
    rnd = np.random.default_rng(7)
    centre = rnd.normal(size=(1, 32))
    hot = near(rnd, np.repeat(centre, 3000, 0), np.full(3000, np.sqrt(0.985)))
    base = rnd.normal(size=(3000, 32))
    pairs = near(rnd, base, rnd.uniform(0.9, 0.95, 3000))
    x = np.concatenate([hot, base, pairs])
    got, want = counted(spark, x), brute(x)
    assert (got <= want).all()
    assert got[:3000].sum() == want[:3000].sum()
    assert got[3000:].sum() >= 0.99 * want[3000:].sum()


def test_every_length_links(spark):
    rnd = np.random.default_rng(8)
    parts = []
    for length, n in ((8, 90), (12, 40), (3, 5)):
        base = rnd.normal(size=(n, length))
        parts.append(np.concatenate([base, near(rnd, base, np.full(n, 0.93))]))
    got = counted(spark, [v for p in parts for v in p])
    assert got.tolist() == [n for p in parts for n in brute(p).tolist()]

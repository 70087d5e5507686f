"""Katz scores against a plain dictionary version, and exact normalisation of every history."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from listingguard.llm import katz

K = katz.K


def tokens(text):
    low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["</end>"]


def discounts(counts):
    n = Counter(c for c in counts if c <= K + 1)
    d = {r: 1.0 for r in range(1, K + 1)}
    if n[1]:
        cut = (K + 1) * n[K + 1] / n[1]
        for r in range(1, K + 1):
            if n[r] and cut != 1:
                x = ((r + 1) * n[r + 1] / (n[r] * r) - cut) / (1 - cut)
                d[r] = x if 0 < x < 1 else 1.0
    return d


class Plain:
    def __init__(self, texts, order):
        self.order = order
        self.counts = {n: Counter() for n in range(1, order + 1)}
        for t in texts:
            ws = tokens(t)
            self.counts[1].update((w,) for w in ws)
            padded = ["<s>", *ws]
            for n in range(2, order + 1):
                for i in range(n, len(padded) + 1):
                    self.counts[n][tuple(padded[i - n : i])] += 1
        self.d = {n: discounts(c.values()) for n, c in self.counts.items()}
        self.followers = {n: defaultdict(dict) for n in range(2, order + 1)}
        for n in range(2, order + 1):
            for g, c in self.counts[n].items():
                self.followers[n][g[:-1]][g[-1]] = c
        one = self.counts[1]
        self.total = sum(one.values())
        kept = sum(c * self.d[1].get(c, 1.0) for c in one.values())
        self.below = self.total if kept < self.total - 1e-9 else self.total + 1
        self.unknown = 1 - kept / self.below

    def p(self, history, w):
        if not history:
            c = self.counts[1][(w,)]
            return c * self.d[1].get(c, 1.0) / self.below if c else self.unknown
        n = len(history) + 1
        seen = self.followers[n].get(history, {})
        shorter = history[1:]
        if not seen:
            return self.p(shorter, w)
        d = self.d[n]
        total = sum(seen.values())
        kept = sum(c * d.get(c, 1.0) for c in seen.values())
        below = total if kept < total - 1e-9 else total + 1
        if w in seen:
            return seen[w] * d.get(seen[w], 1.0) / below
        return (1 - kept / below) / (1 - sum(self.p(shorter, v) for v in seen)) * self.p(shorter, w)

    def score(self, text):
        padded = ["<s>", *tokens(text)]
        return sum(math.log10(self.p(tuple(padded[max(0, i - self.order + 1) : i]), padded[i])) for i in range(1, len(padded)))


def rows(n=60):
    words = [f"w{i}" for i in range(25)]
    out = []
    for i in range(n):
        length = (i * 7) % 23
        out.append((i, " ".join(words[(i * i + j * j * (1 + i % 4)) % (5 + i % 21)].upper() if j % 3 else words[(i + j) % 9] for j in range(length))))
    return [*out, (n, None), (n + 1, ""), (n + 2, "w1 É É"), (3, out[3][1]), (n + 3, "never seen before at all"), (None, "w1 w2")]


@pytest.mark.parametrize("order", [2, 3])
def test_against_dictionaries(spark, order, monkeypatch):
    monkeypatch.setattr(katz, "BUCKET_BYTES", 300)
    data = rows()
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("score", F.lit(1)).repartition(3)
    fold = {i: zlib.crc32(str("" if i is None else i).encode()) % 10 for i, _ in data}
    plain = Plain([t for i, t in data if fold[i]], order)
    assert sum(plain.p(("w1",), w) for (w,) in plain.counts[1]) + plain.p(("w1",), "?") == pytest.approx(1)
    got = katz.held_out_score(docs, order).collect()
    assert len(got) == len(data)
    want = defaultdict(list)
    for i, t in data:
        want[i].append((t, plain.score(t)))
    types = len(plain.counts[1])
    for r in got:
        t, s = want[r.doc_id][0]
        assert r.score == pytest.approx(s, rel=1e-9), r
        ws = tokens(t)
        one = [plain.counts[1][(w,)] for w in ws]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c > 0 for c in one), plain.total)
        assert r.base_score == pytest.approx(sum(math.log10((c + 0.1) / (plain.total + 0.1 * (types + 1))) for c in one))
        assert r.held_out == (fold[r.doc_id] == 0)


def test_spread_histories(spark, monkeypatch):
    """Histories that are split over buckets give the same scores."""
    data = [(i, " ".join(["a", f"b{i % 7}", "a", f"c{i % 5}"] * (1 + i % 3))) for i in range(1, 40)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    monkeypatch.setattr(katz, "BUCKET_BYTES", 200)
    whole = {r.doc_id: r.score for r in katz.score(docs, F.lit(True)).collect()}
    plain = Plain([t for _, t in data], katz.ORDER)
    for i, t in data:
        assert whole[i] == pytest.approx(plain.score(t), rel=1e-9)


def test_empty_table_and_no_training(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert katz.held_out_score(none).count() == 0
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in katz.score(some, F.lit(False)).collect()}
    assert got[1].n_known == 0 and got[1].score == 0.0 and got[2].n_tokens == 1

"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from listingguard.llm import importance
from tests.llm import data

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def features(text, most, buckets):
    ws = words(text)
    return [zlib.crc32(" ".join(ws[i : i + n]).encode()) % buckets for n in range(1, most + 1) for i in range(len(ws) - n + 1)]


def plain(docs, target, most, buckets, min_words, percent):
    """(doc_id, n_words, n_features, weight, score) of every row, and the drawn ids in order."""
    ours = [features(t, most, buckets) for _, t in docs]
    s, t = Counter(b for f in ours for b in f), Counter(b for x in target for b in features(x, most, buckets))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for (i, text), f in zip(docs, ours):
        w = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(words(text)), len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return rows, able[: len(able) * percent // 100]


@pytest.mark.parametrize("most, buckets, min_words, percent", [(1, 10_000, 20, 10), (3, 997, 0, 50), (2, 64, 5, 100)])
def test_against_plain_python(spark, most, buckets, min_words, percent):
    docs = [(r[0], r[1]) for r in data.awkward()] + [(500 + i, "ﬀ  A-b\x85c\u00a0d " * i) for i in range(30)]
    target = [r.text for r in data.benchmark(spark).collect()]
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in docs], "doc_id long, text string, crcs string, row int, rank int").repartition(7)
    got = importance.resample(table, data.benchmark(spark), most, buckets, min_words, percent).collect()
    rows, drawn = plain(docs, target, most, buckets, min_words, percent)
    key = lambda r: (r.doc_id, r.n_words, r.n_features, r.weight, r.score)
    assert Counter(map(key, got)) == Counter(rows)
    ranks = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranks] == list(range(1, len(drawn) + 1))
    assert [(r.score, r.doc_id) for r in ranks] == [(r[4], r[0]) for r in drawn]


def test_checksums_of_runs():
    text = "Ab  c, déjà\tvu 12 " * 7
    ws = [w.encode() for w in words(text)]
    end, size = importance.running(text.encode())
    at = np.concatenate(([0], np.cumsum(size.astype(np.int64) + 1)))
    for i in range(len(ws)):
        for j in range(i + 1, len(ws) + 1):
            before = importance.after_space(end[i - 1 : i]) if i else np.zeros(1, np.uint32)
            length = np.array([at[j] - at[i] - 1])
            assert int((end[j - 1 : j] ^ importance.shift(before, length))[0]) == zlib.crc32(b" ".join(ws[i:j]))
    big = np.array([2**31 + 5, 1], np.int64)
    crc = np.array([zlib.crc32(b"x"), zlib.crc32(b"x")], np.uint32)
    assert int(importance.shift(crc, big)[1]) == int(importance.shift(crc, np.array([1, 1]))[0])


def test_one_key_for_a_third_of_all_rows(spark):
    """Rows that share id and text take consecutive ranks."""
    rows = [(7, "same words here " * 10)] * 200 + [(i, f"word{i} " * 30) for i in range(100, 300)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = importance.resample(table, table.limit(1), percent=100).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 401))
    same = sorted(r["rank"] for r in got if r.doc_id == 7)
    assert same == list(range(same[0], same[0] + 200))


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, None), (2, "a b")], "doc_id long, text string")
    assert importance.resample(none, some).collect() == []
    got = {r.doc_id: r for r in importance.resample(some, none).collect()}
    assert got[1].weight == 0 and got[1].n_features == 0 and got[2]["rank"] is None

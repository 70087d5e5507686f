"""A quality classifier from positive and unlabelled texts.

Trusted positives are documents labelled as good; the unlabelled set is web text as it comes, its labels unseen. The class prior is
estimated first, then a small network is fitted by the non-negative unbiased risk: prior x R+(positives) + max(0,
R-(unlabelled) - prior x R-(positives)). Whole texts are described by signs, case, repetition and layout; neither language, source
nor id is an input.

The fit uses at most ``MAX_POSITIVES`` positives and ``MAX_UNLABELLED`` unlabelled rows, chosen by hash. Scoring covers
every row in one pass over the texts.

Defined cases: null and empty texts have all-zero features and get the score of such a text; without any positive every score is the
prior 0.5; repeated rows are scored alike; repeated labels of an id count as good if any is; a null label counts as none. Extra columns
are ignored by ``score`` and kept by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingguard.llm import flat
from listingguard.llm.common import crc_mod, row_key, unused
from listingguard.sources.stage import materialize

MAX_POSITIVES = 20_000
MAX_UNLABELLED = 40_000
HIDDEN = 24
STEPS = 1500
BATCH = 2048
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0

CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "line": b"\n", "stop": b".?", "comma": b",;:", "bang": b"!", "pipe": b"|", "sign": b"#$%&*~^_=+<>{}[]\\/@", "space": b" \t\r\x0b\x0c"}
NAMES = (*CLASSES, "wide", "log_words", "word_bytes", "long_words", "distinct", "twin", "near_twin", "line_words", "capital_words")


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of numbers per document, in the order of NAMES."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    full = size > 0
    out = np.zeros((n, len(NAMES)), np.float32)
    if not full.any():
        return out
    cuts = offsets[:-1][full]
    per_byte = np.maximum(size, 1)
    kind = np.full(256, len(CLASSES) + 1, np.uint8)  # lower case and what is left
    for i, signs in enumerate(CLASSES.values()):
        kind[list(signs)] = i
    kind[128:] = len(CLASSES)
    kinds = kind[data]
    for i in range(len(CLASSES) + 1):
        out[full, i] = np.add.reduceat(kinds == i, cuts, dtype=np.int64)
    lines = out[:, 2].copy()
    out[:, : len(CLASSES) + 1] /= per_byte[:, None]
    hashes, doc, lengths = flat.words(data, offsets)
    words = np.bincount(doc, minlength=n)
    per_word = np.maximum(words, 1)
    same = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])))
    near = same.copy()
    for lag in range(2, 9):
        near[lag:] |= (hashes[lag:] == hashes[:-lag]) & (doc[lag:] == doc[:-lag])
    distinct = np.bincount(doc[np.unique(hashes ^ flat.mix64(doc.astype(np.uint64) + np.uint64(1)), return_index=True)[1]], minlength=n)
    first = data[np.minimum(flat.word_bounds(flat.SPACE[data], offsets)[0], len(data) - 1)]
    tail = (
        np.log1p(words),
        np.bincount(doc, lengths, n) / per_word,
        np.bincount(doc, lengths > 20, n) / per_word,
        np.log1p(distinct) / np.log1p(per_word),
        np.bincount(doc, same, n) / per_word,
        np.bincount(doc, near, n) / per_word,
        np.log1p(words / (lines + 1)),
        np.bincount(doc, (first >= 65) & (first <= 90), n) / per_word,
    )
    for i, x in enumerate(tail):
        out[:, len(CLASSES) + 1 + i] = x
    return out


def described(docs: DataFrame) -> DataFrame:
    """doc_id, did, rid and the features x of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in flat.chunks(batch.column("text")):
                x = features(data, offsets)
                rows = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
                ids = [batch.column(c).slice(a, b - a) for c in ("doc_id", "did", "rid")]
                yield pa.RecordBatch.from_arrays([*ids, rows], ["doc_id", "did", "rid", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", *row_key(), "text").mapInArrow(run, f"doc_id {kind}, did {kind}, rid long, x array<float>")


class Net:
    """One hidden layer; standardised inputs with their squares."""

    def __init__(self, x: np.ndarray, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-4
        d = x.shape[1]
        self.p = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        self.rng = rng

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def margin(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.tanh(z @ self.p[0] + self.p[1])
        return h @ self.p[2] + self.p[3][0], h

    def gradient(self, z: np.ndarray, h: np.ndarray, d: np.ndarray) -> list[np.ndarray]:
        back = d[:, None] * self.p[2] * (1 - h * h)
        return [z.T @ back, back.sum(0), h.T @ d, np.array([d.sum()])]

    def fit(self, positives: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> Net:
        """By the non-negative risk; without a prior, positives against unlabelled."""
        zp, zu = self.inputs(positives), self.inputs(unlabelled)
        first, second = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p]
        for step in range(1, STEPS + 1):
            p = zp[self.rng.integers(0, len(zp), min(BATCH, len(zp)))]
            u = zu[self.rng.integers(0, len(zu), min(BATCH, len(zu)))]
            (mp, hp), (mu, hu) = self.margin(p), self.margin(u)
            sp, su = 1 / (1 + np.exp(-np.clip(mp, -30, 30))), 1 / (1 + np.exp(-np.clip(mu, -30, 30)))
            if prior is None:
                dp, du = (sp - 1) / len(p), su / len(u)
            else:
                negative = np.logaddexp(0, mu).mean() - prior * np.logaddexp(0, mp).mean()
                dp, du = prior * (sp - 1) / len(p) - prior * sp / len(p), su / len(u)
                if negative < 0:  # max(0, .) is flat there: only the positives' risk has a gradient
                    dp, du = prior * (sp - 1) / len(p), np.zeros_like(su)
            grads = [a + b for a, b in zip(self.gradient(p, hp, dp), self.gradient(u, hu, du))]
            rate = 0.01 * (1 - step / (STEPS + 1))
            for i, g in enumerate(grads):
                g = g + 1e-4 * self.p[i]
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                self.p[i] = self.p[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.inputs(x))[0], -30, 30)))


def estimated_prior(positives: np.ndarray, unlabelled: np.ndarray) -> float:
    """The least ratio of unlabelled to positive rows above a score, with a margin for chance, on rows the scorer did not see."""
    scorer = Net(unlabelled, seed=2).fit(positives[::2], unlabelled[::2], None)
    p, u = np.sort(scorer.score(positives[1::2])), np.sort(scorer.score(unlabelled[1::2]))
    if not len(p) or not len(u):
        return 0.5
    cuts = np.quantile(p, np.linspace(0, 0.99, 100))
    over_p = 1 - np.searchsorted(p, cuts) / len(p)
    over_u = 1 - np.searchsorted(u, cuts) / len(u)
    slack = np.sqrt(np.log(4 / 0.1) / 2) * (len(p) ** -0.5 + len(u) ** -0.5)
    ratio = over_u / np.maximum(over_p, 1e-9)
    best = int(np.argmin(ratio + slack / np.maximum(over_p, 1e-9)))
    return float(np.clip(ratio[best], 0.02, 0.98))


def bounded(rows: DataFrame, most: int, salt: int) -> np.ndarray:
    """The features of at most ``most`` different rows, those with the smallest hashes.

    A bound on the hash, from the row count, leaves little more than ``most`` rows before any of them is sent to the driver.
    """
    hashed = rows.select("x", F.xxhash64("rid", F.lit(salt)).alias("h"))
    n = rows.count()
    if n > 1.2 * most:
        hashed = hashed.where(F.col("h") < int(2**64 * (1.2 * most / n)) - 2**63)
    picked = hashed.dropDuplicates(["h"]).orderBy("h").limit(most).collect()
    return np.array([r.x for r in picked], np.float64).reshape(len(picked), len(NAMES))


def fit(seen: DataFrame, labels: DataFrame, held_out: int | None = HELD_OUT) -> tuple[Net | None, float]:
    """The network and the class prior; ids whose crc32 mod ``FOLDS`` is ``held_out`` give no labels."""
    good = labels.where(F.col("quality") == 1)
    if held_out is not None:
        good = good.where(crc_mod(F.col("doc_id"), FOLDS) != held_out)
    positives = bounded(seen.join(good.select("doc_id").distinct(), "doc_id", "left_semi"), MAX_POSITIVES, 1)
    unlabelled = bounded(seen, MAX_UNLABELLED, 2)
    if len(positives) < 4 or len(unlabelled) < 4:
        return None, 0.5
    prior = estimated_prior(positives, unlabelled)
    return Net(unlabelled).fit(positives, unlabelled, prior), prior


def score(docs: DataFrame, labels: DataFrame, held_out: int | None = HELD_OUT) -> DataFrame:
    """doc_id, did, rid and score of every row of ``docs``."""
    seen = materialize(described(docs), "quality_features")
    net, prior = fit(seen, labels, held_out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), len(NAMES)).astype(np.float64)
            got = net.score(x) if net else np.full(len(batch), prior)
            ids = [batch.column(c) for c in ("doc_id", "did", "rid")]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(got, pa.float64())], ["doc_id", "did", "rid", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return seen.mapInArrow(run, f"doc_id {kind}, did {kind}, rid long, score double")


def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, held_out: int | None = HELD_OUT) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more."""
    low = score(docs, labels, held_out).where(F.col("score") < threshold)
    l_did, l_rid = unused(docs, "did", "rid")
    low = low.select(F.col("did").alias(l_did), F.col("rid").alias(l_rid)).distinct()
    did, rid = row_key()
    return docs.join(low, (did == F.col(l_did)) & (rid == F.col(l_rid)), "left_anti")

"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel compares two strings by their common character triples in order, with up to ``REACH`` - 1 characters in each gap and a
decay per character spanned, so that gapped and inserted-character forms of a word still resemble it. Strings are the words of
sentences (letters and digits, marks between them left out, runs of single letters joined), with a mark at both ends; longer
ones are read in overlapping pieces. Words of labelled sentences are the training instances, a label counting for each word of its sentences. Landmarks
are the pieces of words most tied to toxic sentences and a spread of the others; the Nyström map turns kernel values to
landmarks into vectors for a linear machine with squared hinge loss. A sum over landmarks is a sum over triples, so scoring reads one table
of triple weights. A text's score is a logistic function of its strongest word, the number of words above zero and its length, fitted on
labelled texts.

The fit uses at most ``MAX_TEXTS`` labelled ids, chosen by hash (the score one text of each), and ``MAX_WORDS`` words of their texts. Scoring covers every whole text.

Defined cases: null and empty texts score as a text without words; without labels of both kinds every score is 0; null labels are left
out; repeated labels of an id count as toxic if any is; repeated rows are scored alike. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingguard.llm import flat
from listingguard.llm.common import crc_mod, row_key
from listingguard.sources.stage import materialize

MAX_TEXTS = 20_000
MAX_WORDS = 12_000
LANDMARKS = 600
DECAY = 0.7
REACH = 4
PIECE, STRIDE = 24, 12
SYMBOLS = 64
COST = 10.0
FOLDS, HELD_OUT = 5, 0

#: Fixed: symbol 0 ends a word, 1-26 are letters, 27-36 digits (those that stand for a letter take its symbol), 37 any other; continuation bytes
#: of wider characters take 38-63 by their low bits; 255 is left out.
CODE = np.full(256, 255, np.uint8)
CODE[97:123] = np.arange(1, 27)
CODE[65:91] = np.arange(1, 27)
CODE[48:58] = np.arange(27, 37)
for _digit, _letter in (("0", "o"), ("1", "i"), ("3", "e"), ("4", "a"), ("5", "s"), ("7", "t")):
    CODE[ord(_digit)] = ord(_letter) - 96
CODE[128:192] = 38 + np.arange(64) % 26


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all words one after another, and start, length and document of each word."""
    starts, ends = flat.word_bounds(flat.SPACE[data], offsets)
    codes = CODE[data]
    kept = codes != 255
    before = np.concatenate(([0], np.cumsum(kept)))
    at, lengths = before[starts], before[ends] - before[starts]
    doc = np.searchsorted(offsets, starts, "right") - 1
    real = lengths > 0
    at, lengths, doc = at[real], lengths[real], doc[real]
    single = lengths == 1
    joins = np.zeros(len(at), bool)
    joins[1:] = single[1:] & single[:-1] & (doc[1:] == doc[:-1])
    first = np.flatnonzero(~joins)
    lengths = np.add.reduceat(lengths, first) if len(first) else lengths
    return codes[kept], at[first], lengths, doc[first]


def weights_of_length() -> np.ndarray:
    """The norm of a word's triples by its padded length, repeated triples counted apart."""
    n = np.arange(PIECE + 3)[:, None, None]
    a, b = np.arange(1, REACH + 1)[:, None], np.arange(1, REACH + 1)
    return np.sqrt((np.maximum(0, n - a - b) * DECAY ** (2 * (a + b))).sum((1, 2)))


NORM = weights_of_length()


def triples(padded: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
    """(weight, table index of every triple) for each pair of gaps of words of one padded length."""
    x = padded.astype(np.int32)
    n = x.shape[1]
    for a in range(1, REACH + 1):
        for b in range(1, min(REACH, n - 1 - a) + 1):
            yield DECAY ** (a + b), (x[:, : n - a - b] * SYMBOLS + x[:, a : n - b]) * SYMBOLS + x[:, a + b :]


def cut(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word index, start and length of the pieces of words, in the order of the words; a word longer than PIECE gives several, up to its end."""
    more = -(-np.maximum(lengths - PIECE, 0) // STRIDE)
    owner = np.repeat(np.arange(len(starts)), more + 1)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
    shift = np.minimum(step * STRIDE, np.maximum(lengths - PIECE, 0)[owner])
    return owner, starts[owner] + shift, np.minimum(lengths, PIECE)[owner]


def pieces(symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word index, padded matrix) by length; a word longer than PIECE gives several rows."""
    owner, at, size = cut(starts, lengths)
    order = np.argsort(size, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        if len(rows):
            n = int(size[rows[0]])
            padded = np.zeros((len(rows), n + 2), np.uint8)
            padded[:, 1:-1] = symbols[at[rows][:, None] + np.arange(n)]
            yield owner[rows], padded


def dot(table: np.ndarray, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each word the largest normalised sum of table values over the triples of its pieces."""
    out = np.full(len(starts), -np.inf, np.float32)
    for owner, padded in pieces(symbols, starts, lengths):
        total = np.zeros(len(padded), np.float32)
        for weight, index in triples(padded):
            total += np.float32(weight) * table[index].sum(1)
        np.maximum.at(out, owner, total / np.float32(NORM[padded.shape[1]] or 1))
    return out


def sparse_triples(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table indices and normalised weights of the triples of one piece."""
    padded = np.zeros((1, len(symbols) + 2), np.uint8)
    padded[0, 1:-1] = symbols
    found = [(index[0], np.full(index.shape[1], weight)) for weight, index in triples(padded)]
    index, back = np.unique(np.concatenate([i for i, _ in found]), return_inverse=True)
    weights = np.bincount(back, np.concatenate([w for _, w in found]))
    return index, weights / (NORM[padded.shape[1]] or 1)


def kernel(landmarks: list[tuple[np.ndarray, np.ndarray]], symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Kernel values of every word (its best piece) with every landmark."""
    used = np.unique(np.concatenate([i for i, _ in landmarks]))
    place = np.zeros(SYMBOLS**3, np.int32)  # 0: a triple that no landmark has
    place[used] = np.arange(1, len(used) + 1)
    dense = np.zeros((len(used) + 1, len(landmarks)), np.float32)
    for j, (index, weights) in enumerate(landmarks):
        dense[place[index], j] = weights
    out = np.full((len(starts), len(landmarks)), -np.inf, np.float32)
    for owner, padded in pieces(symbols, starts, lengths):
        for at in range(0, len(padded), 1000):
            some = padded[at : at + 1000]
            total = np.zeros((len(some), len(landmarks)), np.float32)
            for weight, index in triples(some):
                for column in place[index].T:
                    hit = column > 0
                    total[hit] += np.float32(weight) * dense[column[hit]]
            np.maximum.at(out, owner[at : at + 1000], total / np.float32(NORM[padded.shape[1]] or 1))
    return out


def squared_hinge(z: np.ndarray, positive: np.ndarray, negative: np.ndarray, cost: float = COST) -> np.ndarray:
    """Weights of the linear machine, the last one its bias; each row is an instance of both classes with the given weights."""
    x = np.column_stack((z, np.ones(len(z))))
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(30):  # Newton steps; the active set settles after a few
        f = x @ w
        p, n = positive * (f < 1), negative * (f > -1)
        new = np.linalg.solve(ridge + cost * (x * (p + n)[:, None]).T @ x, cost * x.T @ (p - n))
        if np.abs(new - w).max() < 1e-6:
            return new
        w = new
    return w


class Machine:
    """The triple table and bias, and the weights of the text score."""

    def __init__(self, words: list[str], positive: np.ndarray, negative: np.ndarray) -> None:
        joined = "\n".join(words).encode()
        data = np.frombuffer(joined, np.uint8)
        sizes = np.array([len(w.encode()) + 1 for w in words])
        symbols, starts, lengths, doc = units(data, np.concatenate(([0], np.cumsum(sizes)[:-1], [len(data)])))
        pos, neg = positive[doc], negative[doc]
        owner, at, size = cut(starts, lengths)
        tie = ((pos + 0.1) / (pos + neg + 1.0) * np.log1p(pos))[owner]
        tied = np.argsort(-tie, kind="stable")[: LANDMARKS // 2]
        rest = np.setdiff1d(np.arange(len(owner)), tied)
        spread = np.random.default_rng(7).permutation(rest)[: LANDMARKS - len(tied)]
        chosen = np.concatenate((tied, spread))
        landmarks = [sparse_triples(symbols[a : a + n]) for a, n in zip(at[chosen], size[chosen])]
        k = kernel(landmarks, symbols, starts, lengths).astype(np.float64)
        own = kernel(landmarks, symbols, at[chosen], size[chosen]).astype(np.float64)
        values, vectors = np.linalg.eigh((own + own.T) / 2)
        sound = values > 1e-4 * values.max()
        nystrom = vectors[:, sound] / np.sqrt(values[sound])
        w = squared_hinge(k @ nystrom, pos.astype(float), neg.astype(float))
        beta = nystrom @ w[:-1]
        self.table = np.zeros(SYMBOLS**3, np.float32)
        for b, (index, weights) in zip(beta, landmarks):
            self.table[index] += (b * weights).astype(np.float32)
        self.bias = float(w[-1])

    def words(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The decision value of each word, equal words computed once."""
        key = flat.hash_runs(symbols, starts, lengths)
        _, first, back = np.unique(key, return_index=True, return_inverse=True)
        return (dot(self.table, symbols, starts[first], lengths[first]) + self.bias)[back]

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """strongest word, log words above zero, log words: a row per document."""
        n = len(offsets) - 1
        out = np.zeros((n, 3), np.float32)
        out[:, 0] = -2.0
        symbols, starts, lengths, doc = units(data, offsets)
        if len(starts):
            f = np.clip(self.words(symbols, starts, lengths), -2, 2)
            np.maximum.at(out[:, 0], doc, f)
            out[:, 1] = np.log1p(np.bincount(doc, f > 0, n))
            out[:, 2] = np.log1p(np.bincount(doc, minlength=n))
        return out


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression, the last one its intercept, by Newton steps."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - 1e-2 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled(docs: DataFrame, labels: DataFrame, held_out: int | None) -> DataFrame:
    """did, rid, doc_id, text, toxic of at most MAX_TEXTS labelled texts outside the held-out fold."""
    known = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if held_out is not None:
        known = known.where(crc_mod(F.col("doc_id"), FOLDS) != held_out)
    n = known.count()
    if n > 1.2 * MAX_TEXTS:  # a bound on the hash leaves little more than the wanted ids to sort
        known = known.where(F.xxhash64("doc_id") < int(2**64 * (1.2 * MAX_TEXTS / n)) - 2**63)
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TEXTS)
    return docs.join(F.broadcast(picked), "doc_id")


def instances(texts: DataFrame) -> DataFrame:
    """word, pos, neg: in how many toxic and clean texts a word of a sentence stands."""
    sentences = texts.select("toxic", "did", "rid", F.explode(F.split(F.lower("text"), r"(?<=[.?!])\s+|\n")).alias("sentence"))
    word = F.explode(F.split("sentence", r"\s+")).alias("word")
    return (
        sentences.select("toxic", "did", "rid", word)
        .where(F.col("word") != "")
        .groupBy("word", "did", "rid").agg(F.max("toxic").alias("toxic"))
        .groupBy("word").agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg"))
    )


def fit(docs: DataFrame, labels: DataFrame, held_out: int | None = HELD_OUT) -> Machine | None:
    counted = materialize(instances(labelled(docs.select("doc_id", "text", *row_key()), labels, held_out)), "toxic_words")
    tie = (F.col("pos") + 0.1) / (F.col("pos") + F.col("neg") + 1.0) * F.log1p("pos")
    third = MAX_WORDS // 3
    shares = [
        counted.orderBy(tie.desc(), "word").limit(third),
        counted.orderBy((F.col("pos") + F.col("neg")).desc(), "word").limit(third),
        counted.orderBy(F.xxhash64("word"), "word").limit(third),
    ]
    rows = {r.word: (r.pos, r.neg) for s in shares for r in s.collect()}
    words = sorted(rows)
    pos, neg = (np.array([rows[w][i] for w in words], float) for i in (0, 1))
    return Machine(words, pos, neg) if pos.sum() and neg.sum() else None


def score(docs: DataFrame, labels: DataFrame, held_out: int | None = HELD_OUT) -> DataFrame:
    """doc_id, did, rid, score and strongest (the decision value of the strongest word) of every row."""
    machine = fit(docs, labels, held_out)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", *row_key(), "text")
    if machine is None:
        return rows.select("doc_id", "did", "rid", F.lit(0.0).alias("score"), F.lit(0.0).alias("strongest"))
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # a table of SYMBOLS ** 3 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in flat.chunks(batch.column("text")):
                x = shared.value.texts(data, offsets)
                ids = [batch.column(c).slice(a, b - a) for c in ("doc_id", "did", "rid")]
                yield pa.RecordBatch.from_arrays([*ids, *(pa.array(c.astype(np.float64)) for c in x.T)], ["doc_id", "did", "rid", "x1", "x2", "x3"])

    seen = materialize(rows.mapInArrow(run, f"doc_id {kind}, did {kind}, rid long, x1 double, x2 double, x3 double"), "toxic_features")
    known = labelled(seen, labels, held_out).groupBy("doc_id").agg(F.min_by(F.struct("x1", "x2", "x3", "toxic"), "rid").alias("one"))
    got = known.select("one.*").collect()
    w = logistic(np.array([r[:3] for r in got], float), np.array([r[3] for r in got], float))
    margin = F.lit(float(w[3]))
    for i in range(3):
        margin = margin + F.col(f"x{i + 1}") * float(w[i])
    return seen.select("doc_id", "did", "rid", (1 / (1 + F.exp(-margin))).alias("score"), F.col("x1").alias("strongest"))

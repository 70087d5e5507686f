"""Language-model scores by Katz backoff with Good-Turing discounts.

P(w | h) is d(r) c(hw) / c(h) for an n-gram seen r times in training and alpha(h) P(w | h without its first word) otherwise, down
to single words, where one unknown word takes the mass that discounting leaves. d(r) are Good-Turing ratios for r up to ``K``.
alpha(h) is computed from the very sums that it has to balance, so the probabilities after each history add up to one.

Work is arranged in blocks of documents and buckets of n-grams. A block is tokenised once and stored as indices into its own
words. It first asks buckets of words for ids and training counts, then sends its distinct n-grams with their own training counts to
buckets chosen by the last word of the history. Such a bucket holds every shorter gram of its n-grams as well, so one shuffle counts all
levels: it adds up the blocks' counts and stores one row, the model's table with the places of each block's grams in it. When the
discounts are known, the stored tables are read bucket by bucket without a shuffle and reply with count and denominator or a probability. A gram
that was seen has seen shorter grams, so what a history needs from the level below are discounted counts, which add up.

A history ending in a word with more than ``BUCKET_BYTES`` / 8 training tokens, or in the text's begin, is spread over buckets of their
own by the word that follows; the sums of its histories go through one more aggregation and back. What stays together at any size is one
pair of words, with one row per block and distinct n-gram. Everything is stored as partitioned tables in the shared folder.

Defined cases: null and empty texts hold one token, their end; a null doc_id counts as the empty id when splitting; repeated rows train and are
scored each; without training rows every token is unknown and has probability 1. An empty table gives an empty result. Extra
columns are ignored. doc_id is a whole number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingguard.llm import flat
from listingguard.llm.common import crc_mod
from listingguard.sources.stage import materialize

ORDER = 3
K = 5
BLOCK_BYTES = 12_000_000
BUCKET_BYTES = 8_000_000
FOLDS, HELD_OUT = 10, 0
HEAVY = 0  # in place of a level: the counts of spread words
END = np.uint64(0x5BD1E995A1C3F00D)
NOTHING, UNSEEN, BEGIN, FIRST_ID = -1, 0, 1, 2  # NOTHING stands before the begin

CELLS = "level int, kind string, block long, bucket int, hot boolean, a binary, b binary, c binary, d binary"
COLUMNS = [x.split()[0] for x in CELLS.split(", ")]


def pack(x: np.ndarray) -> bytes:
    """Numbers of 8 bytes, by byte planes."""
    x = np.ascontiguousarray(x)
    return zstandard.ZstdCompressor(level=3).compress(x.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(data: bytes, kind=np.int64) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view(kind).ravel()


def pack_sorted(x: np.ndarray) -> bytes:
    return pack(np.diff(x, prepend=x.dtype.type(0)))


def unpack_sorted(data: bytes, kind=np.int64) -> np.ndarray:
    return np.cumsum(unpack(data, kind), dtype=kind)


def steps(x: np.ndarray) -> np.ndarray:
    """Differences of neighbours as small numbers that are not negative."""
    d = np.diff(x.astype(np.int64), prepend=0)
    return (d << 1) ^ (d >> 63)


def from_steps(x: np.ndarray) -> np.ndarray:
    return np.cumsum((x >> 1) ^ -(x & 1))


def pack_grams(grams: np.ndarray, *more: np.ndarray) -> bytes:
    """Columns of sorted grams, and of what goes with them; all but the last word change little from row to row."""
    return pack(np.concatenate([*[steps(c) for c in grams[:-1]], grams[-1].astype(np.int64), *more]))


def unpack_grams(data: bytes, order: int, more: int = 0) -> np.ndarray:
    out = unpack(data).reshape(order + more, -1)
    for column in out[: order - 1]:
        column[:] = from_steps(column)
    return out


def pack_values(x: np.ndarray) -> bytes:
    """Numbers of which many are equal, as a table of values and places in it."""
    values, place = np.unique(x, return_inverse=True)
    return len(values).to_bytes(8, "little") + pack(np.concatenate((values.view(np.int64), place.astype(np.int64))))


def unpack_values(data: bytes) -> np.ndarray:
    n, both = int.from_bytes(data[:8], "little"), unpack(data[8:])
    return both[:n].view(np.float64)[both[n:]]


def cell(level: int, kind: str, block: int = -1, bucket: int = -1, hot: bool = False, **parts: bytes) -> dict:
    return {"level": level, "kind": kind, "block": block, "bucket": bucket, "hot": hot} | {c: parts.get(c) for c in "abcd"}


def frame(cells: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(cells, columns=COLUMNS)


def bucket_of(x: np.ndarray, buckets: int) -> np.ndarray:
    return (flat.mix64(x.astype(np.uint64) + np.uint64(77)) % np.uint64(buckets)).astype(np.int64)


def pair_key(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return flat.mix64(flat.mix64(h.astype(np.uint64)) + w.astype(np.uint64))


# ---- blocks -----------------------------------------------------------------------------------------------------


def tokenised(docs: DataFrame, train: Column, buckets: int) -> DataFrame:
    """A ``block`` cell per block of rows, and its ``ask`` cells for single words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for a, b, data, offsets in flat.chunks(batch.column("text")):
                hashes, doc, _ = flat.words(data, offsets)
                counts = np.bincount(doc, minlength=b - a)
                ids = batch.column("doc_id").slice(a, b - a).cast(pa.int64())
                held.append((np.insert(hashes, np.cumsum(counts), END), counts + 1, ids, batch.column("train").slice(a, b - a)))
                size += len(data) + 8 * (b - a)
                if size >= BLOCK_BYTES:
                    yield encoded((part << 24) + done, held, buckets)
                    done, held, size = done + 1, [], 0
        if held:
            yield encoded((part << 24) + done, held, buckets)

    return docs.select("doc_id", F.coalesce(train, F.lit(False)).alias("train"), "text").mapInArrow(run, CELLS)


def encoded(block: int, held: list[tuple], buckets: int) -> pa.RecordBatch:
    hashes, sizes = (np.concatenate([h[i] for h in held]) for i in (0, 1))
    ids, train = (pa.concat_arrays([h[i] for h in held]) for i in (2, 3))
    known = train.to_numpy(zero_copy_only=False)
    words, index = np.unique(hashes, return_inverse=True)
    place = bucket_of(words, buckets)
    order = np.argsort(place, kind="stable")  # words stay sorted inside a bucket
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    words, place, index = words[order], place[order], rank[index]
    counts = np.bincount(index, np.repeat(known, sizes), len(words)).astype(np.int64)
    rows = np.stack([ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), known.astype(np.int64), sizes]).astype(np.int64)
    frequent = np.argsort(-np.bincount(index, minlength=len(words)), kind="stable")  # small numbers for frequent words
    rank = np.empty_like(frequent)
    rank[frequent] = np.arange(len(frequent))
    cells = [cell(0, "block", block, a=pack(rank[index]), b=pack(rows.ravel()), c=pack(frequent))]
    for q, lo, hi in runs(place):
        cells.append(cell(1, "ask", block, q, a=pack_sorted(words[lo:hi]), b=pack(counts[lo:hi])))
    return pa.RecordBatch.from_pandas(frame(cells), schema=arrow_schema(), preserve_index=False)


def arrow_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in CELLS.split(", ")])


def runs(x: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, end) of each run of equal values."""
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(x)) + 1, [len(x)])) if len(x) else [0]
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        yield int(x[lo]), int(lo), int(hi)


# ---- buckets ----------------------------------------------------------------------------------------------------


def count_of_counts(counts: np.ndarray) -> np.ndarray:
    """How many grams were seen 1 .. K + 1 times, how many at all, and the sum of their counts."""
    seen = counts[counts > 0]
    return np.concatenate((np.bincount(seen[seen <= K + 1], minlength=K + 2)[1:], [len(seen), seen.sum()])).astype(np.int64)


def count_words(asked: pd.DataFrame, buckets: int, heavy: int) -> pd.DataFrame:
    """Replies (ids, counts) to each block, the word table of the bucket and its counts of counts."""
    bucket = int(asked.bucket.iloc[0])
    lists = [unpack_sorted(a, np.uint64) for a in asked.a]
    words, index = np.unique(np.concatenate(lists), return_inverse=True)
    counts = np.bincount(index, np.concatenate([unpack(b) for b in asked.b]), len(words)).astype(np.int64)
    ids = identify(counts, bucket, buckets)
    cells = [
        cell(1, "table", -1, bucket, a=pack_sorted(words[counts > 0]), b=pack(ids[counts > 0]), c=pack(counts[counts > 0])),
        cell(1, "stats", 1, bucket, a=pack(count_of_counts(counts))),
        cell(1, "stats", HEAVY, bucket, a=pack(count_of_counts(counts[counts >= heavy]))),
    ]
    at = 0
    for block, words_asked in zip(asked.block, lists):
        mine = index[at : at + len(words_asked)]
        at += len(words_asked)
        cells.append(cell(1, "reply", int(block), bucket, a=pack(ids[mine]), b=pack(counts[mine])))
    return frame(cells)


def identify(counts: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    """Ids that no other bucket gives out, small for frequent grams; UNSEEN without a training count."""
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    return np.where(counts > 0, FIRST_ID + rank * buckets + bucket, UNSEEN)


def composed(columns: list[np.ndarray], width: int) -> np.ndarray:
    """One number per row that sorts like the columns, whose values lie below ``width``."""
    key, top = columns[0].astype(np.int64), width
    for column in columns[1:]:
        if top > 2**62 // width:
            key = np.unique(key, return_inverse=True)[1]
            top = len(key)
        key, top = key * width + column, top * width
    return key


class Table:
    """The distinct n-grams of one bucket, sorted by history from its last word back, then by the next word; columns are places in ``ids``."""

    def __init__(self, ids: np.ndarray, word_counts: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> None:
        self.ids, self.word_counts, self.grams, self.counts = ids, word_counts, grams, counts
        self.order = len(grams)

    def level(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows that have a gram of k words, the place of each one's distinct gram, a row of each distinct gram, and each gram's count."""
        rows = np.flatnonzero(self.ids[self.grams[self.order - k]] != NOTHING)
        columns = [*range(self.order - 2, self.order - k - 1, -1), self.order - 1]
        key = composed([self.grams[c][rows] for c in columns], len(self.ids))
        _, first, index = np.unique(key, return_index=True, return_inverse=True)
        return rows, index, rows[first], np.bincount(index, self.counts[rows], len(first)).astype(np.int64)

    def histories(self, k: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the history of k - 1 words of each row, and a row of each history; rows are sorted by history."""
        new = np.zeros(len(rows), bool)
        new[:1] = True
        for c in range(self.order - 2, self.order - k - 1, -1):
            new[1:] |= np.diff(self.grams[c][rows]) != 0
        return np.cumsum(new) - 1, rows[new]

    def history_keys(self, k: int, rows: np.ndarray) -> np.ndarray:
        key = np.full(len(rows), k, np.uint64)
        for c in range(self.order - 2, self.order - k - 1, -1):
            key = pair_key(key, self.ids[self.grams[c][rows]])
        return key.view(np.int64)

    def sums(self, model: dict) -> dict:
        """Per level: rows, their counts, place of the history, a row of each history, sums per history."""
        out, numerator = {}, model[1]["words"].probability(self.word_counts)[self.grams[-1]]
        for k in range(2, self.order + 1):
            rows, index, first, counts = self.level(k)
            place, heads = self.histories(k, rows)
            back = np.empty(len(first), np.int64)
            back[index] = place
            few = [np.bincount(back, counts == r, len(heads)) for r in range(1, K + 1)]
            low = np.bincount(back, numerator[first] * (counts > 0), len(heads))
            own = discounted(counts, model[k]["d"])
            numerator = np.zeros(len(self.counts))
            numerator[rows] = own[index]
            out[k] = rows, counts[index], place, heads, np.stack([np.bincount(back, counts, len(heads)), *few, low])
        return out

    def probabilities(self, model: dict, levels: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row the count of the longest gram, its history's denominator, and P(next word | history) where that count is 0."""
        p = model[1]["words"].probability(self.word_counts)[self.grams[-1]]
        below_rows = np.ones(len(self.counts))  # the denominator of the shorter history
        top = np.zeros(len(p), np.int64)
        for k, (rows, counts, place, heads, sums) in levels.items():
            sums = np.concatenate((sums[:-1], sums[-1:] / below_rows[heads]))
            below, alpha = backoff(sums, model[k]["d"])
            below_rows[rows] = below[place]
            p[rows] = np.where(counts > 0, discounted(counts, model[k]["d"]) / below[place], alpha[place] * p[rows])
            if k == self.order:
                top[rows] = counts
        return top, below_rows.astype(np.int64), p


def merge_grams(asked: pd.DataFrame, order: int) -> pd.DataFrame:
    """The table of a bucket with the places of each block's grams in it, and its counts of counts per level."""
    bucket, hot = int(asked.bucket.iloc[0]), bool(asked.hot.iloc[0])
    lists = [unpack_sorted(x) for x in asked.a]
    ids, first = np.unique(np.concatenate(lists), return_index=True)
    word_counts = np.concatenate([unpack(x) for x in asked.b])[first]
    parts, sizes = [], []
    for own, grams in zip(lists, asked.c):
        part = unpack_grams(grams, order)
        parts.append(np.searchsorted(ids, own).astype(np.int32)[part])
        sizes.append(part.shape[1])
    grams = np.concatenate(parts, axis=1)
    del parts
    key = composed([grams[c] for c in [*range(order - 2, -1, -1), order - 1]], len(ids))
    _, first, index = np.unique(key, return_index=True, return_inverse=True)
    del key
    counts = np.bincount(index, np.concatenate([unpack(x) for x in asked.d]), len(first)).astype(np.int64)
    table = Table(ids, word_counts, grams[:, first], counts)
    up = np.diff(index, prepend=0)  # each block's places go up
    starts = np.cumsum(sizes) - sizes
    up[starts] = index[starts]
    cells = [cell(order, "stats", k, bucket, hot, a=pack(count_of_counts(table.level(k)[3]))) for k in range(2, order + 1)]
    blocks = np.concatenate(([len(sizes)], asked.block.to_numpy(), sizes, up))
    cells.append(cell(order, "table", -1, bucket, hot, a=pack_sorted(ids), b=pack(word_counts), c=pack_grams(table.grams, counts), d=pack(blocks.astype(np.int64))))
    return frame(cells)


def read_table(row, order: int) -> Table:
    packed = unpack_grams(row.c, order, 1)
    return Table(unpack_sorted(row.a), unpack(row.b), packed[:order].astype(np.int32), packed[order])


def replies(row, order: int, answer: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pd.DataFrame:
    """To each block in the order of its grams: counts, denominators of the seen ones, probabilities of the others."""
    blocks = unpack(row.d)
    n, rest = int(blocks[0]), blocks[1:]
    names, sizes, up = rest[:n], rest[n : 2 * n], rest[2 * n :]
    counts, below, p = answer
    cells = []
    for block, size, end in zip(names, sizes, np.cumsum(sizes)):
        at = np.cumsum(up[end - size : end])
        seen = counts[at] > 0
        cells.append(cell(order, "reply", int(block), int(row.bucket), bool(row.hot), a=pack(counts[at]), b=pack(below[at][seen]), c=pack_values(p[at][~seen])))
    return frame(cells)


def replied(part: pd.DataFrame, d: np.ndarray) -> np.ndarray:
    """The probabilities of replies."""
    counts = np.concatenate([unpack(x) for x in part.a])
    p, seen = np.empty(len(counts)), counts > 0
    p[seen] = discounted(counts[seen], d) / np.concatenate([unpack(x) for x in part.b])
    p[~seen] = np.concatenate([unpack_values(x) for x in part.c])
    return p


def history_sums(row, order: int, model: dict, buckets: int) -> pd.DataFrame:
    """The sums of the histories of a spread bucket, to the places where they are added up."""
    table, cells = read_table(row, order), []
    for k, (_, _, _, heads, sums) in table.sums(model).items():
        keys = table.history_keys(k, heads)
        to = bucket_of(keys, buckets)
        by = np.argsort(to, kind="stable")
        for q, lo, hi in runs(to[by]):
            cells.append(cell(k, "sums", int(row.bucket), q, True, a=pack(keys[by[lo:hi]]), b=pack(sums[:, by[lo:hi]].ravel())))
    return frame(cells)


def add_sums(cells: pd.DataFrame) -> pd.DataFrame:
    """Adds up the sums of the histories of one place and sends each spread bucket the totals of those that it has."""
    lists = [unpack(x) for x in cells.a]
    keys, index = np.unique(np.concatenate(lists), return_inverse=True)
    values = np.concatenate([unpack(x, np.float64).reshape(K + 2, -1) for x in cells.b], axis=1)
    totals = np.stack([np.bincount(index, v, len(keys)) for v in values])
    out, at = [], 0
    for level, to, own in zip(cells.level, cells.block, lists):
        out.append(cell(int(level), "total", -1, int(to), True, a=pack(own), b=pack(totals[:, index[at : at + len(own)]].ravel())))
        at += len(own)
    return frame(out)


def with_totals(cells: pd.DataFrame, order: int, model: dict) -> pd.DataFrame:
    """Replies of a spread bucket, by the totals of its histories."""
    row = cells[cells.kind == "table"].iloc[0]
    table = read_table(row, order)
    levels = table.sums(model)
    for k, part in cells[cells.kind == "total"].groupby("level"):
        keys = np.concatenate([unpack(x) for x in part.a])
        totals = np.concatenate([unpack(x, np.float64).reshape(K + 2, -1) for x in part.b], axis=1)
        by = np.argsort(keys)
        rows, counts, place, heads, _ = levels[k]
        levels[k] = rows, counts, place, heads, totals[:, by[np.searchsorted(keys, table.history_keys(k, heads), sorter=by)]]
    return replies(row, order, table.probabilities(model, levels))


# ---- the model at a block ---------------------------------------------------------------------------------------


def discounts(stats: np.ndarray) -> np.ndarray:
    """d(0 .. K); 1 where the counts of counts give no ratio between 0 and 1."""
    n = np.concatenate(([0], stats[: K + 1])).astype(float)
    d = np.ones(K + 1)
    if n[1] > 0:
        cut = (K + 1) * n[K + 1] / n[1]
        for r in range(1, K + 1):
            if n[r] > 0 and cut != 1:
                x = ((r + 1) * n[r + 1] / (n[r] * r) - cut) / (1 - cut)
                d[r] = x if 0 < x < 1 else 1.0
    return d


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= K, d[np.minimum(counts, K)], 1.0)


class Words:
    """Single-word probabilities. If nothing is discounted, one count is set aside for the unknown word."""

    def __init__(self, stats: np.ndarray) -> None:
        self.total, self.types, self.d = int(stats[-1]), int(stats[-2]), discounts(stats)
        few = np.arange(1, K + 1) * stats[:K]
        kept = float((self.d[1:] * few).sum() + self.total - few.sum())
        self.below = float(self.total) if kept < self.total else self.total + 1.0
        self.unknown = 1.0 - kept / self.below

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.d) / self.below, self.unknown)


def backoff(sums: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(denominator, alpha) of histories; a history without discounted mass sets one count aside. Unseen ones back off in full."""
    total, few, low = sums[0], sums[1 : K + 1], sums[K + 1]
    r = np.arange(1, K + 1)[:, None]
    kept = total - (few * r).sum(0) + (few * r * d[1:, None]).sum(0)
    below = np.where(kept < total - 1e-9, total, total + 1.0)
    alpha = (1.0 - kept / below) / np.maximum(1.0 - low, 1e-300)
    return below, np.where(total > 0, alpha, 1.0)


class Block:
    """One block with the replies of the words. Tokens hold 32-bit places in the block's sorted word ids."""

    def __init__(self, cells: pd.DataFrame, words: Words, heavy: int, alone: int, spread: int) -> None:
        self.words, self.heavy, self.alone, self.spread = words, heavy, alone, spread
        block = cells[cells.kind == "block"].iloc[0]
        self.block = int(block.block)
        self.rows = unpack(block.b).reshape(4, -1)
        self.sizes = self.rows[3]
        one = cells[(cells.kind == "reply") & (cells.level == 1)].sort_values("bucket")
        ids, counts = (np.concatenate([unpack(x) for x in column]) for column in (one.a, one.b))
        self.ids, first, place = np.unique(np.concatenate(([NOTHING, UNSEEN, BEGIN], ids)), return_index=True, return_inverse=True)
        self.counts = np.concatenate(([0, 0, 0], counts))[first]  # all unknown words are one
        self.word = place[3:].astype(np.int32)[unpack(block.c)][unpack(block.a)]
        self.starts = np.cumsum(self.sizes) - self.sizes

    def asks(self, order: int):
        """Tokens with a known word or the begin before them; the place of each one's distinct gram; per gram its columns, a token and its bucket."""
        columns = [self.word]
        for _ in range(order - 1):
            before = np.empty_like(self.word)
            before[1:] = columns[0][:-1]
            before[self.starts] = 2 if len(columns) == 1 else 0  # the places of BEGIN and NOTHING
            columns.insert(0, before)
        tokens = np.flatnonzero(columns[-2] != 1).astype(np.int32)
        key = composed([columns[c][tokens] for c in [*range(order - 2, -1, -1), order - 1]], len(self.ids))
        _, first, index = np.unique(key, return_index=True, return_inverse=True)
        del key
        grams = np.stack([c[tokens[first]] for c in columns])
        b = grams[-2]
        hot = (self.counts[b] >= self.heavy) | (self.ids[b] == BEGIN)
        bucket = np.where(hot, self.alone + bucket_of(pair_key(self.ids[b], self.ids[grams[-1]]), self.spread), bucket_of(self.ids[b], self.alone))
        by = np.argsort(bucket, kind="stable")
        rank = np.empty(len(by), np.int32)
        rank[by] = np.arange(len(by), dtype=np.int32)
        return tokens, rank[index], grams[:, by], bucket[by]

    def asked(self, order: int) -> pd.DataFrame:
        tokens, index, grams, place = self.asks(order)
        train = np.repeat(self.rows[2] == 1, self.sizes)
        own = np.bincount(index, train[tokens], grams.shape[1]).astype(np.int64)
        del tokens, index, train
        cells = []
        for q, lo, hi in runs(place):
            used, part = np.unique(grams[:, lo:hi], return_inverse=True)
            cells.append(cell(order, "ask", self.block, q, q >= self.alone,
                a=pack_sorted(self.ids[used]), b=pack(self.counts[used]), c=pack_grams(part.reshape(len(grams), -1)), d=pack(own[lo:hi])))
        return frame(cells)

    def scores(self, cells: pd.DataFrame, order: int, d: np.ndarray) -> pd.DataFrame:
        base = np.log10((self.counts + 0.1) / (self.words.total + 0.1 * (self.words.types + 1)))
        with np.errstate(divide="ignore"):
            score = np.log10(self.words.probability(self.counts))[self.word]
        part = cells[(cells.kind == "reply") & (cells.level > 1)].sort_values("bucket")
        if len(part):
            tokens, index, _, _ = self.asks(order)
            with np.errstate(divide="ignore"):
                score[tokens] = np.log10(replied(part, d))[index]
        return pd.DataFrame({
            "doc_id": pd.Series(self.rows[0]).astype("Int64").mask(self.rows[1] == 1),
            "n_tokens": self.sizes,
            "n_known": np.add.reduceat((self.counts > 0)[self.word].astype(np.int64), self.starts),
            "train_tokens": self.words.total,
            "base_score": np.add.reduceat(base[self.word], self.starts),
            "score": np.add.reduceat(score, self.starts),
        })


# ---- levels -----------------------------------------------------------------------------------------------------


def total_stats(table: DataFrame) -> dict[int, np.ndarray]:
    """Counts of counts, added up on the cluster: K + 3 numbers for each value of ``block``, which holds the level there."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for level, a in zip(part.block, part.a):
                yield pd.DataFrame({"level": level, "i": np.arange(K + 3), "n": unpack(a)})

    each = table.where(F.col("kind") == "stats").select("block", "a").mapInPandas(run, "level long, i int, n long")
    out: dict[int, np.ndarray] = {}
    for r in each.groupBy("level", "i").agg(F.sum("n").alias("n")).collect():
        out.setdefault(r.level, np.zeros(K + 3, np.int64))[r.i] = r.n
    return out


def released(out: pd.DataFrame) -> pd.DataFrame:
    """Gives memory that Arrow holds for later back before the next group is read."""
    pa.default_memory_pool().release_unused()
    return out


def answers(grams: DataFrame, order: int, model: dict, buckets: int) -> DataFrame:
    """``reply`` cells of the stored tables; spread ones wait for the totals of their histories."""

    def alone(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.itertuples():
                table = read_table(row, order)
                yield released(replies(row, order, table.probabilities(model, table.sums(model))))

    def sums(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.itertuples():
                yield released(history_sums(row, order, model, buckets))

    tables = grams.where(F.col("kind") == "table").select(*COLUMNS)
    spread = tables.where("hot")
    totals = spread.mapInPandas(sums, CELLS).groupBy("level", "bucket").applyInPandas(lambda x: released(add_sums(x)), CELLS)
    joined = spread.unionByName(totals).groupBy("bucket").applyInPandas(lambda x: released(with_totals(x, order, model)), CELLS)
    return tables.where("NOT hot").mapInPandas(alone, CELLS).unionByName(joined)


def score(docs: DataFrame, train: Column, order: int = ORDER) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10) of every row, by the model of the rows where ``train`` holds."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4, -(-size // BUCKET_BYTES))
    heavy = max(2, BUCKET_BYTES // 8)  # training tokens from which the histories ending in a word are spread
    first = materialize(tokenised(docs, train, buckets), "katz_blocks", ["kind"])
    blocks = first.where(F.col("kind") == "block").select(*COLUMNS)
    asked = first.where(F.col("kind") == "ask").select(*COLUMNS)
    one = materialize(asked.groupBy("bucket").applyInPandas(lambda x: count_words(x, buckets, heavy), CELLS), "katz_1", ["kind"])
    stats = total_stats(one)
    words = Words(stats.get(1, np.zeros(K + 3, np.int64)))
    share = stats[HEAVY][-1] / words.total if words.total else 0.0  # of the tokens that follow a spread word
    alone, spread = max(4, math.ceil(buckets * (1 - share))), max(4, math.ceil(buckets * share))
    known = blocks.unionByName(one.where(F.col("kind") == "reply").select(*COLUMNS))
    model: dict = {1: {"words": words}}
    if order > 1:
        asked = known.groupBy("block").applyInPandas(lambda x: released(Block(x, words, heavy, alone, spread).asked(order)), CELLS)
        merged = asked.groupBy("bucket").applyInPandas(lambda x: released(merge_grams(x, order)), CELLS)
        grams = materialize(merged, "katz_grams", ["kind"])
        model |= {k: {"d": discounts(n)} for k, n in total_stats(grams).items()}
        known = known.unionByName(answers(grams, order, model, spread))
    shape = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    d = model.get(order, {}).get("d", np.ones(K + 1))
    return known.groupBy("block").applyInPandas(lambda x: released(Block(x, words, heavy, alone, spread).scores(x, order, d)), shape)


def held_out_score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``score`` learning from rows whose crc32 mod ``FOLDS`` is not ``HELD_OUT``, with held_out."""
    fold = crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT
    return score(docs, ~fold, order).withColumn("held_out", fold)

"""Importance resampling towards a target text: hashed n-gram features from prefix checksums, Gumbel keys, one global order.

A text is normalised to its words, joined by one space, and read once: the running CRC-32 after every word and the word's byte length are
stored. The CRC of any run of words follows from two stored values, the running CRC before its first byte, shifted by the run's
length, cancelled out of the running CRC after its last byte. The shift is a linear map over GF(2), applied as table look-ups per
bit of the length; so no n-gram is ever built as a string, and every n-gram length costs the same.

Bucket counts of documents and target give each bucket a gain; a document's weight is the mean gain of its features. Adding a
seeded Gumbel number makes the highest scores a draw without replacement by weight.

Defined cases: a null or empty text has no words, no features and the weight 0, and is never drawn as long as ``min_words`` is above 0; very long texts are
read whole; a null doc_id counts as the empty text in the seed and comes last among ties; rows with equal scores and ids take consecutive ranks; an
empty target leaves the gains to the documents alone; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingguard.llm import flat
from listingguard.sources.stage import in_parallel, materialize

BUCKETS = 10_000
MAX_N = 1
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
UNIT = 1000
#: Width of the bins of the score histogram that finds where the draw ends.
SCORE_BIN = 64
#: Words whose checksums are handled together.
SLICE_WORDS = 200_000

#: Bytes that separate words become a space; A-Z become lower case.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _byte_table() -> np.ndarray:
    r = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        r = (r >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (r & np.uint32(1)))
    return r


BYTE = _byte_table()


def _look_up(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = tables[0][crc & np.uint32(255)]
    for part in range(1, 4):
        out ^= tables[part][(crc >> np.uint32(8 * part)) & np.uint32(255)]
    return out


def _shift_tables(powers: int) -> list[np.ndarray]:
    """The map "append 2^k zero bytes" for k below ``powers``, as four tables of 256 each."""
    unit = np.arange(256, dtype=np.uint32)
    start = np.stack([unit << np.uint32(8 * part) for part in range(4)])
    tables = [(start >> np.uint32(8)) ^ BYTE[start & np.uint32(255)]]
    while len(tables) < powers:
        tables.append(_look_up(tables[-1], tables[-1].ravel()).reshape(4, 256))
    return tables


SHIFT = _shift_tables(32)


def shift(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``crc`` of a prefix as it stands inside the CRC of that prefix with ``size`` more bytes."""
    out = crc.copy()
    for k in range(int(size.max()).bit_length() if len(size) else 0):
        on = np.flatnonzero((size >> k) & 1)
        out[on] = _look_up(SHIFT[k], out[on])
    return out


def after_space(crc: np.ndarray) -> np.ndarray:
    """The running CRC with one more space."""
    r = ~crc
    return ~((r >> np.uint32(8)) ^ BYTE[(r ^ np.uint32(32)) & np.uint32(255)])


def running(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The running CRC after each word of the normalised text, and the words' byte lengths."""
    words = text.translate(FOLD).split()
    if not words:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    crcs = accumulate(words[1:], lambda crc, w: crc32(w, crc32(b" ", crc)), initial=crc32(words[0]))
    return np.fromiter(crcs, np.uint32, len(words)), np.fromiter(map(len, words), np.uint32, len(words))


def prefixes(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``crcs`` and ``sizes`` (little-endian 32-bit values, one per word) of every row; the only scan of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in flat.chunks(batch.column("text")):
                body, cuts = data.tobytes(), offsets.tolist()
                found = [tuple(part.tobytes() for part in running(body[x:y])) for x, y in zip(cuts, cuts[1:])]
                crcs, sizes = (pa.array([x[i] for x in found], pa.binary()) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(a, b - a) for k in keys), crcs, sizes], [*keys, "crcs", "sizes"])

    kinds = [f"{k} {texts.schema[k].dataType.simpleString()}" for k in keys]
    return texts.select(*keys, "text").mapInArrow(run, ", ".join([*kinds, "crcs binary", "sizes binary"]))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of up to ``SLICE_WORDS`` words together; a longer document is a slice of its own."""
    for batch in batches:
        reach = np.cumsum(np.array([len(c.as_buffer()) // 4 for c in batch.column("crcs")], np.int64))
        at = 0
        while at < batch.num_rows:
            done = reach[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(reach, done + SLICE_WORDS, "right")))
            yield batch.slice(at, end - at)
            at = end


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All 32-bit values of a binary column, and the number in each row."""
    cells = [c.as_buffer() for c in column]
    return np.frombuffer(b"".join(cells), np.uint32), np.array([len(c) // 4 for c in cells], np.int64)


def feature_crcs(batch: pa.RecordBatch, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n up to ``most``: row numbers and CRCs of all runs of n words."""
    end, counts = _numbers(batch.column("crcs"))
    size = _numbers(batch.column("sizes"))[0].astype(np.int64)
    if not len(end):
        return
    first = (np.cumsum(counts) - counts)[counts > 0]
    begin = np.empty_like(end)
    begin[1:] = after_space(end[:-1])
    begin[first] = 0
    row = np.repeat(np.arange(len(counts)), counts)
    reach = np.concatenate(([0], np.cumsum(size)))
    for n in range(1, most + 1):
        at = np.flatnonzero(row[: len(row) - n + 1] == row[n - 1 :])
        bytes_ = reach[at + n] - reach[at] + n - 1
        yield row[at], end[at + n - 1] ^ shift(begin[at], bytes_)


def bucket_counts(stored: DataFrame, most: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """How many features fall into each bucket; every task sends one row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches):
            for _, crc in feature_crcs(batch, most):
                total += np.bincount((crc % np.uint32(buckets)).astype(np.int64), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in stored.select("crcs", "sizes").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(ours: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log-ratio of smoothed bucket shares, target over documents, rounded down."""
    size = len(ours)
    s, t = float(ours.sum() + size), float(target.sum() + size)
    return np.array([math.floor(UNIT * math.log((b + 1.0) * s / ((a + 1.0) * t))) for a, b in zip(ours.tolist(), target.tolist())], np.int64)


def weights(stored: DataFrame, keys: list[str], gain: np.ndarray, most: int = MAX_N) -> DataFrame:
    """``keys``, n_words, n_features and weight of every stored row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = batch.num_rows
            n_words = _numbers(batch.column("crcs"))[1]
            features, total = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            for row, crc in feature_crcs(batch, most):
                bounds = np.searchsorted(row, np.arange(rows + 1))
                features += np.diff(bounds)
                sums = np.concatenate(([0], np.cumsum(gain[crc % np.uint32(len(gain))])))
                total += sums[bounds[1:]] - sums[bounds[:-1]]
            mean = np.where(features > 0, total // np.maximum(features, 1), 0)
            columns = [*(batch.column(k) for k in keys), pa.array(n_words), pa.array(features), pa.array(mean)]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "n_words", "n_features", "weight"])

    kinds = [f"{k} {stored.schema[k].dataType.simpleString()}" for k in keys]
    return stored.mapInArrow(run, ", ".join([*kinds, "n_words long", "n_features long", "weight long"]))


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """Thousandths of a Gumbel number from the seed and the id, rounded down."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(UNIT)) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, best: int) -> DataFrame:
    """``rows`` (score, doc_id, row) with ``rank`` by falling score and rising id; null beyond ``best``.

    Rows are dealt to ranges of the order, so no task orders more than its range; rank is the place in the range plus the sizes of
    the ranges before it.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    placed = materialize(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "importance_order"
    )
    # monotonically_increasing_id holds the partition above bit 33 and the place in it below
    sizes = placed.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect()
    starts = list(accumulate((r.n for r in sizes), initial=0))
    table = rows.sparkSession.createDataFrame([(r._part, s) for r, s in zip(sizes, starts)], "_part long, _start long")
    rank = F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    joined = placed.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(table), "_part")
    return joined.withColumn("rank", F.when(rank <= best, rank)).drop("_part", "_start", "_at")


def resample(
    docs: DataFrame,
    target: DataFrame,
    most: int = MAX_N,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null: not drawn) of every row of ``docs``."""
    ours, theirs = in_parallel(
        lambda: materialize(prefixes(docs, ["doc_id"]), "importance_prefixes"), lambda: materialize(prefixes(target, []), "target_prefixes")
    )
    counts = in_parallel(*[lambda t=t: bucket_counts(t, most, buckets) for t in (ours, theirs)])
    found = weights(ours, ["doc_id"], gains(*counts), most).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    found = materialize(found.withColumn("row", F.monotonically_increasing_id()), "importance_scores")
    bin_of = F.floor(F.col("score") / SCORE_BIN)
    histogram = found.where(F.col("n_words") >= min_words).groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n")).collect()
    best = sum(r.n for r in histogram) * percent // 100
    lowest, above = None, 0
    for r in sorted(histogram, key=lambda r: -r.bin):  # some hundred bins: a score is a few tens of thousands at most
        if above >= best:
            break
        lowest, above = r.bin, above + r.n
    near = (F.col("n_words") >= min_words) & (bin_of >= lowest) if lowest is not None else F.lit(False)
    rest = found.where(~near).withColumn("rank", F.lit(None).cast("long"))
    out = ranked(found.where(near), best).unionByName(rest) if lowest is not None else rest
    return out.select("doc_id", "n_words", "n_features", "weight", "score", "rank")


#: The same draw for word features; crc32 is folded over the bytes of each distinct word.
SQL = rf"""
WITH b AS (
  SELECT list(list_reduce([i, 1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[], lambda c, one: CASE WHEN c & one = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
folded AS (
  SELECT 'd' AS side, doc_id, row_number() OVER () AS rid, text FROM documents
  UNION ALL SELECT 't', NULL, -row_number() OVER (), text FROM benchmark),
w AS (
  SELECT side, rid, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM folded),
hx AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM w)),
c AS (
  SELECT word, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, i * 2 + 1, 2))::BIGINT)),
      lambda r, x: xor(r >> 8, t[(xor(r, x) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM hx, b),
f AS (SELECT side, rid, bucket FROM w JOIN c USING (word)),
n AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t FROM f GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM n),
g AS (
  SELECT bucket, floor({UNIT} * ln((t + 1)::DOUBLE * (s_all + {BUCKETS})::DOUBLE / ((s + 1)::DOUBLE * (t_all + {BUCKETS})::DOUBLE))) AS gain FROM n, totals),
m AS (SELECT rid, count(*) AS n_features, floor(sum(gain) / count(*)) AS weight FROM f JOIN g USING (bucket) WHERE side = 'd' GROUP BY rid),
scored AS (
  SELECT doc_id, rid, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-{UNIT} * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM folded LEFT JOIN m USING (rid) WHERE side = 'd'),
drawn AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, rid) AS rank FROM scored WHERE n_features >= {MIN_WORDS}),
least AS (SELECT count(*) * {PERCENT} // 100 AS best FROM drawn)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= best THEN rank END AS rank FROM scored LEFT JOIN drawn USING (rid), least
"""

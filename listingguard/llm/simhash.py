"""SimHash near-duplicates through a hierarchical index in Gray order.

A fingerprint has 64 bits, each the majority of that bit over the XXH64 values of a text's word shingles. Distinct
fingerprints are sorted by Gray rank, so that neighbours in the order share most bits. The top of the index are the prefixes of the
rank (a prefix of the rank fixes the same prefix of the fingerprint): a query goes only to prefixes within ``MAX_BITS`` of its own. Below
each prefix a tree is built over the members in Gray order. A node keeps the bits that all fingerprints under it share and its
parent does not have already; a search adds up the differences from the root down and drops a whole group as soon as they
exceed ``MAX_BITS``. Large prefixes are cut into blocks of members and blocks of queries that are matched in tasks of their own.
A task returns a spanning forest of the links that it found, not the links; connected components join the forests.

Defined cases: a null or empty text has no words and the fingerprint zero, which links like any other; a text of fewer
words than a shingle has its whole sequence as the one shingle; a null doc_id is never the smallest of a class while another id is
there; repeated rows share their class and ``dedup`` keeps one of them. An empty table gives an empty result. Extra columns
are ignored by ``classes`` and kept by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingguard.llm.common import row_key, unused
from listingguard.llm.components import components
from listingguard.sources.stage import materialize

SHINGLE = 3
SEED = 42
MAX_BITS = 2
#: Fingerprints below one prefix of the Gray rank, on average.
PREFIX_ROWS = 2048
MAX_PREFIX_BITS = 24
MEMBER_BLOCK = 8192
QUERY_BLOCK = 65_536
LEAF, FAN = 32, 8
QUERIES_AT_ONCE = 512


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number. Splits on the six ASCII white-space characters, lower-cases A-Z only."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not ws:
        return 0
    joined = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(ws))
    digest = xxhash.xxh64_intdigest
    h = [digest(joined[a:b], SEED) for a, b in zip(starts[: len(ws) - k + 1].tolist(), ends[k - 1 :].tolist())]
    counts = np.zeros(64, np.int64)
    values = np.array(h, dtype=">u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(values), 255):  # sums of 255 bits fit one byte
        counts += np.add.reduce(np.unpackbits(values[at : at + 255], axis=1), axis=0, dtype=np.uint8)
    bits = counts * 2 > len(h)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, did, rid and fp (the fingerprint as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.array([fingerprint(x.as_py(), shingle) for x in batch.column("text")], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("did"), batch.column("rid"), pa.array(got)], ["doc_id", "did", "rid", "fp"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", *row_key(), "text").mapInArrow(run, f"doc_id {kind}, did {kind}, rid long, fp long")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayTree:
    """The index over one block of fingerprints: levels of (pattern, own mask), leaves upwards."""

    def __init__(self, fps: np.ndarray) -> None:
        self.fps = fps[np.argsort(gray_rank(fps))]
        levels, fan = [], LEAF
        both, either = self.fps, self.fps  # bits set in all, in any
        while len(both) > FAN or not levels:
            cuts = np.arange(0, len(both), fan)
            both, either = np.bitwise_and.reduceat(both, cuts), np.bitwise_or.reduceat(either, cuts)
            levels.append((both, ~(both ^ either), fan))
            fan = FAN
        self.levels = []
        for depth, (pattern, shared, fan) in enumerate(levels):
            above = np.zeros_like(shared)
            if depth + 1 < len(levels):
                above = np.repeat(levels[depth + 1][1], FAN)[: len(shared)]
            self.levels.append((pattern, shared & ~above, fan))
        self.leaf_left = ~np.repeat(levels[0][1], LEAF)[: len(self.fps)]

    def search(self, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs (query, member) with at most ``most`` differing bits."""
        top = len(self.levels[-1][0])
        q = np.repeat(np.arange(len(queries)), top)
        node = np.tile(np.arange(top), len(queries))
        spent = np.zeros(len(q), np.uint8)
        for depth in range(len(self.levels) - 1, -1, -1):
            pattern, own, fan = self.levels[depth]
            spent = spent + np.bitwise_count((queries[q] ^ pattern[node]) & own[node])
            near = spent <= most
            q, node, spent = q[near], node[near], spent[near]
            below = len(self.levels[depth - 1][0]) if depth else len(self.fps)
            child = (node[:, None] * fan + np.arange(fan)).ravel()
            q, spent = np.repeat(q, fan), np.repeat(spent, fan)
            real = child < below
            q, node, spent = q[real], child[real], spent[real]
        near = spent + np.bitwise_count((queries[q] ^ self.fps[node]) & self.leaf_left[node]) <= most
        return q[near], node[near]


def forest(block: pd.DataFrame, most: int) -> pd.DataFrame:
    """Links of one block of members with one block of queries, as (a, b) pairs that span the same classes."""
    members = block.fp[block.member].to_numpy().view(np.uint64)
    queries = block.fp[~block.member].to_numpy().view(np.uint64)
    if not len(members) or not len(queries):
        return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
    tree = GrayTree(members)
    nodes = np.unique(np.concatenate((members, queries)))
    label = np.arange(len(nodes))
    m_at, q_at = np.searchsorted(nodes, tree.fps), np.searchsorted(nodes, queries)
    for at in range(0, len(queries), QUERIES_AT_ONCE):
        q, m = tree.search(queries[at : at + QUERIES_AT_ONCE], most)
        a, b = q_at[at + q], m_at[m]
        keep = a != b
        a, b = a[keep], b[keep]
        while len(a):
            la, lb = label[a], label[b]
            differ = la != lb
            if not differ.any():
                break
            low, high = np.minimum(la, lb)[differ], np.maximum(la, lb)[differ]
            np.minimum.at(label, high, low)
            while (label != (up := label[label])).any():
                label = up
            a, b = a[differ], b[differ]
    linked = label != np.arange(len(nodes))
    signed = nodes.view(np.int64)
    return pd.DataFrame({"a": signed[linked], "b": signed[label[linked]]})


def links(distinct: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """(a, b) pairs of fingerprints that span the classes of all links; ``distinct`` holds each fingerprint once, as fp."""
    bits = min(MAX_PREFIX_BITS, max(1, ceil(log2(max(2, distinct.count() / PREFIX_ROWS)))))
    flips = [sum(1 << i for i in c) for n in range(most + 1) for c in combinations(range(bits), n)]
    prefix = F.shiftrightunsigned("fp", 64 - bits)
    members = distinct.select("fp", prefix.alias("prefix"))
    # a link between two prefixes is looked up once, in the larger one
    goes = F.filter(F.transform(F.array(*[F.lit(x) for x in flips]), lambda x: F.col("prefix").bitwiseXOR(x)), lambda p: p >= F.col("prefix"))
    queries = members.select("fp", F.explode(goes).alias("prefix"))
    counts = materialize(members.groupBy("prefix").agg(F.count("*").alias("members")), "prefixes")
    asked = counts.select("members", F.explode(goes).alias("prefix")).groupBy("prefix").agg(F.sum("members").alias("queries"))
    blocks = materialize(
        counts.join(asked, "prefix").select(
            "prefix",
            F.ceil(F.col("members") / MEMBER_BLOCK).cast("int").alias("m_blocks"),
            F.ceil(F.col("queries") / QUERY_BLOCK).cast("int").alias("q_blocks"),
        ),
        "prefix_blocks",
    )

    def place(count: str):
        return F.pmod(F.xxhash64("fp"), F.col(count)).cast("int")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    dealt = (
        members.join(blocks, "prefix")
        .select("prefix", place("m_blocks").alias("i"), every("q_blocks").alias("j"), F.lit(True).alias("member"), "fp")
        .unionByName(
            queries.join(blocks, "prefix")
            .select("prefix", every("m_blocks").alias("i"), place("q_blocks").alias("j"), F.lit(False).alias("member"), "fp")
        )
    )
    return dealt.groupBy("prefix", "i", "j").applyInPandas(lambda block: forest(block, most), "a long, b long")


def classes(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """doc_id, did, rid, fp, root (a fingerprint that names the class) and component_id (its smallest doc_id) of every row."""
    prints = materialize(fingerprints(docs, shingle), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")
    roots = materialize(components(materialize(links(distinct.select("fp"), most), "fingerprint_links")), "fingerprint_roots")
    owned = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = owned.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = materialize(owned.join(smallest, "root").select("fp", "root", "component_id"), "fingerprint_classes")
    return prints.join(by_print, "fp")


def dedup(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` per class: that with the smallest doc_id."""
    found = classes(docs, shingle, most)
    k_did, k_rid = unused(docs, "did", "rid")
    first = (
        found.groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "did", "rid")).alias("x"))
        .select(F.col("x.did").alias(k_did), F.col("x.rid").alias(k_rid))
    )
    did, rid = row_key()
    return (
        docs.withColumns({k_did: did, k_rid: rid})
        .join(first, [k_did, k_rid], "left_semi")
        .dropDuplicates([k_did, k_rid])
        .drop(k_did, k_rid)
    )


def hex_of(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")

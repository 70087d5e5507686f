"""Embedding near-duplicates by a pivot-permutation index.

Vectors of one length are compared with each other. A bounded sample of them serves as reference points (pivots), spread out: a sampled
vector within cosine ``APART`` of a pivot already kept is not one. Each vector is described by its ``NEAREST`` pivots in order. It is a
member of the lists of the first ``HOMES`` of them and asks the lists of all of them, so two vectors meet if a home of either is among
the nearest pivots of the other; a pair counts only in the smallest list where it meets. Pairs that meet are verified
by cosine in double precision. Equal vectors are one class with a size beforehand. Long lists are cut into blocks of members and blocks of
askers, matched in separate tasks, which first count the pivots that two vectors share: only pairs with ``SHARED`` or more are verified. Tasks return link counts per vector and a spanning forest of links, not pairs.

The index is approximate: a pair that meets in no list is not found. A length with at most ``NEAREST`` pivots (up to ``NEAREST`` times
``PIVOT_ROWS`` vectors) is searched in full. The number of pivots is a parameter; by default it grows with the square root of the rows,
and so do the lists.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do vectors of different
lengths; equal vectors link; repeated ids are separate vectors of one component. An empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingguard.llm.common import checked_broadcast
from listingguard.llm.components import components
from listingguard.sources.stage import materialize

#: Pivots of a length: at least so many where there are ``PIVOT_ROWS`` vectors for each, at most ``SAMPLE``.
PIVOTS, PIVOT_ROWS, SAMPLE = 256, 32, 8192
NEAREST, HOMES, SHARED = 12, 2, 3
APART = 0.7
COSINE = 0.9
MEMBER_BLOCK, ASK_BLOCK = 1024, 2048
#: Members compared with a block of askers at a time.
AT_ONCE = 128
PAIRS_AT_ONCE = 16_384


def usable(embedding: str = "embedding"):
    e = F.col(embedding)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return e.isNotNull() & finite & F.exists(e, lambda x: x != 0)


def equal_classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vec_id, digest) of all rows, digest null for those that cannot link; (node, digest, size, least id, vector, length) per distinct vector."""
    kind = "float" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "double"
    text = F.concat_ws(",", F.transform("embedding", lambda x: (x.cast("double") + 0.0).cast("string")))
    rows = vectors.select("vec_id", "embedding", F.when(usable(), F.unhex(F.sha2(text, 256))).alias("digest"))
    distinct = (
        rows.where(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.count("*").alias("size"), F.min("vec_id").alias("least"), F.first("embedding").cast(f"array<{kind}>").alias("vector"))
        .withColumns({"node": F.xxhash64("digest"), "length": F.size("vector")})
    )
    return rows.select("vec_id", "digest"), distinct


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def wanted(rows: int, pivots: int | None = None) -> int:
    most = pivots or max(PIVOTS, int(2 * sqrt(rows)))
    return max(1, min(most, SAMPLE, rows // PIVOT_ROWS))


def choose_pivots(distinct: DataFrame, pivots: int | None = None, apart: float = APART) -> dict[int, np.ndarray]:
    """Spread pivots of every length: of the sampled vectors in order of their hashes, those not too close to one before."""
    counts = {r.length: r.n for r in distinct.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    sampled = {length: min(n, 8 * wanted(n, pivots), SAMPLE) for length, n in counts.items()}
    share = [(length, min(1.0, 1.5 * k / counts[length] + 0.01)) for length, k in sampled.items()]
    shares = F.broadcast(distinct.sparkSession.createDataFrame(share, "length int, share double"))
    drawn = F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    rows = distinct.join(shares, "length").where(drawn).select("length", F.xxhash64("digest").alias("h"), "digest", "vector").toArrow()
    rows = rows.sort_by([("h", "ascending"), ("digest", "ascending")])
    lengths = rows["length"].to_numpy()
    found = {}
    for length, k in sampled.items():
        at = np.flatnonzero(lengths == length)[:k]
        x = unit(matrix(rows["vector"].take(pa.array(at)), len(at)))
        free, kept = np.ones(len(x), bool), []
        for i in range(len(x)):
            if free[i]:
                kept.append(i)
                free &= x @ x[i] < apart
                if len(kept) == wanted(counts[length], pivots):
                    break
        found[length] = x[kept]
    return found


def describe(distinct: DataFrame, points: dict[int, np.ndarray], nearest: int = NEAREST) -> DataFrame:
    """node, size, length, vector and near (the ordered indices of its nearest pivots among those of its length)."""
    kind = distinct.schema["vector"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            for length in np.unique(lengths).tolist():
                part = batch.take(pa.array(np.flatnonzero(lengths == length)))
                x = unit(matrix(part.column("vector"), len(part)))
                near = np.argsort(-(x @ points[length].T), axis=1, kind="stable")[:, :nearest].astype(np.int32)
                lists = pa.ListArray.from_arrays(np.arange(0, near.size + 1, near.shape[1], dtype=np.int32), pa.array(near.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, "near"])

    schema = f"node long, size long, length int, vector {kind}, near array<int>"
    return distinct.select("node", "size", "length", "vector").mapInArrow(run, schema)


def shared_pivots(near: np.ndarray, least: int = SHARED):
    """A function of two sets of rows: their pairs with at least ``least`` pivots in common (all of them, in lists of fewer)."""
    pivots, place = np.unique(near, return_inverse=True)
    held = np.zeros((len(near), len(pivots)), np.float32)
    np.put_along_axis(held, place.reshape(near.shape), 1, axis=1)
    return lambda a, b: np.nonzero(held[a] @ held[b].T >= min(least, near.shape[1]))


def cosines(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of pairs of rows, some at a time."""
    out = np.empty(len(a))
    for at in range(0, len(a), PAIRS_AT_ONCE):
        some = slice(at, at + PAIRS_AT_ONCE)
        out[some] = np.einsum("ij,ij->i", x[a[some]], x[b[some]])
    return out


def verify(ids: np.ndarray, sizes: np.ndarray, x: np.ndarray, near: np.ndarray, member: np.ndarray, pivot: int, homes: int, cosine: float):
    """Links between the members and the askers of one block, each counted in its smallest list only: (ids, counts, spanning label)."""
    nodes, first, place = np.unique(ids, return_index=True, return_inverse=True)
    sizes = sizes[first]
    counts, label = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    members, askers = np.flatnonzero(member), np.flatnonzero(~member)
    candidates = shared_pivots(near)
    for at in range(0, len(members), AT_ONCE):
        mine = members[at : at + AT_ONCE]
        a, b = candidates(mine, askers)
        a, b = mine[a], askers[b]
        both = (near[b, :homes] == pivot).any(1)  # two members of the list ask each other
        keep = ~both | (ids[a] < ids[b])
        a, b = a[keep], b[keep]
        linked = cosines(x, a, b) >= cosine
        a, b = a[linked], b[linked]
        own = np.full(len(a), np.iinfo(np.int32).max, np.int32)
        for p in range(near.shape[1]):
            meets = (near[b, : near.shape[1] if p < homes else homes] == near[a, p, None]).any(1)
            own[meets] = np.minimum(own[meets], near[a[meets], p])
        a, b = place[a[own == pivot]], place[b[own == pivot]]
        counts += (np.bincount(a, sizes[b], len(nodes)) + np.bincount(b, sizes[a], len(nodes))).astype(np.int64)
        while len(a):
            la, lb = label[a], label[b]
            differ = la != lb
            if not differ.any():
                break
            np.minimum.at(label, np.maximum(la, lb)[differ], np.minimum(la, lb)[differ])
            while (label != (up := label[label])).any():
                label = up
            a, b = a[differ], b[differ]
    return nodes, counts, label


def links(described: DataFrame, homes: int = HOMES, cosine: float = COSINE) -> DataFrame:
    """node, other, n: n linked vectors found in a block for node, and other, a node it links to there (itself if none)."""
    key = ["length", "pivot"]
    listed = described.select("node", "length", F.posexplode("near").alias("at", "pivot"))
    lists = listed.groupBy(key).agg(F.count_if(F.col("at") < homes).alias("members"), F.count("*").alias("askers"))
    blocks = checked_broadcast(
        lists.where((F.col("members") > 0) & (F.col("askers") > 1)).select(
            *key,
            F.ceil(F.col("members") / MEMBER_BLOCK).cast("int").alias("m_blocks"),
            F.ceil(F.col("askers") / ASK_BLOCK).cast("int").alias("a_blocks"),
        ),
        "pivot_blocks",
    )
    placed = described.select("*", F.posexplode("near").alias("at", "pivot")).join(blocks, key)

    def place(count: str):
        return F.pmod(F.xxhash64("node"), F.col(count)).cast("int")

    def every(count: str):
        return F.sequence(F.lit(0), F.col(count) - 1)

    def cells(i, j, member: bool):
        one = F.transform(i, lambda m: F.transform(j, lambda a: F.struct(m.alias("i"), a.alias("j"), F.lit(member).alias("member"))))
        return F.flatten(one)

    asks = cells(every("m_blocks"), F.array(place("a_blocks")), False)
    holds = F.when(F.col("at") < homes, cells(F.array(place("m_blocks")), every("a_blocks"), True))
    dealt = placed.select("node", "size", "vector", "near", *key, F.explode(F.concat(asks, F.coalesce(holds, F.array()))).alias("cell"))
    at = [*key, "i", "j"]
    spread = dealt.select("node", "size", "vector", "near", *key, "cell.*").repartition(*at).sortWithinPartitions(*at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solved(table: pa.Table) -> pa.RecordBatch:
            column = {c: table.column(c).to_numpy() for c in ("node", "size", "member", *at)}
            change = np.any([np.diff(column[c]) != 0 for c in at], axis=0)
            cuts = np.concatenate(([0], np.flatnonzero(change) + 1, [table.num_rows]))
            nodes, others, counts = [], [], []
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                mine = slice(lo, hi)
                x, near = (matrix(table.column(c).slice(lo, hi - lo), hi - lo) for c in ("vector", "near"))
                ids, n, label = verify(
                    column["node"][mine], column["size"][mine], unit(x), near, column["member"][mine], int(column["pivot"][lo]), homes, cosine
                )
                linked = (n > 0) | (label != np.arange(len(ids)))
                nodes.append(ids[linked])
                others.append(ids[label[linked]])
                counts.append(n[linked])
            none = np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c or [none])) for c in (nodes, others, counts)], ["node", "other", "n"])

        for batch in batches:
            if not len(batch):
                continue
            keys = [batch.column(c).to_numpy() for c in at]
            last = np.ones(len(batch), bool)
            for k in keys:
                last &= k == k[-1]
            if held:
                before = [held[-1].column(c)[-1].as_py() for c in at]
                if all(k[-1] == b for k, b in zip(keys, before)) and last.all():
                    held.append(batch)
                    continue
            cut = len(batch) - int(last.sum())  # the rows of the last block may go on in the next batch
            table = pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
            if table.num_rows:
                yield solved(table)
        if held:
            yield solved(pa.Table.from_batches(held))

    return spread.mapInArrow(run, "node long, other long, n long")


def near_duplicates(
    vectors: DataFrame, pivots: int | None = None, nearest: int = NEAREST, homes: int = HOMES, cosine: float = COSINE
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows, distinct = equal_classes(vectors)
    distinct = materialize(distinct, "distinct_vectors")
    points = choose_pivots(distinct, pivots)
    if points:
        described = materialize(describe(distinct, points, nearest), "described_vectors")
        found = materialize(links(described, homes, cosine), "vector_links")
    else:
        found = distinct.select("node", F.col("node").alias("other"), F.col("size").alias("n"))
    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    owned = materialize(
        distinct.select("digest", "node", "size", "least")
        .join(counts, "node", "left")
        .join(roots, "node", "left")
        .select(
            "digest", "least", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")
        ),
        "vector_roots",
    )
    smallest = owned.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = materialize(owned.join(smallest, "root").select(F.col("digest").alias("d"), "n_links", "component_id"), "vector_classes")
    return rows.join(classes, F.col("digest") == F.col("d"), "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )

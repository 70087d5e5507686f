"""Keyword retrieval over a text corpus, and the context texts built from it.

A term is made of word characters only, so it occurs in a document exactly when it occurs inside one of the document's
word tokens. Scoring therefore never pairs every query with every document: terms meet the *distinct tokens*
through an equi-join on a short leading gram, and tokens lead to documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingguard.functions.exprs import report_round, words
from listingguard.operators.lookup import fits_broadcast, left_lookup, with_scalars
from listingguard.sources.stage import materialize

# Words ignored in a query.
STOP_WORDS = (
    "the",
    "is",
    "at",
    "which",
    "on",
    "a",
    "an",
    "and",
    "or",
    "but",
    "in",
    "with",
    "to",
    "for",
    "of",
    "as",
    "by",
    "what",
    "why",
    "how",
    "this",
    "that",
    "these",
    "those",
    "be",
    "was",
    "were",
    "are",
    "do",
    "does",
    "did",
    "can",
    "could",
    "should",
    "would",
    "i",
    "you",
    "it",
)

GRAM = 5
FALLBACK_SHARDS = 64


def query_terms(text: str | Column) -> Column:
    """Distinct words of a query without stop words."""
    return F.array_except(F.array_distinct(words(text)), F.array(*[F.lit(w) for w in STOP_WORDS]))


def _checked(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if fits_broadcast(table) else table


def query_words(queries: DataFrame, key: Sequence[str]) -> DataFrame:
    """key…, _n (number of terms) and term: one row per query and distinct term."""
    terms = queries.withColumn("_terms", query_terms("text")).select(
        *key, F.size("_terms").alias("_n"), F.explode("_terms").alias("term")
    )
    return materialize(terms, "query_terms")


def term_hits(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, term): the query terms that occur in each document. The corpus is tokenised once."""
    distinct = terms.select("term").distinct().withColumn("_g", F.least(F.length("term"), F.lit(GRAM)))
    distinct = materialize(distinct.withColumn("_gram", F.expr("substring(term, 1, _g)")), "query_grams")
    # The outer explode spares an inferred filter that would tokenise every text twice.
    doc_tokens = docs.select("doc_id", F.explode_outer(F.array_distinct(words("text"))).alias("token"))
    doc_tokens = materialize(doc_tokens.where(F.col("token").isNotNull()), "doc_tokens")
    vocabulary = doc_tokens.select("token").distinct()
    grams = F.expr(
        f"flatten(transform(sequence(1, {GRAM}), g -> "
        "transform(sequence(1, length(token)), i -> substring(token, i, g))))"
    )
    pieces = vocabulary.select("token", F.explode_outer(F.array_distinct(grams)).alias("_gram"))
    pairs = pieces.join(_checked(distinct), "_gram").where(F.col("token").contains(F.col("term")))
    pairs = materialize(pairs.select("term", "token").distinct(), "term_tokens")
    return doc_tokens.join(_checked(pairs), "token").select("doc_id", "term").distinct()


def scores(docs: DataFrame, queries: DataFrame, key: Sequence[str], index: Index | None = None) -> DataFrame:
    """(key…, doc_id, score) for every query and document that share at least one term.

    ``docs`` has (doc_id, text), ``queries`` has (key…, text). The pairs are counted block by block; none of them is shuffled.
    """
    key = list(key)
    index = index or build_index(docs)
    terms = query_words(queries, key)
    asked, names = _asked(terms, key)
    met = _blocks(index, names, asked).mapInArrow(_pairs, PAIR).join(_checked(asked.drop("_terms")), "_q")
    counted = met.select(*key, "_n", "doc_id", "_m")
    nameless = docs.where(F.col("doc_id").isNull())
    if nameless.head(1):  # all of them count as one document
        counted = counted.unionByName(_counted(term_hits(nameless, terms), terms, key))
    return _scored(counted, key)


def _counted(hits: DataFrame, terms: DataFrame, key: list[str]) -> DataFrame:
    return hits.join(_checked(terms), "term").groupBy(*key, "doc_id", "_n").agg(F.count(F.lit(1)).alias("_m"))


def _scored(counted: DataFrame, key: list[str]) -> DataFrame:
    return counted.select(*key, "doc_id", report_round(F.col("_m") / F.col("_n"), 4).alias("score"))


HEAD = 256
#: Distinct terms up to which a corpus without an index is read once, a bit per term, instead of being indexed.
SCANNED_TERMS = 60

#: Length of the pieces by which the stored index finds the tokens of a term.
INDEX_GRAM = 3
#: Documents of one block, queries that meet a block at once, and those of them that are counted in one step.
BLOCK_DOCS = 2_048
BLOCK_QUERIES = 16_384
STEP_QUERIES = 512
#: Stored blocks, of some megabytes each, that are written or read at once.
GROUP_BLOCKS = 4
#: A term in fewer documents of a block than this is counted one by one, others as whole rows of the block.
FEW = 64
#: Blocks of queries whose best documents a task keeps before it gives them out.
KEPT_BLOCKS = 64
#: Terms opened beyond the rarest ones that a better document cannot avoid; it then has to match one more of them for each.
EXTRA = 2
NO_BOUND = 2**62
#: (document, term) pairs that a block of documents expands at once; one token may have more.
STEP_PAIRS = 2_000_000


class Index(NamedTuple):
    """A corpus stored for retrieval; every document has its own doc_id.

    ``documents`` (doc_id, tokens) has each document's distinct tokens, ``postings`` (token, block, docs) the documents of a token by
    blocks of about ``BLOCK_DOCS`` documents, ``grams`` (gram, token, df) the pieces of each token with its number of documents.
    """

    documents: DataFrame
    postings: DataFrame
    grams: DataFrame


def _grams(text: str) -> Column:
    at = F.sequence(F.lit(1), F.length(text) - (INDEX_GRAM - 1))
    return F.array_distinct(F.transform(at, lambda i: F.substring(F.col(text), i, F.lit(INDEX_GRAM))))


def build_index(docs: DataFrame, keep: Callable[[str, Callable[[], DataFrame]], DataFrame] | None = None) -> Index:
    """The index of ``docs`` (doc_id, text). ``keep`` stores a table under a name; given one that remembers, later calls only read."""
    keep = keep or (lambda name, build: materialize(build(), name))
    documents = keep("index_documents", lambda: docs.select("doc_id", F.array_distinct(words("text")).alias("tokens")))

    def posted() -> DataFrame:
        block = F.pmod(F.xxhash64("doc_id"), F.lit(-(-documents.count() // BLOCK_DOCS) or 1)).cast("int")
        each = documents.where(F.col("doc_id").isNotNull()).select(F.explode("tokens").alias("token"), block.alias("block"), "doc_id")
        return each.groupBy("token", "block").agg(F.collect_set("doc_id").alias("docs"))

    postings = keep("index_postings", posted)

    def pieces() -> DataFrame:
        long = postings.where(F.length("token") >= INDEX_GRAM)
        return long.groupBy("token").agg(F.sum(F.size("docs")).alias("df")).select(F.explode(_grams("token")).alias("gram"), "token", "df")

    return Index(documents, postings, keep("index_grams", pieces))


def _long_term_tokens(index: Index, terms: DataFrame) -> DataFrame:
    """(term, token, df) for the terms of ``INDEX_GRAM`` characters and more, each looked up by its rarest piece."""
    distinct = terms.select("term").distinct().where(F.length("term") >= INDEX_GRAM)
    parts = materialize(distinct.select("term", F.explode(_grams("term")).alias("gram")), "term_grams")
    sizes = index.grams.join(_checked(parts.select("gram").distinct()), "gram").groupBy("gram").agg(F.count(F.lit(1)).alias("_tokens"))
    rarest = (
        parts.join(sizes, "gram", "left")
        .groupBy("term")
        .agg(F.min(F.struct(F.coalesce("_tokens", F.lit(0)).alias("_tokens"), "gram")).alias("_rarest"))
        .where(F.col("_rarest._tokens") > 0)
        .select("term", F.col("_rarest.gram").alias("gram"))
    )
    pairs = index.grams.join(_checked(materialize(rarest, "rarest_grams")), "gram").where(F.col("token").contains(F.col("term")))
    return materialize(pairs.select("term", "token", "df"), "term_tokens")


def _short_term_tokens(index: Index, terms: DataFrame) -> DataFrame:
    """(term, token) for terms of fewer than ``INDEX_GRAM`` characters."""
    pieces = F.expr(
        f"flatten(transform(sequence(1, {INDEX_GRAM - 1}), g -> "
        "transform(sequence(1, length(token)), i -> substring(token, i, g))))"
    )
    each = index.postings.select("token").distinct().select("token", F.explode(F.array_distinct(pieces)).alias("term"))
    return each.join(_checked(terms), "term").select("term", "token")


def _asked(terms: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """The queries (key…, _n, _q, _terms) with a number of their own and the numbers of their terms, and the terms (term, _t)."""
    names = materialize(terms.select("term").distinct().withColumn("_t", F.monotonically_increasing_id()), "term_numbers")
    asked = terms.join(_checked(names), "term").groupBy(*key, "_n").agg(F.collect_list("_t").alias("_terms"))
    return materialize(asked.withColumn("_q", F.monotonically_increasing_id()), "asked_queries"), names


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a column of lists, one list after the other, and where each list begins and the last one ends."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    at = lists.offsets.to_numpy()
    return lists.values.to_numpy()[at[0] : at[-1]], at - at[0]


def _packed(**columns: np.ndarray) -> pa.Table:
    return pa.table({name: pa.array([values.tobytes()], pa.binary()) for name, values in columns.items()})


def _pack_documents(rows: pa.Table) -> pa.Table:
    """One block of (docs, terms), a row per token: its documents, its terms, and the documents of each term by their place."""
    docs, doc_at = _lists(rows["docs"])
    terms, term_at = _lists(rows["_terms"])
    ids, place = np.unique(docs, return_inverse=True)
    names, name = np.unique(terms, return_inverse=True)
    many, wide = np.diff(doc_at), np.diff(term_at)
    pairs = np.r_[0, np.cumsum(many * wide)]
    found, low = [], 0
    while low < len(many):
        high = max(low + 1, int(np.searchsorted(pairs, pairs[low] + STEP_PAIRS, "right")) - 1)
        row = np.repeat(np.arange(low, high), np.diff(pairs[low : high + 1]))
        inside = np.arange(len(row)) - (pairs[row] - pairs[low])
        found.append(np.unique(name[term_at[row] + inside % wide[row]] * len(ids) + place[doc_at[row] + inside // wide[row]]))
        low = high
    hits = np.unique(np.concatenate(found))  # a document may have a term in several tokens
    ends = np.searchsorted(hits, np.arange(1, len(names) + 1) * len(ids))
    return _packed(docs=ids, names=names, ends=ends, places=(hits % len(ids)).astype("int32"))


def _pack_queries(rows: pa.Table) -> pa.Table:
    terms, at = _lists(rows["_terms"])
    block = rows["_b"].combine_chunks()
    return _packed(q=rows["_q"].to_numpy(), terms=terms, query_ends=at[1:].astype("int64")).append_column("_b", pa.array([block[0].as_py()], pa.int32()))


def _blocks(index: Index, names: DataFrame, asked: DataFrame) -> DataFrame:
    """Every block of documents beside every block of queries, both packed: what pairs are counted from."""
    context = asked.sparkSession.sparkContext
    pairs = _long_term_tokens(index, names).select("term", "token")
    short = names.where(F.length("term") < INDEX_GRAM)
    if short.head(1):
        pairs = pairs.unionByName(_short_term_tokens(index, short))
    tokens = pairs.join(_checked(names), "term").groupBy("token").agg(F.collect_list("_t").alias("_terms"))
    hits = index.postings.join(_checked(materialize(tokens, "token_terms")), "token").select("block", "docs", "_terms")
    blocks = -(-index.documents.count() // BLOCK_DOCS) or 1
    laid = hits.repartition(min(blocks, 2 * context.defaultParallelism), "block")
    documents = laid.groupBy("block").applyInArrow(_pack_documents, "docs binary, names binary, ends binary, places binary")
    groups = -(-asked.count() // BLOCK_QUERIES) or 1
    numbered = asked.select("_q", "_terms", F.pmod(F.xxhash64("_q"), F.lit(groups)).cast("int").alias("_b"))
    queries = numbered.groupBy("_b").applyInArrow(_pack_queries, "q binary, terms binary, query_ends binary, _b int")
    if fits_broadcast(asked):
        return documents.crossJoin(F.broadcast(queries))
    stored = materialize(documents, "document_blocks", group_rows=GROUP_BLOCKS)
    return stored.crossJoin(materialize(queries, "query_blocks", group_rows=GROUP_BLOCKS))


def _scanned(docs: DataFrame, names: DataFrame, asked: DataFrame) -> DataFrame:
    """(doc_id, _q, _m) for few terms: one pass over the texts. A term is in a document when it is inside one of its tokens."""
    bits = {r["_t"]: (1 << i, r["term"]) for i, r in enumerate(names.collect())}
    tokens = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.array_join(words("text"), " ").alias("_shown"))
    found = F.lit(0).cast("bigint")
    for bit, term in bits.values():
        found = found.bitwiseOR(F.when(F.contains("_shown", F.lit(term)), F.lit(bit)).otherwise(F.lit(0)).cast("bigint"))
    # A filter on the bits before the aggregation would find them, and so split the texts, a second time.
    per_doc = tokens.select("doc_id", found.alias("_had")).groupBy("doc_id").agg(F.bit_or("_had").alias("_had"))
    masks = [(r["_q"], sum(bits[t][0] for t in r["_terms"])) for r in asked.select("_q", "_terms").collect()]
    queries = asked.sparkSession.createDataFrame(masks, "_q long, _mask long")
    shared = F.bit_count(F.col("_had").bitwiseAND(F.col("_mask"))).cast("bigint").alias("_m")
    return per_doc.crossJoin(F.broadcast(queries)).select("doc_id", "_q", shared).where(F.col("_m") > 0)


def _matched(batch: pa.RecordBatch, at: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For steps of the queries of row ``at``: their numbers, the documents, and how many terms each query has in each document."""

    def read(name: str, kind: str = "int64") -> np.ndarray:
        return np.frombuffer(batch.column(name)[at].as_buffer(), kind)

    docs, names, places = read("docs"), read("names"), read("places", "int32")
    last = read("ends")
    first = np.r_[0, last[:-1]]
    q, terms, query_last = read("q"), read("terms"), read("query_ends")
    query_first = np.r_[0, query_last[:-1]]
    held = np.minimum(np.searchsorted(names, terms), len(names) - 1)
    known = names[held] == terms
    dense = known & (last[held] - first[held] >= FEW)
    most = int((query_last - query_first).max())
    kind = next(k for k in ("uint8", "uint16", "int64") if most <= np.iinfo(k).max)
    for low in range(0, len(q), STEP_QUERIES):
        high = min(low + STEP_QUERIES, len(q))
        part = slice(query_first[low], query_last[high - 1])
        owner = np.repeat(np.arange(high - low), query_last[low:high] - query_first[low:high])
        count = np.zeros((high - low, len(docs)), kind)

        def spread(term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:  # the places of each term, and whose they are
            n = last[term] - first[term]
            row = np.repeat(np.arange(len(term)), n)
            return row, places[np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[term], n)]

        used, mine = np.unique(held[part][dense[part]], return_inverse=True)
        row, place = spread(used)
        whole = np.zeros((len(used), len(docs)), kind)
        whole[row, place] = 1
        asks = owner[dense[part]]
        n = np.bincount(asks, minlength=high - low)
        order = np.argsort(-n, kind="stable")  # the queries with the most rows first, so that each turn adds to a head of them
        begin = (np.cumsum(n) - n)[order]
        for turn in range(int(n.max())):
            on = int(np.searchsorted(-n[order], -turn, "left"))
            count[:on] += whole[mine[begin[:on] + turn]]
        rare = known[part] & ~dense[part]
        row, place = spread(held[part][rare])
        rank = np.empty(high - low, "int64")
        rank[order] = np.arange(high - low)
        np.add.at(count, (rank[owner[rare]][row], place), 1)
        yield q[low:high][order], docs, count


PAIR = "_q long, doc_id long, _m long"


def _rows(q: np.ndarray, docs: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype("int64")) for c in (q, docs, m)], ["_q", "doc_id", "_m"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every pair that shares a term."""
    for batch in batches:
        for at in range(batch.num_rows):
            for q, docs, count in _matched(batch, at):
                for low in range(0, len(q), 64):
                    query, doc = np.nonzero(count[low : low + 64])
                    yield _rows(q[low + query], docs[doc], count[low + query, doc])


def _best_of(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The ``n`` best documents of each query among the blocks of a task; ties go to the smaller id."""

    def given(kept: dict) -> Iterator[pa.RecordBatch]:
        for q, m, doc in kept.values():
            query, at = np.nonzero(m)
            yield _rows(q[query], doc[query, at], m[query, at])
        kept.clear()

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict = {}
        for batch in batches:
            for at in range(batch.num_rows):
                for step, (q, docs, count) in enumerate(_matched(batch, at)):
                    name = (batch.column("_b")[at].as_py(), step)
                    if name not in kept:
                        if len(kept) >= KEPT_BLOCKS * BLOCK_QUERIES // STEP_QUERIES:
                            yield from given(kept)
                        sorted_q = np.sort(q)
                        kept[name] = (sorted_q, np.zeros((len(q), n), "int64"), np.full((len(q), n), np.iinfo("int64").max))
                    sorted_q, m, doc = kept[name]
                    slot = np.searchsorted(sorted_q, q)  # steps hold the same queries, in another order in each block
                    rows = np.arange(len(q))
                    new_m, new_doc = [], []
                    for _ in range(min(n, len(docs))):
                        top = count[rows].argmax(axis=1) if len(rows) < len(q) else count.argmax(axis=1)  # docs ascend
                        value = count[rows, top].astype("int64")
                        worst, at_worst = m[slot[rows], -1], doc[slot[rows], -1]
                        better = (value > worst) | ((value == worst) & (value > 0) & (docs[top] < at_worst))
                        if not better.any():
                            break
                        rows, top, value = rows[better], top[better], value[better]
                        count[rows, top] = 0
                        here = slot[rows]
                        # the place after all that are better: more terms, or as many and a smaller id
                        both_m, both_doc = np.c_[m[here], value], np.c_[doc[here], docs[top]]
                        order = np.lexsort((both_doc, -both_m), axis=-1)[:, :n]
                        m[here], doc[here] = np.take_along_axis(both_m, order, 1), np.take_along_axis(both_doc, order, 1)
        yield from given(kept)

    return best


def _opened_counts(
    docs: DataFrame, terms: DataFrame, key: list[str], n: int, last: int, index: Index, top: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """(key…, _n, doc_id, _m) for keys that have a null or stand for several queries, by the bar of the head (documents up to ``last``).

    The terms of such a key count once for each query. Beyond the head it meets only documents of its terms with the fewest postings, as many
    as the bar leaves open; a null key meets none there.
    """
    first = docs.where(F.col("doc_id") <= last)
    early = materialize(top(_counted(term_hits(first, terms), terms, key)), "retrieval_head")
    bar = early.where(F.col("rank") == n).select(*key, F.col("_m").alias("_bar"))
    pairs = _long_term_tokens(index, terms)
    reach = pairs.groupBy("term").agg(F.sum("df").alias("_reach"))
    rarity = Window.partitionBy(*key).orderBy("_reach", F.desc(F.length("term")), "term")
    ranked = (
        terms.join(reach, "term", "left")
        .withColumn("_reach", F.when(F.length("term") < INDEX_GRAM, F.lit(NO_BOUND)).otherwise(F.coalesce("_reach", F.lit(0))))
        .join(bar, key, "left")
        .withColumn("_bar", F.coalesce("_bar", F.lit(0)))
        .withColumn("_open", F.row_number().over(rarity) <= F.col("_n") - F.col("_bar") + EXTRA)
        .where(F.col("_reach") > 0)  # terms of no document are among the first; no document has them
        .select(*key, "term", "_open", (F.least("_bar", F.lit(EXTRA)) + 1).alias("_need"))
    )
    ranked = materialize(ranked, "ranked_terms")
    opened = ranked.where("_open").drop("_open")
    names = materialize(opened.select("term").distinct(), "opened_names")
    wanted = pairs.join(_checked(names), "term").select("term", "token")
    short = names.where(F.length("term") < INDEX_GRAM)
    if short.head(1):
        wanted = wanted.unionByName(_short_term_tokens(index, short))
    wanted = materialize(wanted, "opened_tokens")
    hits = index.postings.join(_checked(wanted), "token").select("term", F.explode("docs").alias("doc_id"))
    shared = (
        hits.where(F.col("doc_id") > last).distinct()
        .join(_checked(opened), "term").groupBy(*key, "doc_id", "_need").agg(F.count(F.lit(1)).alias("_k"))
    )
    candidates = materialize(shared.where(F.col("_k") >= F.col("_need")).drop("_need"), "retrieval_candidates")
    closed = F.collect_list(F.when(~F.col("_open"), F.col("term"))).alias("_closed")
    asked = terms.select(*key, "_n").distinct().join(ranked.groupBy(*key).agg(closed), key)
    shown = index.documents.select("doc_id", F.array_join("tokens", " ").alias("_shown"))
    found = (
        candidates.join(_checked(materialize(asked, "query_term_lists")), key)
        .join(shown, "doc_id")
        .select(*key, "doc_id", "_n", (F.col("_k") + F.size(F.filter("_closed", lambda t: F.contains("_shown", t)))).alias("_m"))
    )
    return early.drop("rank").unionByName(found)


def best_scores(docs: DataFrame, queries: DataFrame, key: Sequence[str], n: int, head: int = HEAD, index: Index | None = None) -> DataFrame:
    """The ``n`` best of ``scores`` per query with their rank; no pair of a query and a document becomes a row.

    Blocks of documents meet blocks of queries; each task counts their pairs in numpy and gives out the ``n`` best of a query only. Few
    terms without an ``index`` take one pass over the texts and need none.
    Keys that have a null or stand for several queries go by the first ``head`` documents in corpus order (``_opened_counts``).
    """
    key = list(key)
    terms = query_words(queries, key)
    last = docs.select("doc_id").orderBy("doc_id").limit(head).agg(F.max("doc_id")).first()[0]
    order = Window.partitionBy(*key).orderBy(F.desc("_m"), "doc_id")

    def top(counted: DataFrame) -> DataFrame:
        # Spark keeps only n rows per query and map task before this shuffle.
        return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    several = queries.where(whole).groupBy(*key).agg(F.count(F.lit(1)).alias("_times")).where(F.col("_times") > 1)
    several = materialize(several.select(*key), "repeated_queries")
    plain, odd = terms.where(whole), terms.where(~whole)
    if several.head(1):
        plain = plain.join(_checked(several), key, "left_anti")
        odd = odd.unionByName(terms.join(_checked(several), key, "left_semi").select(*terms.columns))
    asked, names = _asked(plain, key)
    if index is None and all(fits_broadcast(t, SCANNED_TERMS) for t in (names, asked)):
        met = _scanned(docs, names, asked)
    else:
        index = index or build_index(docs)
        met = _blocks(index, names, asked).mapInArrow(_best_of(n), PAIR)
    met = met.join(_checked(asked.drop("_terms")), "_q")
    found = met.select(*key, "_n", "doc_id", "_m")
    copies = docs.where(F.col("doc_id") > last).groupBy("doc_id").agg(F.count(F.lit(1)).alias("_copies"))
    copies = materialize(copies.where(F.col("_copies") > 1), "repeated_documents")
    if copies.head(1):  # beyond the head each row of a document counts
        each = F.explode(F.sequence(F.lit(1), F.coalesce("_copies", F.lit(1)))).alias("_copy")
        found = top(found).drop("rank").join(_checked(copies), "doc_id", "left").select(*found.columns, each).drop("_copy")
    if odd.head(1):
        index = index or build_index(docs)
        found = found.unionByName(_opened_counts(docs, materialize(odd, "odd_terms"), key, n, last, index, top).select(*found.columns))
    merged = top(found)
    return merged.select(*key, "doc_id", report_round(F.col("_m") / F.col("_n"), 4).alias("score"), "rank")


def retrieve(docs: DataFrame, queries: DataFrame, key: Sequence[str], n: int = 4, index: Index | None = None) -> DataFrame:
    """The ``n`` best documents per query with their rank, ties in corpus order (doc_id).

    Documents without a shared term score 0 and fill up in corpus order. A query that matches nothing
    gets every document, which is the asked-for result; those rows are spread over shards of the corpus.
    """
    key = list(key)
    best = materialize(best_scores(docs, queries, key, n, index=index), "retrieval_best")
    matched = best.groupBy(*key).agg(F.max("rank").alias("_found"))
    per_query = materialize(queries.select(*key).join(matched, key, "left"), "retrieval_counts")
    short = per_query.where((F.col("_found") >= 1) & (F.col("_found") < n))
    # At most n - 1 of the first 2n - 1 documents are matched, so these are enough to fill up.
    head = docs.select("doc_id").orderBy("doc_id").limit(2 * n - 1)
    heads = head.agg(F.sort_array(F.collect_list("doc_id")).alias("_head"))
    fill = with_scalars(short, heads).select(*key, "_found", F.explode("_head").alias("doc_id"))
    # Such a query has fewer than n matches, so all of them are in ``best``.
    fill = fill.join(best.select(*key, "doc_id"), [*key, "doc_id"], "left_anti")
    fill_order = Window.partitionBy(*key).orderBy("doc_id")
    fill = fill.withColumn("_i", F.row_number().over(fill_order)).where(F.col("_i") + F.col("_found") <= n)
    filled = fill.select(*key, "doc_id", F.lit(0.0).alias("score"), (F.col("_i") + F.col("_found")).alias("rank"))
    nothing = per_query.where(F.col("_found").isNull()).select(*key)
    nothing = nothing.withColumn("_shard", F.explode(F.sequence(F.lit(0), F.lit(FALLBACK_SHARDS - 1))))
    ranked_docs = corpus_rank(docs).withColumn("_shard", F.pmod(F.xxhash64("doc_id"), F.lit(FALLBACK_SHARDS)).cast("int"))
    everything = ranked_docs.join(nothing, "_shard").select(*key, "doc_id", F.lit(0.0).alias("score"), "rank")
    return best.select(*key, "doc_id", "score", "rank").unionByName(filled).unionByName(everything)


def corpus_rank(docs: DataFrame) -> DataFrame:
    """Position of each document in corpus order, from the offsets of id ranges."""
    ranged = docs.select("doc_id").withColumn("_r", F.floor(F.col("doc_id") / 65536))
    per = ranged.groupBy("_r").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_r").orderBy("doc_id")
    return ranged.withColumn("_i", F.row_number().over(inside)).join(offsets, "_r").select(
        "doc_id", (F.col("_i") + F.col("_off")).cast("int").alias("rank")
    )


def _history_text(turns: Column) -> Column:
    line = F.transform(
        turns,
        lambda t: F.concat(F.when(t["role"] == "user", "User: ").otherwise("Assistant: "), t["text"], F.lit("\n")),
    )
    return F.array_join(line, "")


def last_turns(conversations: DataFrame, n: int = 4) -> DataFrame:
    """The last ``n`` turns of each conversation as one text."""
    order = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    last = conversations.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= n)
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return last.groupBy("conv_id").agg(turns.alias("_t")).select(
        "conv_id", F.size("_t").alias("turns"), _history_text(F.col("_t")).alias("history")
    )


TURN_CHUNK = 4096


def turns_before(conversations: DataFrame, n: int = 4) -> DataFrame:
    """Every turn with the text of the ``n`` turns before it.

    Conversations are cut into chunks of turns; the tail of earlier chunks is carried over, so that one very long
    conversation is spread over many tasks.
    """
    rows = conversations.withColumn("_chunk", F.floor(F.col("turn") / TURN_CHUNK))
    turn = F.struct("turn", "role", "text")
    inside = Window.partitionBy("conv_id", "_chunk").orderBy("turn")
    near = rows.withColumn("_near", F.collect_list(turn).over(inside.rowsBetween(-n, -1)))
    latest = Window.partitionBy("conv_id", "_chunk").orderBy(F.desc("turn"))
    tails = rows.withColumn("_rn", F.row_number().over(latest)).where(F.col("_rn") <= n)
    tails = tails.groupBy("conv_id", "_chunk").agg(F.sort_array(F.collect_list(turn)).alias("_tail"))
    chunks = Window.partitionBy("conv_id").orderBy("_chunk").rowsBetween(-n, -1)
    carried = tails.select("conv_id", "_chunk", F.flatten(F.collect_list("_tail").over(chunks)).alias("_far"))
    both = near.join(carried, ["conv_id", "_chunk"]).withColumn("_all", F.concat("_far", "_near"))
    kept = F.slice("_all", F.greatest(F.size("_all") - n + 1, F.lit(1)), F.lit(n))
    return both.select("conv_id", "turn", "role", "text", _history_text(kept).alias("history"))


def _with_texts(hits: DataFrame, docs: DataFrame, chars: int) -> DataFrame:
    """Hits with source and cut text. Popular documents are hit by many queries: each text is fetched once and joined back."""
    ids = hits.select("doc_id").distinct()
    texts = docs.join(ids, "doc_id", "left_semi").select("doc_id", "source", F.substring("text", 1, chars).alias("_text"))
    return left_lookup(hits, materialize(texts, "hit_texts"), ["doc_id"], row_id=hits.columns[0])


def context_blocks(hits: DataFrame, docs: DataFrame, key: Sequence[str], chars: int = 2000) -> DataFrame:
    """Numbered source blocks of the retrieved documents per query."""
    key = list(key)
    joined = _with_texts(hits, docs, chars)
    block = F.concat(
        F.lit("\n[Source "), F.col("rank").cast("string"), F.lit(": "), F.col("source"), F.lit("]\n"), F.col("_text"), F.lit("\n")
    )
    blocks = F.sort_array(F.collect_list(F.struct("rank", block.alias("b"))))
    return joined.groupBy(*key).agg(F.array_join(F.transform(blocks, lambda b: b["b"]), "").alias("context"))


def prompt_context(docs: DataFrame, conversations: DataFrame, n: int = 4, index: Index | None = None) -> DataFrame:
    """Context blocks and recent history of every user turn."""
    key = ["conv_id", "turn"]
    queries = conversations.where(F.col("role") == "user").select(*key, "text")
    hits = materialize(retrieve(docs, queries, key, n, index).where(F.col("rank") <= n), "prompt_hits")  # read twice
    turns = turns_before(conversations).where(F.col("role") == "user").select(*key, F.col("text").alias("question"), "history")
    return turns.join(context_blocks(hits, docs, key), key)


def listing_block(price: str = "price", city: str = "city", score: str = "fraud_score", tier: str = "risk_tier") -> Column:
    """The listing in question and its prediction as lines of a prompt; what is missing reads N/A."""
    none = F.lit("N/A")
    return F.concat(
        F.lit("Listing in question\n- price: "),
        F.coalesce(F.concat(F.lit("$"), F.format_number(F.bround(price, 0), 0)), none),
        F.lit("\n- city: "),
        F.coalesce(city, none),
        F.lit("\n- fraud score: "),
        F.coalesce(F.format_string("%.4f", score), none),
        F.lit("\n- risk tier: "),
        F.coalesce(tier, none),
        F.lit("\n"),
    )


def prompt_text(context: str = "context", listing: str = "listing", history: str = "history", question: str = "question") -> Column:
    """One prompt: sources, the listing (may be null), the turns before, and the question."""
    return F.concat(
        F.lit("Sources:"),
        F.coalesce(context, F.lit("")),
        F.coalesce(F.concat(F.lit("\n"), F.col(listing)), F.lit("")),
        F.lit("\nEarlier turns:\n"),
        F.coalesce(history, F.lit("")),
        F.lit("\nQuestion: "),
        F.coalesce(question, F.lit("")),
        F.lit("\n"),
    )


def signal_lines(top3: str = "top3") -> Column:
    """One line per top signal of a prediction."""
    return F.array_join(
        F.transform(
            F.col(top3),
            lambda f: F.concat(
                F.lit("\n  - "),
                f["feature"],
                F.lit(" = "),
                F.format_string("%.3f", f["value"]),
                F.when(f["impact"] > 0, " → fraud signal").otherwise(" → normal signal"),
                F.format_string(" (impact: %+.4f)", f["impact"]),
            ),
        ),
        "",
    )


def explain_context(docs: DataFrame, predictions: DataFrame, n: int = 2) -> DataFrame:
    """Supporting text of each prediction (id, risk_tier, top3): documents for its tier, and its signal lines."""
    tiers = materialize(predictions.select("risk_tier").distinct(), "tiers")
    queries = tiers.withColumn(
        "text", F.concat(F.lit("threshold risk tier "), F.col("risk_tier"), F.lit(" price anomaly fraud signal"))
    )
    hits = retrieve(docs, queries, ["risk_tier"], n).where(F.col("rank") <= n)
    joined = _with_texts(hits, docs, 1500)
    texts = F.sort_array(F.collect_list(F.struct("rank", "_text")))
    per_tier = joined.groupBy("risk_tier").agg(
        F.substring(F.array_join(F.transform(texts, lambda t: t["_text"]), "\n"), 1, 1000).alias("context")
    )
    # One row per risk tier, of which there are three.
    return predictions.join(F.broadcast(per_tier), "risk_tier", "left").select(
        "id", "risk_tier", signal_lines().alias("signals"), "context"
    )

"""Benchmark decontamination over a positional inverted index.

``index`` stores (term, document, position) postings of the training text. For phrases a term is a word with its successor (a next-word
index; an item of one word has that word as its term), for proximity it is a word. Terms that no test item has cannot take part
in a match and get no postings. ``matches`` takes each test window (``n`` consecutive words of an item; a shorter item is one
window), finds its rarest term by corpus frequency and opens that term's postings: position minus offset gives the diagonals on which
the item can stand. The lists of the other terms, shifted by their offsets, are intersected on those diagonals only; an unbroken run
of a window's terms is an exact phrase match. ``near_matches`` asks only that enough different words of a window stand within a span
of positions; it opens the postings of so many of the rarest words of a window that no match can do without all of them.

Defined cases: a null or empty text has no words; an item without words has no window; a null item_id is listed as the empty text;
rows of documents that share an id but not a text are separate rows; repeated rows are each reported; repeated items count
once per item_id. Empty tables give empty or all-clean results. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingguard.llm.common import checked_broadcast, lower_ascii, row_key, unused
from listingguard.sources.stage import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Stands for the end of a document in the postings; a control character is no word.
END = "\x01"
END_TERM = -1


def split_words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def with_next(ws: Column) -> Column:
    """Each word with its successor; the last one alone."""
    return F.transform(ws, lambda w, i: F.concat_ws(" ", w, F.get(ws, i + 1)))


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, item, q (place), word (the term's text), n_terms and extra (words that a term covers beyond its first)."""
    one = F.size("ws") == 1
    shown = F.when(one, F.col("ws")).otherwise(F.slice(with_next(F.col("ws")), 1, F.greatest(F.size("ws") - 1, F.lit(1))))
    return (
        items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), split_words(F.col("text")).alias("ws"))
        .where(F.size("ws") > 0)
        .distinct()
        .select("item_id", F.xxhash64("item_id", "ws").alias("item"), F.when(one, 0).otherwise(1).alias("extra"), shown.alias("ts"))
        .select("item_id", "item", "extra", F.size("ts").alias("n_terms"), F.posexplode("ts").alias("q", "word"))
    )


def postings(docs: DataFrame, vocabulary: DataFrame, singles: bool) -> DataFrame:
    """term, doc_id, did, rid, pos for each term that ``vocabulary`` (word, term) has, and one end posting per row."""
    ends = vocabulary.sparkSession.createDataFrame([(END, END_TERM)], "word string, term long")
    listed = checked_broadcast(vocabulary.unionByName(ends), "vocabulary")
    ws = F.col("ws")
    split = docs.select("doc_id", *row_key(), split_words(F.col("text")).alias("ws"))

    def kept(terms: Column) -> DataFrame:
        placed = split.select("doc_id", "did", "rid", F.posexplode(terms).alias("pos", "word"))
        return placed.join(listed, "word").select("term", "doc_id", "did", "rid", "pos")

    stored = kept(F.array_append(with_next(ws), F.lit(END)))
    return stored.unionByName(kept(ws)) if singles else stored


def anchors(items: DataFrame, frequency: DataFrame, n: int) -> DataFrame:
    """item, q, term: for each window of each item its rarest term; windows with a term that no document has are left out."""
    known = items.join(frequency, "term", "left").withColumn("cf", F.coalesce("cf", F.lit(0)))
    starts = F.sequence(F.greatest(F.lit(0), F.col("q") - F.lit(n - 1)), F.least(F.col("q"), F.greatest(F.col("n_terms") - n, F.lit(0))))
    return (
        known.withColumn("start", F.explode(starts))
        .groupBy("item", "start")
        .agg(F.min(F.struct("cf", "q", "term")).alias("rarest"))
        .where(F.col("rarest.cf") > 0)
        .select("item", "rarest.q", "rarest.term")
        .distinct()
    )


def index(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stored postings, and the items' terms (item_id, item, extra, n_terms, q, term)."""
    placed = materialize(item_terms(items), "item_terms")
    vocabulary = materialize(placed.select("word").distinct().withColumn("term", F.monotonically_increasing_id()), "terms")
    singles = bool(placed.where("extra = 0").head(1))
    return (
        materialize(postings(docs, vocabulary, singles), "postings"),
        materialize(placed.join(vocabulary, "word").drop("word"), "item_places"),
    )


def matches(stored: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """did, rid, item_id, first, last: the word positions of every maximal run that holds a window of the item."""
    n = max(1, n - 1)  # terms of a window of n words
    frequency = stored.where(F.col("term") >= 0).groupBy("term").agg(F.count("*").alias("cf"))
    rare = checked_broadcast(anchors(items, frequency, n), "anchors")
    shifted = (
        stored.join(rare, "term").select("did", "rid", "item", (F.col("pos") - F.col("q")).alias("diagonal")).distinct()
    )
    candidates = materialize(shifted, "diagonals")
    wanted = candidates.join(
        checked_broadcast(items.select("item", "q", "term").distinct(), "item_diagonals"), "item"
    ).select("did", "rid", "term", (F.col("diagonal") + F.col("q")).alias("pos"), "item", "diagonal", "q")
    there = stored.join(candidates.select("did", "rid").distinct(), ["did", "rid"], "left_semi").select("did", "rid", "term", "pos")
    qs = F.array_sort(F.collect_set("q"))
    runs = (
        wanted.join(there, ["did", "rid", "term", "pos"], "left_semi")
        .groupBy("did", "rid", "item", "diagonal")
        .agg(qs.alias("qs"))
        .select("did", "rid", "item", "diagonal", F.explode(F.transform("qs", lambda q, i: F.struct((q - i).alias("run"), q.alias("q")))).alias("x"))
        .groupBy("did", "rid", "item", "diagonal", "x.run")
        .agg(F.min("x.q").alias("a"), F.max("x.q").alias("b"))
    )
    names = checked_broadcast(items.select("item", "item_id", "n_terms", "extra").distinct(), "item_names")
    return (
        runs.join(names, "item")
        .where(F.col("b") - F.col("a") + 1 >= F.least(F.lit(n), F.col("n_terms")))
        .select("did", "rid", "item_id", (F.col("diagonal") + F.col("a")).alias("first"), (F.col("diagonal") + F.col("b") + F.col("extra")).alias("last"))
    )


def windows(items: DataFrame, n: int, share: float) -> DataFrame:
    """item_id, window, words (its different words) and need (how many of them a near match has) for every window of every item."""
    ws = F.col("ws")
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.size(ws) - n, F.lit(0)))).alias("start")
    return (
        items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), split_words(F.col("text")).alias("ws"))
        .where(F.size(ws) > 0)
        .distinct()
        .select("item_id", "ws", starts)
        .select("item_id", F.array_sort(F.array_distinct(F.slice(ws, F.col("start") + 1, n))).alias("words"))
        .distinct()
        .select("item_id", F.xxhash64("item_id", "words").alias("window"), "words", F.ceil(F.round(F.size("words") * share, 6)).cast("int").alias("need"))
    )


def near_matches(docs: DataFrame, items: DataFrame, n: int = WINDOW, share: float = 0.8, slack: int = 4) -> DataFrame:
    """did, rid, item_id, first: documents in which ``share`` of an item window's different words or more stand, in any order, within
    ``n + slack`` consecutive words, of which the first that fits for an opened posting begins at word ``first``.

    Exact. Of d different words, of which ``need`` are asked for, every match has one of the d - need + 1 rarest: only the postings of these are
    stored and opened. Around each, the document's words decide.
    """
    span = n + slack
    asked = materialize(windows(items, n, share), "near_windows")
    split = docs.select(*row_key(), split_words(F.col("text")).alias("ws"))
    vocabulary = checked_broadcast(asked.select(F.explode("words").alias("word")).distinct(), "near_words")
    frequency = split.select(F.explode("ws").alias("word")).join(vocabulary, "word").groupBy("word").agg(F.count("*").alias("cf"))
    ranked = (
        asked.select("item_id", "window", "need", F.explode("words").alias("word"))
        .join(materialize(frequency, "near_frequency"), "word", "left")
        .groupBy("window")
        .agg(F.first("need").alias("need"), F.array_sort(F.collect_list(F.struct(F.coalesce("cf", F.lit(0)).alias("cf"), "word"))).alias("by"))
    )
    rarest = F.slice("by", 1, F.size("by") - F.col("need") + 1)
    opened = materialize(ranked.select("window", F.explode(rarest).alias("x")).where("x.cf > 0").select("window", F.col("x.word").alias("word")), "near_anchors")
    rare = checked_broadcast(opened.select("word").distinct(), "near_rare_words")
    stored = split.select("did", "rid", F.posexplode("ws").alias("pos", "word")).join(rare, "word")
    places = materialize(stored.groupBy("did", "rid").agg(F.collect_set(F.struct("pos", "word")).alias("places")), "near_postings")

    def around(p: Column) -> Column:
        """A posting with the words that a span over it can have, 2 * span - 1 at most."""
        low = F.greatest(F.lit(0), p["pos"] - (span - 1))
        words = F.slice("ws", low + 1, p["pos"] - low + span)
        return F.struct(p["word"].alias("word"), low.alias("low"), p["pos"].alias("pos"), words.alias("near"))

    shown = split.join(places, ["did", "rid"]).select("did", "rid", F.explode(F.transform("places", around)).alias("p")).select("did", "rid", "p.*")
    tests = opened.join(asked, "window").select("word", "item_id", "words", "need")

    def enough(part: Column) -> Column:
        return F.size(F.array_intersect(part, F.col("words"))) >= F.col("need")

    first = F.filter(F.sequence(F.lit(0), F.col("pos") - F.col("low")), lambda k: enough(F.slice("near", k + 1, F.lit(span))))
    return (
        shown.join(checked_broadcast(tests, "near_tests"), "word")
        .where(enough(F.col("near")))
        .select("did", "rid", "item_id", (F.col("low") + F.get(first, F.lit(0))).alias("first"))
        .where(F.col("first").isNotNull())
        .distinct()
    )


def report(docs: DataFrame, items: DataFrame, n: int = WINDOW, near: bool = False) -> DataFrame:
    """A row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and its did and rid.

    With ``near`` also n_near: items with a near match, those with a window in place included.
    """
    stored, placed = index(docs, items)
    found = materialize(matches(stored, placed, n), "matches")
    in_order = Window.partitionBy("did", "rid").orderBy("first", "last")
    reach = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("last") - F.greatest(F.col("first") - 1, F.coalesce(F.col("reach"), F.lit(-1))))
    hit = (
        found.select("did", "rid", "first", "last").distinct()
        .withColumn("reach", reach).groupBy("did", "rid").agg(F.sum(fresh).alias("n_hit"))
    )
    listed = found.groupBy("did", "rid").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    ends = stored.where(F.col("term") == END_TERM).select("doc_id", "did", "rid", F.col("pos").cast("long").alias("n_words"))
    joined = F.array_join(F.coalesce("ids", F.array().cast("array<string>")), ",")
    found_all = ends.join(hit.join(listed, ["did", "rid"]), ["did", "rid"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.greatest(F.size("ids"), F.lit(0)).cast("long").alias("n_items"), F.sha2(joined, 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), "did", "rid",
    )
    if not near:
        return found_all
    close = near_matches(docs, items, n).select("did", "rid", "item_id").distinct().groupBy("did", "rid").agg(F.count("*").alias("n_near"))
    return found_all.join(close, ["did", "rid"], "left").withColumn("n_near", F.coalesce("n_near", F.lit(0)))


def clean(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without a window of any item."""
    b_did, b_rid = unused(docs, "did", "rid")
    bad = report(docs, items, n).where("contaminated").select(F.col("did").alias(b_did), F.col("rid").alias(b_rid)).distinct()
    did, rid = row_key()
    return docs.join(bad, (did == F.col(b_did)) & (rid == F.col(b_rid)), "left_anti")


SQL = f"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM benchmark),
iwin AS (
  SELECT DISTINCT item_id, least({WINDOW}, len(ws)) AS n, array_to_string(ws[s:s + least({WINDOW}, len(ws)) - 1], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, 2 + greatest(len(ws) - {WINDOW}, 0))) AS s FROM iw WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM iwin),
dwin AS (
  SELECT doc_id, s, n, array_to_string(ws[s:s + n - 1], ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, 2 + len(ws) - n)) AS s FROM dw, sizes WHERE len(ws) >= n)),
found AS (SELECT doc_id, s, d.n, item_id FROM dwin d JOIN iwin i ON d.n = i.n AND d.w = i.w),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM found)) GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit ON dw.doc_id = hit.doc_id LEFT JOIN ids ON dw.doc_id = ids.doc_id
"""

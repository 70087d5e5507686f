"""Token counts for every context limit from an exact length histogram.

Each text is encoded once with a byte-level BPE whose rank file is a parameter; only its length is kept. Documents are
aggregated by length, and sums over the histogram answer, for any context limit, how many documents and tokens fit, what is left after
truncation, and which length a share of documents does not exceed. The histogram has at most one row per distinct length, and its
sums are taken in two levels (blocks of lengths, then within blocks), so that no task holds it whole.

Defined cases: null and empty texts have length 0; special-token strings in a text are ordinary text; repeated rows count each. An
empty table gives an empty histogram. Extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listingguard.sources.stage import materialize

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed: the pattern that splits text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK = 1024

_encoders: dict[bytes, tiktoken.Encoding] = {}


def encoder(ranks: bytes) -> tiktoken.Encoding:
    """The encoding of a rank file's content, built once per Python worker."""
    if ranks not in _encoders:
        merges = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        _encoders[ranks] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
    return _encoders[ranks]


def token_lengths(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id and n_tokens of every row. The rank file is read on the driver and sent along; its size does not grow with the data."""
    with open(ranks, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value).encode_ordinary
        for batch in batches:
            sizes = pa.array([len(encode(x.as_py() or "")) for x in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes], ["doc_id", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """n_tokens and docs: one row per distinct length."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("docs"))



def context_table(hist: DataFrame) -> DataFrame:
    """A row per distinct length, read as a context limit.

    context, docs (of just that length), tokens; docs_up_to and tokens_up_to (texts that fit whole); docs_over and tokens_over (suffix
    sums: texts that do not fit); truncated_tokens (tokens left when every text is cut at the limit); share_of_docs and share_of_tokens
    (what fits whole, and what truncation leaves). Between two rows docs_over stays and truncated_tokens grows by docs_over per token.
    """
    base = hist.withColumn("tokens", F.col("n_tokens") * F.col("docs")).withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    blocks = base.groupBy("block").agg(F.sum("docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    offsets = blocks.select(
        "block",
        *[F.coalesce(F.sum(f"b_{c}").over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("docs", "tokens")],
        *[F.sum(f"b_{c}").over(every).alias(f"all_{c}") for c in ("docs", "tokens")],
    )
    inside = Window.partitionBy("block").orderBy("n_tokens")
    summed = base.withColumns({f"{c}_in": F.sum(c).over(inside) for c in ("docs", "tokens")}).join(offsets, "block")
    up = {f"{c}_up_to": F.col(f"{c}_before") + F.col(f"{c}_in") for c in ("docs", "tokens")}
    over = {f"{c}_over": F.col(f"all_{c}") - F.col(f"{c}_up_to") for c in ("docs", "tokens")}
    cut = F.col("tokens_up_to") + F.col("n_tokens") * F.col("docs_over")
    return summed.withColumns(up).withColumns(over).withColumn("truncated_tokens", cut).select(
        F.col("n_tokens").alias("context"), "docs", "tokens", "docs_up_to", "tokens_up_to", "docs_over", "tokens_over", "truncated_tokens",
        (F.col("docs_up_to") / F.col("all_docs")).alias("share_of_docs"),
        F.try_divide("truncated_tokens", "all_tokens").alias("share_of_tokens"),
    )


def at_limit(table: DataFrame, limit: int) -> DataFrame:
    """docs_up_to, docs_over and truncated_tokens for one limit, which need not be a length in the table."""
    fits = F.col("context") <= limit
    docs = F.sum(F.when(fits, F.col("docs")).otherwise(0))
    over = F.sum(F.when(fits, 0).otherwise(F.col("docs")))
    left = F.sum(F.when(fits, F.col("tokens")).otherwise(F.col("docs") * limit))
    return table.agg(*[F.coalesce(c, F.lit(0)).alias(n) for c, n in ((docs, "docs_up_to"), (over, "docs_over"), (left, "truncated_tokens"))])


def quantile(table: DataFrame, share: float) -> DataFrame:
    """The least length that ``share`` of the documents does not exceed."""
    return table.where(F.col("share_of_docs") >= share).agg(F.min("context").alias("length"))


def report(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    return context_table(materialize(histogram(token_lengths(docs, ranks)), "length_histogram"))

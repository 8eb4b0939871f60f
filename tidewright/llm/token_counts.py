"""Token counts: the exact histogram of encoded lengths, with sums from the long end.

Each text is encoded whole by a public tokenizer and only its length is kept. The
aggregate by length is all that later questions need: with documents and tokens summed
from the longest down, every context limit has its number of cut documents, its truncated
total and its quantile in one row.

Sums over lengths go in two steps (within ranges of RANGE lengths, then over the ranges),
so their tasks are bounded by lengths, not documents. A null text has length 0. Special
tokens in a text count as ordinary text. Repeated rows count each. An empty table gives
an empty histogram.
"""

from __future__ import annotations

import base64
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import kept_table, per_batch

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
RANGE = 1024
#: Splits text before byte pairs merge; a fixed value that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def encoder(vocabulary: str):
    import tiktoken
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded_lengths(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens of every row."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = encoder(vocabulary).encode_ordinary
        lengths = [len(encode(t)) if t else 0 for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lengths, pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(per_batch(work), f"doc_id {key}, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """A row per length that occurs: n_tokens, n_docs, docs_at_least, tokens_at_least,
    docs_longer, truncated_total (tokens left if this length is the context limit) and
    quantile (share of documents no longer than it)."""
    # Two branches read the counts, so they are written once; else Spark would encode every text twice.
    counts = kept_table(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "length-counts").withColumns(
        {"range": F.floor(F.col("n_tokens") / RANGE), "tokens": F.col("n_tokens") * F.col("n_docs")})
    ranges = counts.groupBy("range").agg(F.sum("n_docs").alias("r_docs"), F.sum("tokens").alias("r_tokens"))
    down = Window.orderBy(F.col("range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    up = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("bigint")
    ranges = ranges.select(F.col("range").alias("of_range"), F.coalesce(F.sum("r_docs").over(down), zero).alias("docs_above"), F.coalesce(F.sum("r_tokens").over(down), zero).alias("tokens_above"),
                           F.sum("r_docs").over(up).alias("all_docs"), F.sum("r_tokens").over(up).alias("all_tokens"))
    within = Window.partitionBy("range").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = counts.withColumns({"docs_in": F.sum("n_docs").over(within), "tokens_in": F.sum("tokens").over(within)}).join(ranges, F.col("range") == F.col("of_range"))
    summed = summed.withColumns({"docs_at_least": F.col("docs_in") + F.col("docs_above"), "tokens_at_least": F.col("tokens_in") + F.col("tokens_above")})
    return summed.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least", (F.col("docs_at_least") - F.col("n_docs")).alias("docs_longer"),
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_total"),
        ((F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("all_docs")).alias("quantile"))


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """For any context limits: limit, docs_longer, truncated_total. A limit falls between two rows of the histogram."""
    each = F.explode(F.array(*[F.lit(int(x)).cast("bigint") for x in limits])).alias("limit")
    rows = histogram.select("n_tokens", "n_docs", each)
    return rows.groupBy("limit").agg(
        F.sum(F.when(F.col("n_tokens") > F.col("limit"), F.col("n_docs")).otherwise(0)).alias("docs_longer"),
        F.sum(F.least("n_tokens", "limit") * F.col("n_docs")).alias("truncated_total"))


def length_at(histogram: DataFrame, quantile: float) -> DataFrame:
    """The least length that holds the quantile, in one row: n_tokens."""
    return histogram.where(F.col("quantile") >= quantile).agg(F.min("n_tokens").alias("n_tokens"))

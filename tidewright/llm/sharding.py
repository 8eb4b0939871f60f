"""Extendible hashing: documents to shards named by prefixes of their hash bits.

The directory starts with one shard, the empty prefix. A shard above the byte limit is
split on its next hash bit, all others stay, until each fits. Bytes are summed per prefix
of STEP bits at a time, so one aggregate settles STEP splits of all shards at once; only
shards still too large after that take part in the next aggregate. The hash is the first
60 bits of the MD5 of the id as text.

A shard of a single document, or of rows with one id only, can't be split by its hash
and stays as it is, whatever its bytes. Nulls: a null id hashes like an empty text; a null
text has 0 bytes. Repeated rows share a shard. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import kept_table

BITS, STEP = 60, 12
LIMIT_BYTES = 8 << 20


def hash_bits(column: str):
    """The first 60 bits of MD5 as a number."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(column).cast("string"), F.lit(""))), 1, BITS // 4), 16, 10).cast("bigint")


def prefix(hash_column, depth: int):
    return F.shiftright(hash_column, BITS - depth)


def prefix_text(number, depth):
    """``depth`` binary digits of ``number``; the empty text at depth 0."""
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(number), depth, "0"))


def split_level(rows: DataFrame, depth: int, limit: int) -> DataFrame:
    """(slot, shard_depth, shard, shard_bytes, open) for each prefix of ``depth`` + STEP bits in ``rows``.

    ``rows`` (hash, bytes) lie in shards of ``depth`` bits that are too large (or all in the
    first one). A slot whose shard is still too large at the last bit is ``open``.
    """
    last = depth + STEP
    slots = rows.groupBy(prefix(F.col("hash"), last).alias("slot")).agg(
        F.sum("bytes").alias("bytes"), F.min("hash").alias("low"), F.max("hash").alias("high"))
    sums = slots.select("slot", "bytes", "low", "high", F.explode(F.sequence(F.lit(depth), F.lit(last))).alias("d")).groupBy(
        "d", F.expr(f"shiftright(slot, {last} - d)").alias("p")).agg(F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high"))
    # One hash value can't be split, so it counts as fitting.
    sums = sums.withColumn("fits", (F.col("bytes") <= limit) | (F.col("low") == F.col("high")))
    parents = sums.where(~F.col("fits")).select((F.col("d") + 1).alias("parent_d"), F.col("p").alias("parent_p"))
    shards = sums.join(parents, (F.col("d") == F.col("parent_d")) & (F.shiftright(F.col("p"), 1) == F.col("parent_p")), "left").where(
        (F.col("parent_d").isNotNull() | (F.col("d") == depth)) & (F.col("fits") | (F.col("d") == last)))
    # Each shard fills all slots below it, as in a directory of pointers.
    below = F.explode(F.expr(f"sequence(shiftleft(p, {last} - d), shiftleft(p + 1, {last} - d) - 1)"))
    return shards.select(below.alias("slot"), F.col("d").alias("shard_depth"), F.col("p").alias("shard"), F.col("bytes").alias("shard_bytes"), (~F.col("fits")).alias("open"))


def extendible_shards(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """doc_id, n_bytes, shard (binary prefix), depth, shard_bytes for every row."""
    rows = kept_table(docs.select("doc_id", hash_bits("doc_id").alias("hash"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("bytes")), "shard-bytes")
    done, depth = [], 0
    pending = rows
    while depth < BITS:
        level = kept_table(split_level(pending.select("hash", "bytes"), depth, limit), "shard-directory")
        marked = pending.withColumn("__slot", prefix(F.col("hash"), depth + STEP)).join(level.withColumnRenamed("slot", "__level_slot"), F.col("__slot") == F.col("__level_slot"))
        depth += STEP
        more = depth < BITS and not level.where("open").isEmpty()
        closed = marked.where(~F.col("open")) if more else marked
        done.append(closed.select("doc_id", F.col("bytes").alias("n_bytes"), prefix_text(F.col("shard"), F.col("shard_depth")).alias("shard"), F.col("shard_depth").cast("int").alias("depth"), "shard_bytes"))
        if not more:
            break
        pending = marked.where("open").select("doc_id", "hash", "bytes")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def extendible_shards_sql(limit: int = LIMIT_BYTES) -> str:
    """DuckDB twin over ``documents``: sums at every depth, the shallowest prefix that fits."""
    return f"""
WITH h AS (
  SELECT row_number() OVER () AS row, doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS hash,
         coalesce(strlen(text), 0)::BIGINT AS bytes
  FROM documents
), sums AS (
  SELECT d, hash >> (60 - d) AS p, CAST(sum(bytes) AS BIGINT) AS bytes,
         sum(bytes) <= {limit} OR min(hash) = max(hash) AS fits
  FROM h, (SELECT unnest(range(0, 61))::INTEGER AS d) GROUP BY d, hash >> (60 - d)
), first AS (
  SELECT h.doc_id, h.hash, h.bytes, min(d) AS depth
  FROM h JOIN sums ON sums.p = h.hash >> (60 - d) WHERE fits GROUP BY h.doc_id, h.hash, h.bytes, h.row
)
SELECT doc_id, first.bytes AS n_bytes,
       CASE WHEN depth = 0 THEN '' ELSE lpad(bin(p), depth, '0') END AS shard, depth, sums.bytes AS shard_bytes
FROM first JOIN sums ON sums.d = depth AND sums.p = first.hash >> (60 - depth)
"""

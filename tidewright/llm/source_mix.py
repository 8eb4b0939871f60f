"""Mixing sources to target weights from fixed-length blocks.

Each source's words, documents on end, are packed into blocks of ``block_words``. An
output shard has a fixed number of slots and draws a multinomial number of slots per
source. What a source draws beyond its target (or short of it) over all shards is dealt to
the sources that lack it, so that totals are the targets to a block. The j-th slot of a
source takes the block to which a keyed pseudorandom permutation of the source's block
numbers maps j; each further round over the blocks has its own permutation. Slots then
join blocks by source and block number.

Packing needs a running total per source. Sources are cut into bins of about ``bin_words``
by a hash of the document, totals run within bins and then over bins, so no task orders a
whole source. Draws, permutations and bins are keyed hashes: reruns agree. The driver gets
one row per source (a mix gives each a weight).

Nulls: a null source is a source of its own, last in order; a null text has size 0 and
is not taken. Repeated rows are documents of their own, packed next to each other, and
share out what their id takes. An empty table, or one without words, takes nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.arrays import mix
from tidewright.llm.common import kept_table, per_batch

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
BLOCK_WORDS, SHARD_SLOTS, BIN_WORDS = 64, 8192, 1 << 19
WORD = r"[^\x20\x09-\x0D]+"


def word_count(column: str):
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("bigint")


def water_filled(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Targets in proportion to the weights; none above ``most`` times its size, the excess reshared."""
    targets = [0.0] * len(sizes)
    free, left = [i for i in range(len(sizes)) if sizes[i] > 0], share * sum(sizes)
    while free:
        level = left / sum(weights[i] for i in free)
        full = [i for i in free if level * weights[i] >= most * sizes[i]]
        if not full:
            for i in free:
                targets[i] = level * weights[i]
            break
        for i in full:
            targets[i] = most * sizes[i]
            left -= targets[i]
        free = [i for i in free if i not in set(full)]
    return targets


def permuted(j: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Images of j (0 <= j < n) under a permutation of range(n) given by key; all arrays alike.

    A Feistel network over the least even number of bits that holds n; values outside
    the range walk on until they fall inside.
    """
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = j.astype(np.uint64).copy(), np.arange(len(j))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo].astype(np.uint64)
        left, right = out[todo] >> h, out[todo] & m
        for turn in range(4):
            left, right = right, left ^ (mix(right + mix(k + np.uint64(turn))) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


class Plan:
    """Targets in slots, and the shards' draws; small arrays over the sources."""

    def __init__(self, sizes: list[int], targets: list[float], block: int, slots: int, seed: int):
        self.block, self.slots, self.seed = block, slots, seed
        self.blocks = np.array([-(-s // block) for s in sizes], np.int64)
        self.wanted = np.minimum(np.round(np.array(targets) / block).astype(np.int64), 2 * self.blocks)
        self.total = int(self.wanted.sum())
        self.shards = -(-self.total // slots)

    def draw(self, shard: int) -> np.ndarray:
        n = min(self.slots, self.total - shard * self.slots)
        return np.random.default_rng([self.seed, shard]).multinomial(n, self.wanted / self.total)

    def settle(self, source: np.ndarray, j: np.ndarray, drawn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots beyond a source's target go, in order, to the sources drawn too seldom."""
        beyond, lacking = np.maximum(drawn - self.wanted, 0), np.maximum(self.wanted - drawn, 0)
        first = np.cumsum(lacking) - lacking
        over = j >= self.wanted[source]
        rank = (np.cumsum(beyond) - beyond)[source[over]] + j[over] - self.wanted[source[over]]
        to = np.searchsorted(np.cumsum(lacking), rank, "right")
        source, j = source.copy(), j.copy()
        source[over], j[over] = to, drawn[to] + rank - first[to]
        return source, j

    def block_of(self, source: np.ndarray, j: np.ndarray) -> np.ndarray:
        n = self.blocks[source]
        key = mix(mix(source.astype(np.uint64) + np.uint64(self.seed)) + (j // n).astype(np.uint64))
        return permuted(j % n, n, key)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, and the bin-wise place of each document among its source's words."""
    return kept_table(docs.select("doc_id", "source", word_count("text").alias("size")), "mix-sizes")


def source_targets(sizes: DataFrame) -> list[tuple]:
    """(source, size, target), sources by code point and null last."""
    rows = [(r["source"], r["size"]) for r in sizes.groupBy("source").agg(F.sum("size").alias("size")).collect()]
    rows.sort(key=lambda r: (r[0] is None, r[0] or ""))
    targets = water_filled([n for _, n in rows], [WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))])
    return [(s, n, t) for (s, n), t in zip(rows, targets, strict=True)]


def packed_blocks(sizes: DataFrame, sources: DataFrame, block: int, bin_words: int = BIN_WORDS) -> DataFrame:
    """(src, block, doc_id, words): the words of each document in each block that it reaches into."""
    rows = sizes.where("size > 0").join(sources, F.col("source").eqNullSafe(F.col("s_source"))).select(
        "src", "doc_id", "size", F.pmod(F.xxhash64("doc_id", F.lit("bin")), F.ceil(F.col("source_size") / bin_words)).alias("bin"))
    bins = rows.groupBy("src", "bin").agg(F.sum("size").alias("bin_size"))
    over = Window.partitionBy("src").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(F.col("src").alias("b_src"), F.col("bin").alias("b_bin"), F.coalesce(F.sum("bin_size").over(over), F.lit(0)).alias("bin_start"))
    within = Window.partitionBy("src", "bin").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("upto", F.sum("size").over(within)).join(bins, (F.col("src") == F.col("b_src")) & (F.col("bin") == F.col("b_bin"))).select(
        "src", "doc_id", (F.col("bin_start") + F.col("upto") - F.col("size")).alias("a"), (F.col("bin_start") + F.col("upto")).alias("z"))
    pieces = placed.select("src", "doc_id", "a", "z", F.explode(F.sequence(F.floor(F.col("a") / block), F.floor((F.col("z") - 1) / block))).alias("block"))
    return pieces.select("src", "block", "doc_id", (F.least("z", (F.col("block") + 1) * block) - F.greatest("a", F.col("block") * block)).alias("words"))


def mix_plan(spark, plan: Plan) -> DataFrame:
    """(shard, slot, src, block): what each slot of each output shard takes."""
    shards = spark.range(plan.shards).withColumnRenamed("id", "shard")

    def cells(batch: pa.RecordBatch) -> pa.RecordBatch:
        numbers = batch.column(0).to_numpy()
        counts = np.stack([plan.draw(int(s)) for s in numbers])
        at, src = np.nonzero(counts)
        return pa.RecordBatch.from_arrays([pa.array(numbers[at]), pa.array(src), pa.array(counts[at, src])], names=["shard", "src", "n"])

    if not plan.total:
        return spark.createDataFrame([], "shard long, slot long, src long, block long")
    drawn = kept_table(shards.mapInArrow(per_batch(cells), "shard long, src long, n long"), "mix-draws")
    totals = np.zeros(len(plan.blocks), np.int64)
    for row in drawn.groupBy("src").agg(F.sum("n").alias("n")).collect():  # a row per source
        totals[row["src"]] = row["n"]
    before = Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    runs = drawn.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))

    def slots(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # a run is part of one shard, at most its slots
                shard, src, n, first = (batch.column(k)[i].as_py() for k in range(4))
                source, j = plan.settle(np.full(n, src, np.int64), np.arange(first, first + n, dtype=np.int64), totals)
                slot = np.arange(n, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, shard)), pa.array(slot), pa.array(source), pa.array(plan.block_of(source, j))], names=["shard", "slot", "src", "block"])

    return runs.select("shard", "src", "n", "first").mapInArrow(slots, "shard long, slot long, src long, block long")


def mixed_sources(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, bin_words: int = BIN_WORDS, seed: int = 7) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row."""
    spark = docs.sparkSession
    sizes = sized(docs)
    rows = source_targets(sizes)
    plan = Plan([n for _, n, _ in rows], [t for _, _, t in rows], block_words, shard_slots, seed)
    sources = spark.createDataFrame([(i, s, n, float(t)) for i, (s, n, t) in enumerate(rows)], "src long, s_source string, source_size long, target double")
    pieces = packed_blocks(sizes, sources, block_words, bin_words)
    # Spark takes the slots to be as few as the draws that they come from, so it must be told not to broadcast them.
    taken_blocks = mix_plan(spark, plan).groupBy("src", "block").agg(F.count("*").alias("times")).withColumnsRenamed({"src": "t_src", "block": "t_block"}).hint("merge")
    taken = pieces.join(taken_blocks, (F.col("src") == F.col("t_src")) & (F.col("block") == F.col("t_block"))).groupBy("src", "doc_id").agg(
        F.sum(F.col("words") * F.col("times")).alias("id_taken")).withColumnsRenamed({"src": "k_src", "doc_id": "k_id"})
    # Rows that repeat an id within a source share what the id takes by their sizes.
    same_id = sizes.groupBy("doc_id", "source").agg(F.sum("size").alias("id_size"), F.count("*").alias("id_rows")).withColumnsRenamed({"doc_id": "i_id", "source": "i_source"})
    out = sizes.join(sources, F.col("source").eqNullSafe(F.col("s_source"))).join(taken, (F.col("src") == F.col("k_src")) & F.col("doc_id").eqNullSafe(F.col("k_id")), "left").join(
        same_id, F.col("doc_id").eqNullSafe(F.col("i_id")) & F.col("source").eqNullSafe(F.col("i_source")))
    share = F.when(F.col("id_rows") == 1, F.col("id_taken")).otherwise(F.floor(F.col("id_taken") * F.col("size") / F.greatest("id_size", F.lit(1))))
    return out.select("doc_id", "size", "source_size", "target", F.coalesce(share, F.lit(0)).cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` as the mix takes them: each row 0, 1 or 2 times, on average as often as its words are taken.

    A row whose words are taken t times its size comes floor(t) times and once more with
    the chance of the rest, decided by a hash of its id. Rows without words don't come.
    """
    mixed = mixed_sources(docs, **settings).groupBy("doc_id").agg(F.sum("taken").alias("__taken"), F.sum("size").alias("__size")).where("__taken > 0").withColumnRenamed("doc_id", "__id")
    chance = F.pmod(F.xxhash64("__id", F.lit("copy")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    times = mixed.select("__id", F.floor(F.col("__taken") / F.col("__size") + chance).cast("int").alias("__times")).where("__times > 0")
    copies = docs.join(times, docs["doc_id"].eqNullSafe(F.col("__id"))).withColumn("__copy", F.explode(F.sequence(F.lit(1), "__times")))
    return copies.select(*[docs[c] for c in docs.columns])

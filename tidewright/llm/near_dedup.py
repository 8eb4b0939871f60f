"""Near-duplicates: DartMinHash signatures, banded joining, exact check, components.

A document is the multiset of its shingles of five words; an element's weight is its
number of occurrences, and similarity is the weighted Jaccard index. Darts fall on each unit
of an element's weight as a Poisson process over ranks, thrown by hash, so that the same
unit has the same darts in every document. A dart also carries a coordinate; each of the
BANDS x ROWS coordinates keeps the earliest dart that hits the document. Only ranks below
a bound that suits the document's weight are thrown, and the bound doubles for documents
with a coordinate still empty. Two documents agree in a coordinate with the probability of
their similarity: a pair at 0.8 meets in a band with more than 0.9999.

Texts with the same words are one class from the start (an aggregate, so a group of copies
of any size costs nothing later). Their representatives meet in buckets of equal bands. A
bucket of up to SMALL members gives its pairs. In larger ones each member is first paired
with the member in the middle of the group (the one that shares most buckets) and, with the
members dealt into cells of a few by a hash that differs from band to band, with its cell;
this joins most of a dense group with few pairs. Every pair is checked on the whole texts,
and components over pairs at or above the threshold are found by pointing ids at their least
neighbours and contracting the links. Large buckets that still hold members of several
components are then compared whole: their members are dealt to blocks, and each two blocks
meet in a group of their own, which counts the common shingles of all its pairs. Only blocks
that lie in one and the same component aren't compared, as their links could change nothing.
So every two texts that share a band are compared or in one class already.

A text of fewer than five words has one shingle of all of them. A null text or one without
words is like no other and is a class of its own. Class ids are the least doc_id of the
class, null ids last; a class of null ids only has none, and is named by ``class_key``, the least
hash of its words. Rows are told apart by id and text, so null ids and two texts under one id
are compared like all others. Repeated rows are copies of each other. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm import arrays as A
from tidewright.llm.common import ROW_KEY, kept_table, per_batch, rows_named, with_row_key

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 6
COORDINATES = BANDS * ROWS
SMALL = 24
#: Most members and about the most bytes of text of a block of a large bucket.
BLOCK, BLOCK_BYTES = 256, 1 << 21
#: Darts per document in the first throw: enough for all coordinates of most documents.
DARTS = COORDINATES * (np.log(COORDINATES) + 2.0)
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Darts in a square by 12 bits of hash: quantiles of the Poisson distribution with mean 1.
_DARTS_PER_SQUARE = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]), (np.arange(4096) + 0.5) / 4096)


def weighted_shingles(part: np.ndarray, bounds: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each shingle occurrence, its occurrence number in the text, and the text.

    Sorted by text and hash. The n-th occurrence is the n-th unit of the element's weight.
    """
    starts, ends, of = A.word_spans(part, bounds)
    words = A.span_hashes(part, starts, ends)
    text_of = A.owners(of)
    count = np.diff(of)
    full = A.shingle_hashes(words, size)
    at = np.flatnonzero(text_of[size - 1:] == text_of[:len(full)]) if len(full) else np.zeros(0, int)
    hashes, owner = full[at], text_of[at]
    for n in range(1, size):  # short texts: one shingle of all words
        short = np.flatnonzero(count == n)
        if len(short):
            hashes = np.append(hashes, A.shingle_hashes(words, n)[of[short]] + np.uint64(n))
            owner = np.append(owner, short)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(hashes)), 0))
    return hashes, np.arange(len(hashes)) - first, owner


def dart_signatures(units: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The earliest dart of each coordinate, texts by COORDINATES; ``owner`` is sorted.

    ``units`` are hashes of weight units. The plane of a unit is cut into squares of rank 1,
    each with its own hashed number of darts, so a text throws just the squares it needs.
    A value holds the dart's rank above bits of its hash: the least value is the earliest.
    """
    signature = np.full((n, COORDINATES), np.iinfo(np.uint64).max, np.uint64)
    flat = signature.reshape(-1)
    weight = np.bincount(owner, minlength=n)
    squares = np.where(weight > 0, np.ceil(DARTS / np.maximum(weight, 1)), 0).astype(np.int64)
    begun = np.zeros(n, np.int64)
    while squares.any():
        each = squares[owner]
        unit = np.repeat(np.arange(len(units)), each)
        square = np.arange(len(unit)) - np.repeat(np.cumsum(each) - each, each) + begun[owner[unit]]
        seed = A.mix(units[unit] + square.astype(np.uint64) * _STEP)
        darts = _DARTS_PER_SQUARE[(seed >> np.uint64(52)).astype(np.int64)]
        of = np.repeat(np.arange(len(unit)), darts)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(darts) - darts, darts)
        dart = A.mix(seed[of] + nth.astype(np.uint64))
        rank = (square[of] + (dart >> np.uint64(40)).astype(np.float64) * 2.0 ** -24).astype(np.float32)
        value = (rank.view(np.uint32).astype(np.uint64) << np.uint64(32)) | ((dart >> np.uint64(8)) & np.uint64(0xFFFFFFFF))
        coordinate = ((dart & np.uint64(0xFFFFFFFF)) * np.uint64(COORDINATES)) >> np.uint64(32)
        np.minimum.at(flat, owner[unit[of]] * COORDINATES + coordinate.astype(np.int64), value)
        # Texts with an empty coordinate throw as many squares again.
        begun += squares
        empty = (signature == np.iinfo(np.uint64).max).any(axis=1) & (weight > 0)
        squares = np.where(empty, begun, 0)
    return signature


def banded(signature: np.ndarray) -> np.ndarray:
    """One hash per text and band."""
    rows = signature.reshape(len(signature), BANDS, ROWS)
    out = np.zeros((len(signature), BANDS), np.uint64)
    for r in range(ROWS):
        out = A.mix(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, r])
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, ROW_KEY, words_a, words_b (128 bits over the words; null without words), bands."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = A.text_bytes(batch.column("text"))
        n = len(offsets) - 1
        whole, bands, has = np.zeros((n, 2), np.uint64), np.zeros((n, BANDS), np.uint64), np.zeros(n, bool)
        for i, j, part, bounds in A.chunks(data, offsets, 1 << 19):
            starts, ends, of = A.word_spans(part, bounds)
            words = A.span_hashes(part, starts, ends)
            place = (np.arange(len(words)) - np.repeat(of[:-1], np.diff(of))).astype(np.uint64)
            for k, salt in enumerate((3, 5)):
                terms = np.append(np.cumsum(A.mix(words + A.mix(place * np.uint64(2) + np.uint64(salt)))), np.uint64(0))
                total = np.concatenate([np.zeros(1, np.uint64), terms[:-1]])
                whole[i:j, k] = A.mix(total[of[1:]] - total[of[:-1]])
            has[i:j] = np.diff(of) > 0
            hashes, nth, owner = weighted_shingles(part, bounds)
            units = A.mix(hashes + A.mix(nth.astype(np.uint64) + np.uint64(11)))
            if len(owner):
                bands[i:j] = banded(dart_signatures(units, owner, j - i))
        flat = pa.array(bands.reshape(-1).view(np.int64))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), flat)
        columns = [batch.column(c) for c in ("doc_id", *ROW_KEY)] + [pa.array(whole[:, k].view(np.int64), mask=~has) for k in (0, 1)] + [lists]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", *ROW_KEY, "words_a", "words_b", "bands"])

    keys = ", ".join(f"{c} long" for c in ROW_KEY)
    return with_row_key(docs.select("doc_id", "text")).mapInArrow(per_batch(work), f"doc_id {key}, {keys}, words_a long, words_b long, bands array<long>")


def shared_buckets(bands: DataFrame) -> DataFrame:
    """(id, band, hash, members) of buckets with two members or more, from (id, bands)."""
    rows = bands.select("id", F.posexplode("bands").alias("band", "hash"))
    sizes = rows.groupBy("band", "hash").agg(F.count("*").alias("members")).where("members > 1").withColumnsRenamed({"band": "s_band", "hash": "s_hash"})
    return kept_table(rows.join(sizes, (F.col("band") == F.col("s_band")) & (F.col("hash") == F.col("s_hash"))).select("id", "band", "hash", "members"), "buckets")


def candidate_pairs(shared: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b: all of small buckets, cells and stars of large ones."""
    small = shared.where(F.col("members") <= SMALL).withColumn("cell", F.lit(0).cast("bigint"))
    large = shared.where(F.col("members") > SMALL)
    cells = large.withColumn("cell", F.pmod(F.xxhash64("id", "band"), F.ceil(F.col("members") * 6 / SMALL)))
    groups = small.unionByName(cells).groupBy("band", "hash", "cell").agg(F.sort_array(F.collect_list("id")).alias("ids")).where(F.size("ids") > 1)
    inner = groups.select("ids", F.posexplode("ids").alias("k", "a")).select("a", F.explode(F.expr("slice(ids, k + 2, size(ids))")).alias("b"))

    # The middle: members of most company over all their large buckets, least id first.
    company = large.groupBy("id").agg(F.sum("members").alias("company"))
    known = large.join(company.withColumnRenamed("id", "c_id"), F.col("id") == F.col("c_id"))
    first = known.groupBy("band", "hash").agg(F.max(F.struct("company", (-F.col("id")).alias("minus"))).alias("top")).select(
        F.col("band").alias("m_band"), F.col("hash").alias("m_hash"), (-F.col("top.minus")).alias("middle"))
    to_middle = large.join(first, (F.col("band") == F.col("m_band")) & (F.col("hash") == F.col("m_hash"))).where("id <> middle").select(
        F.least("id", "middle").alias("a"), F.greatest("id", "middle").alias("b"))
    return inner.unionByName(to_middle).distinct()


def similarity(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Weighted Jaccard index of each pair of texts."""
    out = np.zeros(len(a))
    left, right = A.text_bytes(a), A.text_bytes(b)
    sums = left[1] + right[1]
    i = 0
    while i < len(a):
        j = max(i + 1, int(np.searchsorted(sums, sums[i] + A.CHUNK_BYTES, "right")) - 1)
        sides = []
        for data, offsets in (left, right):
            hashes, nth, owner = weighted_shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            sides.append((A.mix(hashes + A.mix(nth.astype(np.uint64) + np.uint64(11)) + A.mix(owner.astype(np.uint64) + np.uint64(77))), owner))
        keys = np.concatenate([sides[0][0], sides[1][0]])
        owner = np.concatenate([sides[0][1], sides[1][1]])
        common = np.bincount(owner[A.repeats(keys)[1]], minlength=j - i)
        total = np.bincount(owner, minlength=j - i) - common
        out[i:j] = common / np.maximum(total, 1)
        i = j
    return out


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of the pairs whose whole texts are similar enough; ``texts`` has (id, text)."""
    left = texts.select(F.col("id").alias("id_a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("id_b"), F.col("text").alias("text_b"))
    joined = pairs.join(left, F.col("a") == F.col("id_a")).join(right, F.col("b") == F.col("id_b")).select("a", "b", "text_a", "text_b")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        value = similarity(batch.column("text_a"), batch.column("text_b"))
        keep = pa.array(value >= threshold - 1e-12)
        return pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return joined.mapInArrow(per_batch(work), "a long, b long")


def common_counts(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], n: int, m: int) -> np.ndarray:
    """Common units of each of n texts with each of m; a side is (unit, text) without repeats."""
    units = np.intersect1d(left[0], right[0])
    out = np.zeros((n, m), np.float64)
    if not len(units):
        return out
    sides = []
    for unit, text in (left, right):
        at = np.minimum(np.searchsorted(units, unit), len(units) - 1)
        known = units[at] == unit
        order = np.argsort(at[known], kind="stable")
        place, owner = at[known][order], text[known][order]
        sides.append((place, owner, np.searchsorted(place, np.arange(len(units) + 1))))
    (a_place, a_text, a_of), (b_place, b_text, b_of) = sides
    a_n, b_n = np.diff(a_of), np.diff(b_of)
    rare = a_n * b_n <= 64  # pairs of few texts are listed, the rest is a product of matrices
    each = np.where(rare[a_place], b_n[a_place], 0)
    for i in range(0, len(a_place), 1 << 16):
        some = each[i:i + (1 << 16)]
        of = np.repeat(np.arange(len(some)), some)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(some) - some, some)
        other = b_text[b_of[a_place[i + of]] + nth]
        out += np.bincount(a_text[i + of] * m + other, minlength=n * m).reshape(n, m)
    common = np.flatnonzero(~rare)
    for i in range(0, len(common), 4096):
        column = np.full(len(units), -1)
        column[common[i:i + 4096]] = np.arange(len(common[i:i + 4096]))
        dense = []
        for (place, owner, _), size in zip(sides, (n, m), strict=True):
            x = np.zeros((size, min(4096, len(common) - i)), np.float32)
            here = column[place] >= 0
            x[owner[here], column[place[here]]] = 1
            dense.append(x)
        out += dense[0] @ dense[1].T
    return out


def block_links(group: pa.Table, threshold: float) -> pa.Table:
    """Links (a, b) of roots, enough to join them, between similar texts of two blocks (or of one, without side 1)."""
    side = group["side"].to_numpy()
    root = group["root"].to_numpy()
    here = np.flatnonzero(side == 0)
    there = np.flatnonzero(side == 1)
    texts = group["text"].combine_chunks()
    sides = []
    for rows in (here, there) if len(there) else (here,):
        units, texts_of, weights = [], [], np.zeros(len(rows))
        data, offsets = A.text_bytes(texts.take(pa.array(rows)))
        for i, j, part, bounds in A.chunks(data, offsets):
            hashes, nth, owner = weighted_shingles(part, bounds)
            units.append(A.mix(hashes + A.mix(nth.astype(np.uint64) + np.uint64(11))))
            texts_of.append(owner + i)
            weights[i:j] = np.bincount(owner, minlength=j - i)
        sides.append(((np.concatenate(units), np.concatenate(texts_of)), weights, root[rows]))
    (a, a_weight, a_root), (b, b_weight, b_root) = sides[0], sides[-1]
    common = common_counts(a, b, len(a_weight), len(b_weight))
    total = a_weight[:, None] + b_weight[None, :] - common
    alike = (common >= (threshold - 1e-12) * total) & (common > 0) & (a_root[:, None] != b_root[None, :])
    found: list[tuple[int, int]] = []
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.get(x, x) != x:
            x = up[x]
        return x

    for i, j in zip(*np.nonzero(alike), strict=True):
        x, y = sorted((top(int(a_root[i])), top(int(b_root[j]))))
        if x != y:
            up[y] = x
            found.append((x, y))
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})


def links_across(shared: DataFrame, roots: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) of roots between similar texts of a large bucket; ``roots`` has (id, root), ``texts`` (id, text, bytes).

    A root with a block's worth of members in a bucket has blocks of its own there, the others
    share blocks. A block is drawn by hash, so no task gathers a bucket.
    """
    named = roots.select(F.col("id").alias("r_id"), "root")
    weights = texts.select(F.col("id").alias("w_id"), "bytes")
    members = shared.where(F.col("members") > SMALL).join(named, F.col("id") == F.col("r_id"), "left").select(
        "id", "band", "hash", F.coalesce("root", "id").alias("root"))
    ends = members.groupBy("band", "hash").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select(
        F.col("band").alias("e_band"), F.col("hash").alias("e_hash"))
    mixed = kept_table(members.join(ends, (F.col("band") == F.col("e_band")) & (F.col("hash") == F.col("e_hash"))).join(
        weights, F.col("id") == F.col("w_id")).select("id", "band", "hash", "root", "bytes"), "mixed")
    if mixed.isEmpty():
        return mixed.select(F.col("root").alias("a"), F.col("root").alias("b"))

    def blocks(n, size):
        return F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES))

    per_root = mixed.groupBy("band", "hash", "root").agg(F.count("*").alias("n"), F.sum("bytes").alias("size"))
    # A root of its own is named; -1 as root stands for all others of the bucket.
    own = F.col("n") >= BLOCK
    per_root = kept_table(per_root.select("band", "hash", "root", "n", "size", own.alias("own")), "roots")
    parts = per_root.groupBy("band", "hash", "own", F.when(F.col("own"), F.col("root")).alias("of")).agg(
        blocks(F.sum("n"), F.sum("size")).alias("blocks"))
    parts = kept_table(parts, "parts")
    key = per_root.select(F.col("band").alias("k_band"), F.col("hash").alias("k_hash"), F.col("root").alias("k_root"), "own")
    placed = mixed.join(key, (F.col("band") == F.col("k_band")) & (F.col("hash") == F.col("k_hash")) & (F.col("root") == F.col("k_root"))).select(
        "id", "band", "hash", "root", F.when(F.col("own"), F.col("root")).alias("of"))
    sizes = parts.select(F.col("band").alias("p_band"), F.col("hash").alias("p_hash"), F.col("of").alias("p_of"), "blocks")
    placed = placed.join(sizes, (F.col("band") == F.col("p_band")) & (F.col("hash") == F.col("p_hash")) & F.col("of").eqNullSafe(F.col("p_of"))).select(
        "id", "band", "hash", "root", "of", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"))
    listed = parts.select("band", "hash", "of", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"))
    left = listed.select("band", "hash", F.col("of").alias("x_of"), F.col("block").alias("x_block"))
    right = listed.select(F.col("band").alias("y_band"), F.col("hash").alias("y_hash"), F.col("of").alias("y_of"), F.col("block").alias("y_block"))
    x, y = F.struct("x_of", "x_block"), F.struct("y_of", "y_block")
    meets = left.join(right, (F.col("band") == F.col("y_band")) & (F.col("hash") == F.col("y_hash"))).where(
        (x <= y) & (F.col("x_of").isNull() | F.col("y_of").isNull() | (F.col("x_of") != F.col("y_of")))).select("band", "hash", "x_of", "x_block", "y_of", "y_block")
    pair = F.xxhash64("band", "hash", F.coalesce("x_of", F.lit(-1)), F.col("x_of").isNull(), "x_block", F.coalesce("y_of", F.lit(-1)), F.col("y_of").isNull(), "y_block")
    meets = kept_table(meets.withColumn("pair", pair), "meets")
    one = meets.select(F.col("band").alias("m_band"), F.col("hash").alias("m_hash"), F.col("x_of").alias("m_of"), F.col("x_block").alias("m_block"), "pair", F.lit(0).alias("side"))
    other = meets.where(~x.eqNullSafe(y)).select(F.col("band").alias("m_band"), F.col("hash").alias("m_hash"), F.col("y_of").alias("m_of"), F.col("y_block").alias("m_block"), "pair", F.lit(1).alias("side"))
    dealt = placed.join(one.union(other), (F.col("band") == F.col("m_band")) & (F.col("hash") == F.col("m_hash")) & F.col("of").eqNullSafe(F.col("m_of")) & (F.col("block") == F.col("m_block"))).select("id", "root", "pair", "side")
    whole = dealt.join(texts.select(F.col("id").alias("t_id"), "text"), F.col("id") == F.col("t_id")).select("pair", "side", "root", "text")
    return whole.groupBy("pair").applyInArrow(lambda group: block_links(group, threshold), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, root): the least id that each id of ``links`` (a, b) reaches.

    Each round points every id at its least neighbour, jumps once, and goes on with the
    links between different roots only; at least half of the linked ids leave each time.
    """
    edges = links
    labels = None
    while True:
        both = edges.union(edges.select("b", "a")).toDF("a", "b")
        near = kept_table(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("root")), "near")
        up = near.select(F.col("id").alias("up_id"), F.col("root").alias("up_root"))
        parents = kept_table(near.join(up, F.col("root") == F.col("up_id")).select(F.col("id").alias("p_id"), F.col("up_root").alias("p_root")), "parents")
        if labels is None:
            labels = parents.select(F.col("p_id").alias("id"), F.col("p_root").alias("root"))
        else:
            labels = kept_table(labels.join(parents, F.col("root") == F.col("p_id"), "left").select("id", F.coalesce("p_root", "root").alias("root")), "labels")
        one = edges.join(parents, F.col("a") == F.col("p_id")).select(F.col("p_root").alias("a"), "b")
        other = one.join(parents, F.col("b") == F.col("p_id")).select("a", F.col("p_root").alias("b"))
        edges = kept_table(other.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        if edges.isEmpty():
            return labels


def row_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, ROW_KEY, class_id, class_key, class_size and ``first`` (id and key of the row that stands for the class) of every row."""
    marks = kept_table(fingerprints(docs), "fingerprints")
    own = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", *ROW_KEY)
    copies = marks.where("words_a is not null").groupBy("words_a", "words_b").agg(F.min(own).alias("rep"))
    # Texts are numbered once, as they are written: a text without an id has a number as well.
    copies = kept_table(copies.select(
        F.col("words_a").alias("c_a"), F.col("words_b").alias("c_b"), F.monotonically_increasing_id().alias("number"), *[F.col(f"rep.{c}").alias(f"rep_{c}") for c in ("doc_id", *ROW_KEY)]), "copies")

    def represents(of: DataFrame):
        same = F.col("doc_id").eqNullSafe(F.col("rep_doc_id"))
        for c in ROW_KEY:
            same = same & (F.col(c) == F.col(f"rep_{c}"))
        return of.drop("c_a", "c_b").hint("merge"), same

    bands = marks.where("words_a is not null").join(*represents(copies)).select(F.col("number").alias("id"), "bands").dropDuplicates(["id"])
    shared = shared_buckets(bands)
    pairs = kept_table(candidate_pairs(shared), "pairs")
    ends = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "end")
    wanted = copies.join(ends.hint("merge"), F.col("number") == F.col("end"), "left_semi")
    texts = with_row_key(docs.select("doc_id", "text")).join(*represents(wanted)).select(F.col("number").alias("id"), "text").dropDuplicates(["id"])
    links = kept_table(verified(pairs, texts, threshold), "verified")
    near = components(links)
    more = kept_table(links_across(shared, near, texts.withColumn("bytes", F.octet_length("text").cast("bigint")), threshold), "across")
    if not more.isEmpty():
        near = components(links.unionByName(more))
    roots = near.withColumnRenamed("id", "r_id")
    classes = copies.join(roots, F.col("number") == F.col("r_id"), "left").select("c_a", "c_b", F.coalesce("root", "number").alias("root"))
    placed = marks.drop("bands").join(classes, (F.col("words_a") == F.col("c_a")) & (F.col("words_b") == F.col("c_b")), "left").drop("c_a", "c_b")
    # A row without words is in a class with rows of its own id only.
    placed = placed.withColumns({"wordless": F.col("root").isNull(), "root": F.coalesce(F.col("root"), F.xxhash64("doc_id"))})
    key = F.when(~F.col("wordless"), F.concat(*[F.lpad(F.lower(F.hex(c)), 16, "0") for c in ("words_a", "words_b")]))
    sizes = placed.groupBy("root", "wordless").agg(F.count("*").alias("class_size"), F.min(own).alias("first"), F.min(key).alias("class_key"))
    sizes = sizes.withColumnsRenamed({"root": "z_root", "wordless": "z_wordless"})
    joined = placed.join(sizes, (F.col("root") == F.col("z_root")) & (F.col("wordless") == F.col("z_wordless")))
    return joined.select("doc_id", *ROW_KEY, F.when(F.col("wordless"), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"), "class_size", "class_key", "wordless", "first")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, class_size, class_key for every row."""
    return row_classes(docs, threshold).select("doc_id", "class_id", "class_size", "class_key")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` per class, that of the least id; all columns as they came.

    Rows without words all stay, but for repetitions of one row.
    """
    classes = row_classes(docs, threshold)
    stays = F.col("wordless") | F.struct("doc_id", *ROW_KEY).eqNullSafe(F.struct(*[F.col(f"first.{c}").alias(c) for c in ("doc_id", *ROW_KEY)]))
    kept = rows_named(docs, classes.where(stays), "left_semi")
    return with_row_key(kept).dropDuplicates(["doc_id", *ROW_KEY]).drop(*ROW_KEY)

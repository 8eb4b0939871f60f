"""Suffix-array dedup: bytes covered by 50-byte strings that smaller documents hold too.

Every 50-byte window has an anchor, the 16-byte gram in it with the least hash (leftmost
among equals), so equal windows have equal anchors at the same place. Neighbouring windows
with one anchor form a run, and each window lies in exactly one run.

1. Runs meet by anchor. Runs of equal bytes are settled at once: all but the least document
   lose the whole run. What is left of an anchor are runs of different bytes, one document
   each. Batches settle equal runs among themselves first, so a passage that a third of all
   documents share reaches its bucket once per batch.
2. Where an anchor has several different runs, their windows may still be equal in part (at
   the ends of a shared passage). Two runs with a window in common agree in all bytes that the
   windows of one of CLASSES classes of the anchor's place have around it, so runs that share no
   print are out. The rest are set on end, group by group, and sorted into a suffix array and its Burrows-Wheeler transform. Breadth-first backward extension finds
   the boundaries of the intervals of equal prefixes by increasing length and stops at 50:
   then every interval holds the places of one 50-byte string, and its least document keeps it.
3. Anchors with more than HOT different runs don't fit one task. Their windows are hashed to
   128 bits and the least document per window is an aggregate.

Texts are UTF-8 bytes and matches don't cross documents. Rows with one id are one document:
they take nothing from each other. A null text is empty; a null id counts as larger than any
other. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm import arrays as A
from tidewright.llm.common import kept_table, per_batch

LENGTH, GRAM = 50, 16
#: Bytes of text whose anchors share a bucket; different runs of an anchor that one task takes.
BUCKET_BYTES, HOT = 4 << 20, 2048
#: Bytes set on end for one transform, and bytes of text whose runs are found at a time; both stay in the processor's cache.
TRANSFORM_BYTES, CHUNK_BYTES = 1 << 16, 1 << 17
#: Runs of neighbouring texts that settle equal ones among themselves.
MEETING_RUNS = 1 << 19
NULL_ID = (1 << 63) - 1
FULL, PARTIAL, WINDOWED = 1, 2, 3


def _reaches(classes: int) -> list[tuple[int, int]]:
    """Bytes before and after the anchor that windows of a class have at least, by the anchor's place in the window."""
    free = LENGTH - GRAM  # places of the anchor: 0 to free
    starts = [k * (free + 1) // classes for k in range(classes + 1)]
    return [(a, free - (b - 1)) for a, b in zip(starts, starts[1:], strict=False)]


#: Prints of a run: two runs with a window in common agree in one of them.
CLASSES = 4
REACHES = _reaches(CLASSES)


def runs(part: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, anchor hash, key, prints) of each run.

    A print is a hash of the anchor with the bytes of its reach, 0 where no window of the run
    reaches so far. The key is a hash of the run's bytes whose low 16 bits are the first print;
    the others are a row each.
    """
    none = np.zeros(0, np.int64)
    if len(part) < LENGTH:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), np.zeros((0, CLASSES - 1), np.uint16)
    wide = np.ndarray(len(part) - 7, "<u8", part.tobytes(), strides=(1,))
    grams = A.mix(wide[:-8] ^ A.mix(wide[8:]))
    best = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width, span = LENGTH - GRAM + 1, 1
    while 2 * span <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    rest = width - span
    best = np.minimum(best[:len(best) - rest], best[rest:]) if rest else best
    anchor = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)  # of the window that starts here
    last_start = np.maximum(bounds[1:] - LENGTH + 1, bounds[:-1])
    valid = np.zeros(len(part) + 1, np.int8)
    np.add.at(valid, bounds[:-1], 1)
    np.add.at(valid, last_start, -1)
    valid = np.cumsum(valid[:len(anchor)]) > 0
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    begins[bounds[:-1][(bounds[:-1] < len(anchor)) & (np.diff(bounds) >= LENGTH)]] = True
    ends = valid.copy()
    ends[:-1] &= ~valid[1:] | begins[1:]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    at = anchor[first]
    key = A.mix(A.span_hashes(part, first, last + LENGTH) + (at - first).astype(np.uint64))
    left, right = at - first, last + LENGTH - at - GRAM
    prints = []
    for before, after in REACHES:
        has = (left >= before) & (right >= after)
        start, end = np.where(has, at - before, 0), np.where(has, at + GRAM + after, 0)
        prints.append(np.where(has, A.span_hashes(part, start, end) & np.uint64(0xFFFF) | np.uint64(1), 0).astype(np.uint16))
    key = (key & ~np.uint64(0xFFFF)) | prints[0].astype(np.uint64)
    text = np.searchsorted(bounds, first, "right") - 1
    return text, first, last, grams[at], key, np.stack(prints[1:], axis=1)


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Starts of the groups of equal rows in sorted arrays."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)


def part_of(doc: np.ndarray, parts: int) -> np.ndarray:
    """The part of each document: crc32 of the id as text, as Spark has it."""
    ids, back = np.unique(doc, return_inverse=True)
    return np.array([zlib.crc32(str(i).encode()) % parts for i in ids.tolist()], np.int64)[back]


def _by_part(doc: np.ndarray, key: np.ndarray, parts: int):
    """(part, keys, docs) of runs that share a fate."""
    part = part_of(doc, parts)
    order = np.lexsort((doc, part))
    doc, key, part = doc[order], key[order], part[order]
    starts = _groups(part)
    for a, b in zip(starts, np.append(starts, len(part))[1:], strict=True):
        yield int(part[a]), key[a:b].tobytes(), doc[a:b].tobytes()


MET = pa.schema([("bucket", pa.int32()), ("anchors", pa.binary()), ("keys", pa.binary()), ("prints", pa.binary()), ("docs", pa.binary()), ("flag", pa.int32())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)


def meeting_rows(buckets: int):
    """Batches of texts to rows of MET: entries of anchors (flag 0) or settled runs, by part."""
    def met(doc: np.ndarray, anchor: np.ndarray, key: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((doc, key))
        doc, anchor, key, prints = doc[order], anchor[order], key[order], prints[order]
        starts = _groups(key)
        later = doc > np.repeat(doc[starts], np.diff(np.append(starts, len(key))))
        rows = [(buckets + part, None, keys, None, docs, FULL) for part, keys, docs in _by_part(doc[later], key[later], buckets)]
        doc, anchor, key, prints = doc[starts], anchor[starts], key[starts], prints[starts]
        bucket = (anchor % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((doc, bucket))
        doc, anchor, key, prints, bucket = doc[order], anchor[order], key[order], prints[order], bucket[order]
        starts = _groups(bucket)
        short = (anchor >> np.uint64(32)).astype(np.uint32)
        for a, b in zip(starts, np.append(starts, len(bucket))[1:], strict=True):
            rows.append((int(bucket[a]), short[a:b].tobytes(), key[a:b].tobytes(), prints[a:b].tobytes(), doc[a:b].tobytes(), 0))
        return _batch(rows, MET)

    def run(batches):
        for batch in batches:
            data, offsets = A.text_bytes(batch.column("text"))
            ids, found, size = _ids(batch.column("doc_id")), [], 0
            for i, _, part, bounds in A.chunks(data, offsets, CHUNK_BYTES):
                text, _, _, anchor, key, prints = runs(part, bounds)
                found.append((ids[i + text], anchor, key, prints))
                size += len(text)
                if size >= MEETING_RUNS:
                    yield met(*(np.concatenate(x) for x in zip(*found, strict=True)))
                    found, size = [], 0
            if size:
                yield met(*(np.concatenate(x) for x in zip(*found, strict=True)))

    return run


FATES = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary()), ("flag", pa.int32())])


def settle(buckets: int, hot: int):
    """A bucket of anchors to the fates of the runs in it."""
    def work(group: pa.Table) -> pa.Table:
        rows = [(b - buckets, k, d, f) for b, k, d, f in zip(*(group[c].to_pylist() for c in ("bucket", "keys", "docs", "flag")), strict=True) if f]
        entries = group.filter(pc.equal(group["flag"], 0))
        if entries.num_rows:
            anchor, key, prints, doc = (np.frombuffer(b"".join(entries[c].to_pylist()), t) for c, t in (("anchors", np.uint32), ("keys", np.uint64), ("prints", np.uint16), ("docs", np.int64)))
            order = np.lexsort((doc, key, anchor))
            anchor, key, prints, doc = anchor[order], key[order], prints.reshape(len(key), CLASSES - 1)[order], doc[order]
            starts = _groups(anchor, key)
            later = doc > np.repeat(doc[starts], np.diff(np.append(starts, len(doc))))
            rows += [(*row, FULL) for row in _by_part(doc[later], key[later], buckets)]
            anchor, key, prints, doc = (x[starts].astype(x.dtype) for x in (anchor, key, prints, doc))
            alike = np.zeros(len(key), bool)
            for own in (key & np.uint64(0xFFFF), *prints.T.astype(np.uint64)):
                has = np.flatnonzero(own)
                alike[has] |= A.repeats((anchor[has].astype(np.uint64) << np.uint64(16)) | own[has])[0]
            anchor, key, doc = anchor[alike], key[alike], doc[alike]
            groups = np.diff(np.append(_groups(anchor), len(anchor)))
            many = np.repeat(groups, groups) > hot
            for flag, chosen in ((PARTIAL, ~many), (WINDOWED, many)):
                rows += [(*row, flag) for row in _by_part(doc[chosen], key[chosen], buckets)]
        return pa.Table.from_batches([_batch(rows, FATES)])
    return work


def covered(n: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, first, 1)
    np.add.at(depth, end, -1)
    return np.cumsum(depth[:n]) > 0


def verdict(text: np.ndarray, gone: np.ndarray) -> tuple[int, int, int, str]:
    """n_bytes, n_removed, n_spans, kept_sha256."""
    spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return len(text), int(gone.sum()), spans, hashlib.sha256(text[~gone].tobytes()).hexdigest()


PIECES = pa.schema([
    ("kind", pa.int32()), ("doc_id", pa.int64()), ("row_key", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
    ("bytes", pa.binary()), ("spans", pa.binary()), ("bucket", pa.int32()), ("hash_a", pa.int64()), ("hash_b", pa.int64()), ("place", pa.int64())])
DONE, WAITING, RUN, WINDOW = 0, 1, 2, 3


def _pieces(n: int, **columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in PIECES]
    return pa.RecordBatch.from_arrays(arrays, schema=PIECES)


def pieces(buckets: int):
    """A part of the documents and its fates to finished documents, waiting ones, and what those wait for."""
    def work(docs: pa.Table, fates: pa.Table) -> pa.Table:
        known = {}
        for flag in (FULL, PARTIAL, WINDOWED):
            own = fates.filter(pc.equal(fates["flag"], flag))
            key, doc = (np.frombuffer(b"".join(own[c].to_pylist()), t) for c, t in (("keys", np.uint64), ("docs", np.int64)))
            known[flag] = np.unique(A.mix(key + A.mix(doc.view(np.uint64))))
        out = []
        for batch in docs.to_batches():
            data, offsets = A.text_bytes(batch.column("text"))
            for i, j, part, bounds in A.chunks(data, offsets, CHUNK_BYTES):
                out += chunk(batch.column("doc_id").slice(i, j - i), part, bounds, known)
        return pa.Table.from_batches(out, schema=PIECES)

    def chunk(column: pa.Array, part: np.ndarray, bounds: np.ndarray, known: dict[int, np.ndarray]):
        ids = _ids(column)
        text, first, last, anchor, key, _ = runs(part, bounds)
        mine = A.mix(key + A.mix(ids[text].view(np.uint64)))
        by = {}
        for flag, fate in known.items():
            at = np.minimum(np.searchsorted(fate, mine), max(0, len(fate) - 1))
            by[flag] = fate[at] == mine if len(fate) else np.zeros(len(mine), bool)
        gone = covered(len(part), first[by[FULL]], last[by[FULL]] + LENGTH)
        waits = np.zeros(len(ids), bool)
        waits[text[(by[PARTIAL] | by[WINDOWED]) & ~by[FULL]]] = True
        head = gone.copy()
        head[1:] &= ~gone[:-1]
        edges = bounds[:-1][bounds[:-1] < len(part)]
        head[edges] |= gone[edges]
        done = np.flatnonzero(~waits)
        sums = []
        for d in done.tolist():
            a, b = bounds[d], bounds[d + 1]
            sums.append(hashlib.sha256(part[a:b][~gone[a:b]] if gone[a:b].any() else part[a:b]).hexdigest())
        yield _pieces(len(done), kind=np.full(len(done), DONE), doc_id=column.take(pa.array(done)), n_bytes=np.diff(bounds)[done], n_removed=A.per_text(gone, bounds)[done], n_spans=A.per_text(head, bounds)[done], kept_sha256=sums)
        open_texts = np.flatnonzero(waits)
        if not len(open_texts):
            return
        bodies = [part[bounds[d]:bounds[d + 1]].tobytes() for d in open_texts.tolist()]
        row_keys = np.zeros(len(ids), np.int64)
        row_keys[open_texts] = [int.from_bytes(hashlib.blake2b(b, digest_size=8).digest(), "little", signed=True) for b in bodies]
        yield _pieces(len(bodies), kind=np.full(len(bodies), WAITING), doc_id=column.take(pa.array(open_texts)), row_key=row_keys[open_texts], bytes=bodies,
                      spans=[np.packbits(gone[bounds[d]:bounds[d + 1]]).tobytes() for d in open_texts.tolist()])
        partial = np.flatnonzero(by[PARTIAL] & ~by[FULL])
        if len(partial):
            yield _pieces(len(partial), kind=np.full(len(partial), RUN), doc_id=column.take(pa.array(text[partial])), row_key=row_keys[text[partial]],
                          bytes=[part[a:b + LENGTH].tobytes() for a, b in zip(first[partial].tolist(), last[partial].tolist(), strict=True)],
                          place=first[partial] - bounds[text[partial]], bucket=(anchor[partial] % np.uint64(buckets)).astype(np.int32), hash_a=anchor[partial].view(np.int64))
        wide = np.flatnonzero(by[WINDOWED] & ~by[FULL])
        if len(wide):
            counts = last[wide] - first[wide] + 1
            places = np.repeat(first[wide], counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
            of = np.repeat(text[wide], counts)
            yield _pieces(len(places), kind=np.full(len(places), WINDOW), doc_id=column.take(pa.array(of)), row_key=row_keys[of], place=places - bounds[of],
                          hash_a=A.span_hashes(part, places, places + LENGTH, 0).view(np.int64), hash_b=A.span_hashes(part, places, places + LENGTH, 1).view(np.int64))

    return work


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes of numbers in which every text ends with a number of its own."""
    bits = int(symbols.max() + 1).bit_length()
    step = 1
    key = symbols + 1
    while 2 * step * bits <= 62:  # the first few symbols fit one number
        beyond = np.zeros(len(key), np.int64)
        beyond[:-step] = key[step:]
        key = (key << (step * bits)) | beyond
        step *= 2
    rank = np.empty(len(symbols), np.int64)
    while True:
        order = np.argsort(key)
        ranked = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        if rank[order[-1]] == len(symbols) - 1:
            return order
        beyond = np.zeros(len(rank), np.int64)
        beyond[:-step] = rank[step:] + 1
        key = rank * (len(rank) + 1) + beyond
        step *= 2


def interval_starts(symbols: np.ndarray, order: np.ndarray, ends: int, length: int) -> np.ndarray:
    """Where suffixes in ``order`` start to differ within ``length`` symbols from the one before.

    ``symbols`` below ``ends`` end texts. Level by level: the boundary of an interval at
    length l, extended backward by a symbol of the transform, is one at length l + 1. Each
    place waits with the place before it of the same symbol until a boundary of the level
    falls between the two; then it leaves the queue. Where a level adds no boundary, none follows.
    """
    n = len(symbols)
    transform = symbols[order - 1]
    # Few symbols: 16-bit numbers are sorted by their digits.
    by_symbol = np.argsort(transform.astype(np.uint16) if symbols.max() < 1 << 16 else transform, kind="stable")
    to = np.empty(n, np.int64)  # backward extension of each place
    to[by_symbol] = np.arange(n)
    before = np.full(n, -1, np.int64)  # the place before with the same symbol
    same = transform[by_symbol[1:]] == transform[by_symbol[:-1]]
    before[by_symbol[1:][same]] = by_symbol[:-1][same]
    known = np.zeros(n, bool)
    known[0] = True
    known[:ends] = True  # text ends differ from all else in their first symbol
    place = np.flatnonzero(transform >= ends)
    alone = before[place] < 0
    known[to[place[alone]]] = True
    place = place[~alone].astype(np.int32)
    previous, target = before[place].astype(np.int32), to[place].astype(np.int32)
    for step in range(1, length):
        level = np.cumsum(known, dtype=np.int32)
        apart = level[place] > level[previous]
        known[target[apart]] = True
        if step % 4 == 0:  # those that are apart stay so; the queue is cleared of them now and then
            if not apart.any():
                break
            waits = np.flatnonzero(~apart)
            place, previous, target = place[waits], previous[waits], target[waits]
    return known


def repeated_windows(texts: list[bytes], doc: np.ndarray) -> list[np.ndarray]:
    """Per text, the places of its windows that a text of a smaller document holds."""
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + len(texts)
    symbols[begin + sizes] = np.arange(len(texts))
    order = suffix_array(symbols)
    starts = np.flatnonzero(interval_starts(symbols, order, len(texts), LENGTH))
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    place = np.arange(len(symbols)) - begin[owner]
    least = np.repeat(np.minimum.reduceat(doc[owner[order]], starts), np.diff(np.append(starts, len(order))))
    smaller = np.zeros(len(symbols), bool)
    smaller[order] = least < doc[owner[order]]
    hit = np.flatnonzero(smaller & (place + LENGTH <= sizes[owner]))
    return np.split(place[hit], np.searchsorted(owner[hit], np.arange(1, len(texts))))


PLACES = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("places", pa.binary())])


def transform_group(group: pa.Table) -> pa.Table:
    """Runs of a bucket to the places of their repeated windows, whole anchors at a time."""
    anchor = group["hash_a"].to_numpy()
    order = np.argsort(anchor, kind="stable")
    anchor = anchor[order]
    texts = group["bytes"].take(pa.array(order)).to_pylist()
    ids, keys, place = group["doc_id"].take(pa.array(order)), group["row_key"].take(pa.array(order)).to_pylist(), group["place"].to_numpy()[order]
    doc = _ids(ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) and ids.num_chunks != 1 else ids.chunk(0))
    starts = np.append(_groups(anchor), len(anchor))
    filled = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    rows, k = [], 0
    while k < len(starts) - 1:
        e = k + 1
        while e < len(starts) - 1 and filled[starts[e + 1]] - filled[starts[k]] <= TRANSFORM_BYTES:
            e += 1
        a, b = int(starts[k]), int(starts[e])
        for t, hits in enumerate(repeated_windows(texts[a:b], doc[a:b])):
            if len(hits):
                rows.append((ids[a + t].as_py(), keys[a + t], (hits + place[a + t]).astype(np.int64).tobytes()))
        k = e
    return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), PLACES, strict=True)], schema=PLACES) if rows else PLACES.empty_table()


def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
    out = []
    for text, spans, found, lone in zip(*(batch.column(c).to_pylist() for c in ("bytes", "spans", "places", "lone")), strict=True):
        data = np.frombuffer(text, np.uint8)
        gone = np.unpackbits(np.frombuffer(spans, np.uint8), count=len(data)).astype(bool)
        places = np.concatenate([np.frombuffer(b"".join(found or []), np.int64), np.array(lone or [], np.int64)])
        out.append(verdict(data, gone | covered(len(data), places, places + LENGTH)))
    columns = list(zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([batch.column("doc_id")] + [pa.array(c) for c in columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def substring_dedup(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    total = texts.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = max(1, -(-int(total) // bucket_bytes))
    met = texts.mapInArrow(meeting_rows(buckets), "bucket int, anchors binary, keys binary, prints binary, docs binary, flag int")
    fates = kept_table(met.groupBy("bucket").applyInArrow(settle(buckets, hot), "part int, keys binary, docs binary, flag int"), "fates")
    null_id = F.lit(NULL_ID)
    own_part = F.pmod(F.crc32(F.coalesce("doc_id", null_id).cast("string")), F.lit(buckets)).cast("int")
    joined = texts.withColumn("part", own_part).groupBy("part").cogroup(fates.groupBy("part"))
    schema = "kind int, doc_id long, row_key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, bytes binary, spans binary, bucket int, hash_a long, hash_b long, place long"
    parts = kept_table(joined.applyInArrow(pieces(buckets), schema), "pieces")
    done = parts.where(F.col("kind") == DONE).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")

    found = parts.where(F.col("kind") == RUN).select("bucket", "doc_id", "row_key", "hash_a", "bytes", "place").groupBy("bucket").applyInArrow(
        transform_group, "doc_id long, row_key long, places binary").groupBy("doc_id", "row_key").agg(F.collect_list("places").alias("places"))
    windows = parts.where(F.col("kind") == WINDOW).select("hash_a", "hash_b", "doc_id", "row_key", "place")
    doc = F.coalesce("doc_id", null_id)
    least = windows.groupBy("hash_a", "hash_b").agg(F.min(doc).alias("least"), F.max(doc).alias("most")).where("least < most").withColumnsRenamed({"hash_a": "l_a", "hash_b": "l_b"})
    lone = windows.join(least, (F.col("hash_a") == F.col("l_a")) & (F.col("hash_b") == F.col("l_b"))).where(doc > F.col("least")).groupBy("doc_id", "row_key").agg(F.collect_list("place").alias("lone"))
    waiting = parts.where(F.col("kind") == WAITING).select("doc_id", "row_key", "bytes", "spans")
    for part, prefix in ((found, "p"), (lone, "q")):
        part = part.withColumnsRenamed({"doc_id": f"{prefix}_id", "row_key": f"{prefix}_key"})
        waiting = waiting.join(part, F.col("doc_id").eqNullSafe(F.col(f"{prefix}_id")) & (F.col("row_key") == F.col(f"{prefix}_key")), "left").drop(f"{prefix}_id", f"{prefix}_key")
    return done.unionByName(waiting.mapInArrow(per_batch(finish), RESULT))

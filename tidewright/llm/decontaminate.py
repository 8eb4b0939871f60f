"""Benchmark decontamination: latent semantic retrieval, then checks on the words.

The items are split into passages and become TF-IDF vectors over their own vocabulary, with
passage frequencies counted over all documents. A distributed randomised SVD (subspace
iteration; Spark sums the products with the Gram matrix) gives the latent space. Every
document is read in windows of several lengths at a quarter of their length. A window is
compared by cosine with the passages of about its length, unless it and its surroundings hold
fewer words of the vocabulary than any of them needs. Candidates pass if the longest common
subsequence of the passage's words with the window and its surroundings holds at least
COPIED of the passage, or at least REWORDED of it along with the item's answer (its ``answer``
column, or else its last sentence), which may be as far away as the item is long, or if the
heaviest common subsequence, words weighed by their inverse frequency, holds at least RARE of
the passage's weight: words that a paraphrase kept by chance are frequent ones. An item of
up to PASSAGE_WORDS words is one passage; longer ones give passages of that many words, half
overlapping, the last one at the end. ``share`` is that of the item's best passage.

Items are a query set: they are taken in blocks of about ``block_items`` and BLOCK_BYTES, and each
block passes over all documents, so a task holds one block. Words are runs of letters and digits, in lower
case. Nulls: a null or wordless item matches nothing, a null text contains nothing; a null
``doc_id`` is reported as null. Repeated rows are reported once; with an empty table on either
side nothing is reported.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm import arrays as A
from tidewright.llm.common import ROW_KEY, kept_table, per_batch, rows_named, with_row_key

PASSAGE_WORDS = 64
WINDOWS = (10, 20, 40, 80)
RANK, OVERSAMPLE, POWERS = 128, 16, 2
COSINE = 0.5
COPIED, REWORDED = 0.7, 0.5
ANSWER_SHARE = 0.8
#: Share of a passage's weight. Passages with half of their words replaced keep 0.4 or more in 95 of 100 cases (200 items of the
#: check tables); texts without the item stayed below 0.25 (1,200 of their documents, 12,556 pairs that the search brought up).
RARE = 0.4
#: A block of items holds about so many items and bytes of their texts; its vocabulary is bounded by the bytes.
BLOCK_ITEMS, BLOCK_BYTES = 2048, 1 << 20
SLOTS = 256
#: Of the table of candidates by vocabulary that one step of the bound fills.
TABLE_BYTES = 8 << 20

_BREAKS = np.ones(256, bool)
_BREAKS[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") + list(range(128, 256))] = False


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, and n + 1 positions of the texts among them."""
    starts, ends, of = A.word_spans(data, bounds, _BREAKS)
    return A.span_hashes(data, starts, ends), of


def lower_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return A.text_bytes(pc.utf8_lower(texts))


def _words_of(text: str | None) -> np.ndarray:
    return word_hashes(*lower_bytes(pa.array([text or ""])))[0]


def last_sentence(text: str) -> str:
    parts = [p for p in text.replace("\n", ".").replace("?", ".").replace("!", ".").split(".") if len(_words_of(p))]
    return parts[-1] if parts else ""


def passage_starts(n: int) -> list[int]:
    """Where the passages of an item of n words start."""
    return [0] if n <= PASSAGE_WORDS else [*range(0, n - PASSAGE_WORDS, PASSAGE_WORDS // 2), n - PASSAGE_WORDS]


class Items:
    """A block of items: the words of their passages, the item of each passage, answers and vocabulary."""

    def __init__(self, rows: list[tuple]):
        self.ids, self.words, self.answers, self.sizes, self.item_of = [], [], [], [], []
        for item, text, answer in rows:
            words = _words_of(text)
            if len(words):
                starts = passage_starts(len(words))
                self.item_of += [len(self.ids)] * len(starts)
                self.words += [words[k:k + PASSAGE_WORDS] for k in starts]
                self.ids.append(item)
                self.sizes.append(len(words))
                self.answers.append(_words_of(answer if answer else last_sentence(text)))
        self.vocabulary = np.unique(np.concatenate(self.words)) if self.words else np.zeros(0, np.uint64)
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.present = np.zeros(1 << 20, bool)
        self.present[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True

    def slots(self, words: np.ndarray) -> np.ndarray:
        """Place of each word in the vocabulary, or its size for other words."""
        out = np.full(len(words), len(self.vocabulary), np.int64)
        maybe = np.flatnonzero(self.present[(words >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.vocabulary, words[maybe]), len(self.vocabulary) - 1)
        same = self.vocabulary[at] == words[maybe]
        out[maybe[same]] = at[same]
        return out


def passage_frequencies(docs: DataFrame, items: Items) -> tuple[int, np.ndarray]:
    """Passages of all documents, and how many hold each word of the vocabulary."""
    size = len(items.vocabulary)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = lower_bytes(batch.column("text"))
        found, passages = np.zeros(size, np.int64), 0
        for _, _, part, bounds in A.chunks(data, offsets):
            words, of = word_hashes(part, bounds)
            text = A.owners(of)
            new = np.zeros(len(words), bool)
            place = np.arange(len(words)) - of[:-1][text]
            new[place % PASSAGE_WORDS == 0] = True
            passage = np.cumsum(new)
            passages += int(passage[-1]) if len(passage) else 0
            slots = items.slots(words)
            known = slots < size
            pairs = np.unique(passage[known] * (size + 1) + slots[known])
            found += np.bincount(pairs % (size + 1), minlength=size + 1)[:size]
        at = np.flatnonzero(found)
        return pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(found[at], passages))], names=["slot", "n"])

    total, n = np.zeros(size, np.int64), 0
    for row in docs.select("text").mapInArrow(per_batch(work), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        if row["slot"] < 0:
            n = row["n"]
        else:
            total[row["slot"]] = row["n"]
    return n, total


def gram_product(passages: DataFrame, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A'A times ``basis`` for the unit TF-IDF rows A of ``passages`` (slots), summed by Spark."""
    width = basis.shape[1]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = np.zeros_like(basis)
        for slots in batch.column("slots").to_pylist():
            at, count = np.unique(np.array(slots), return_counts=True)
            row = count * idf[at]
            row /= max(np.linalg.norm(row), 1e-12)
            out[at] += np.outer(row, row @ basis[at])
        chunks = [(c // SLOTS, out[c:c + SLOTS].tobytes()) for c in range(0, len(out), SLOTS) if out[c:c + SLOTS].any()]
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in chunks], pa.int64()), pa.array([b for _, b in chunks], pa.binary())], names=["part", "sums"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.float64) for b in group["sums"].to_pylist())
        return pa.table({"part": group["part"][:1], "sums": pa.array([total.tobytes()], pa.binary())})

    parts = passages.mapInArrow(per_batch(work), "part long, sums binary").groupBy("part").applyInArrow(add, "part long, sums binary")
    out = np.zeros_like(basis)
    for row in parts.collect():  # vocabulary of a block by rank
        piece = np.frombuffer(row["sums"], np.float64).reshape(-1, width)
        out[row["part"] * SLOTS:row["part"] * SLOTS + len(piece)] = piece
    return out


def latent_space(passages: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 5) -> np.ndarray:
    """Leading right singular vectors of the passages' TF-IDF matrix, vocabulary by rank."""
    width = min(len(idf), rank + OVERSAMPLE)
    basis = np.random.default_rng(seed).standard_normal((len(idf), width))
    for _ in range(POWERS + 1):
        basis = np.linalg.qr(gram_product(passages, idf, basis))[0]
    values, vectors = np.linalg.eigh(basis.T @ gram_product(passages, idf, basis))
    order = np.argsort(values)[::-1][:rank]
    return basis @ vectors[:, order[values[order] > 1e-9]]


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bits of one number per row."""
    masks: dict[int, int] = {}
    for k, word in enumerate(a.tolist()):
        masks[word] = masks.get(word, 0) | 1 << k
    whole = (1 << len(a)) - 1
    row = whole
    for word in b.tolist():
        mask = masks.get(word)
        if mask is not None:
            hit = row & mask
            row = ((row + hit) | (row - hit)) & whole
    return len(a) - row.bit_count()


def heaviest_subsequence(a: np.ndarray, weights: np.ndarray, b: np.ndarray) -> float:
    """Weight of the heaviest common subsequence of the words ``a``, which have weights, with ``b``."""
    row = np.zeros(len(b) + 1)
    for word, weight in zip(a.tolist(), weights.tolist(), strict=True):
        taken = np.where(b == word, row[:-1] + weight, 0.0)
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], taken))
    return float(row[-1])


class Index:
    """Latent vectors of the passages, and the search through a text's windows."""

    def __init__(self, items: Items, idf: np.ndarray, space: np.ndarray):
        self.items = items
        self.rows = np.vstack([idf[:, None] * space, np.zeros((1, space.shape[1]))]).astype(np.float32)
        slots = [items.slots(w) for w in items.words]
        latent = np.stack([self.rows[s].sum(axis=0) for s in slots])
        self.latent = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
        # Each passage is looked for in windows nearest to its length on a log scale.
        self.window = np.array(WINDOWS)[np.argmin(np.abs(np.log(items.lengths[:, None] / np.array(WINDOWS))), axis=1)]
        # Slots of the passages in rows of equal width; the filling is a column that no text sets.
        self.targets = np.full((len(slots), max(map(len, slots))), len(items.vocabulary) + 1, np.int64)
        for row, own in zip(self.targets, slots, strict=True):
            row[:len(own)] = own
        self.weights = [idf[own] for own in slots]
        self.target_weights = np.append(idf, (0.0, 0.0))[self.targets]
        self.heavy = np.maximum(self.target_weights.sum(axis=1), 1e-9)

    def window_sums(self, slots: np.ndarray, of: np.ndarray, size: int, step: int, text: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Summed latent rows of windows: each word is read once, into the sum of its block of ``step`` words."""
        blocks = -(-np.diff(of) // step) + size // step
        first = np.concatenate([[0], np.cumsum(blocks)])
        owner = A.owners(first)
        start = of[:-1][owner] + (np.arange(first[-1]) - first[:-1][owner]) * step
        end = of[1:][owner]
        padded = np.append(slots, len(self.items.vocabulary))
        sums = np.zeros((first[-1], self.rows.shape[1]), np.float32)
        for b in range(0, len(sums), 2048):  # pieces that stay in the processor's cache
            part = sums[b:b + 2048]
            for k in range(step):
                word = start[b:b + 2048] + k
                part += self.rows[padded[np.where(word < end[b:b + 2048], word, len(slots))]]
        head = first[:-1][text] + number
        out = sums[head]
        for k in range(1, size // step):
            out += sums[head + k]
        return out

    def search(self, slots: np.ndarray, of: np.ndarray):
        """Arrays of (text, passage, cosine, window start, window length) of candidates."""
        known = np.concatenate([[0], np.cumsum(slots < len(self.items.vocabulary))])
        counts = np.diff(of)
        for size in np.unique(self.window).tolist():
            mine = np.flatnonzero(self.window == size)
            step = max(1, size // 4)
            n = np.where(counts > 0, np.maximum(0, -(-(counts - size) // step)) + 1, 0)
            text = np.repeat(np.arange(len(counts)), n)
            number = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
            start = of[:-1][text] + number * step
            # Without a word of the vocabulary around it, a window is like no passage.
            reach = max(size, int(self.items.lengths[mine].max())) // 2
            around = known[np.minimum(of[1:][text], start + size + reach)] - known[np.maximum(of[:-1][text], start - reach)]
            likely = np.flatnonzero(around)
            sums = self.window_sums(slots, of, size, step, text[likely], number[likely])
            sums /= np.maximum(np.sqrt(np.einsum("ij,ij->i", sums, sums)), 1e-9)[:, None]
            for k in range(0, len(likely), 2048):
                cosine = sums[k:k + 2048] @ self.latent[mine].T
                hit, item = np.nonzero(cosine >= COSINE)
                if len(hit):
                    window = likely[k + hit]
                    yield text[window], mine[item], cosine[hit, item], start[window], np.full(len(hit), size)

    def reachable(self, slots: np.ndarray, low: np.ndarray, high: np.ndarray, passage: np.ndarray) -> np.ndarray:
        """For each candidate: words low to high hold REWORDED of the passage's words or RARE of their weight, in any order (no common subsequence has more)."""
        out = np.zeros(len(passage), bool)
        width = len(self.items.vocabulary) + 2
        step = max(1, TABLE_BYTES // width)
        for k in range(0, len(passage), step):
            at, n = passage[k:k + step], (high - low)[k:k + step]
            held = np.zeros((len(at), width), bool)
            row = np.repeat(np.arange(len(at)), n)
            held[row, slots[np.arange(len(row)) + np.repeat(low[k:k + step] - (np.cumsum(n) - n), n)]] = True
            found = held[np.arange(len(at))[:, None], self.targets[at]]
            weight = (found * self.target_weights[at]).sum(axis=1)
            out[k:k + step] = (found.sum(axis=1) >= REWORDED * self.items.lengths[at]) | (weight >= RARE * self.heavy[at])
        return out

    def leaks(self, words: np.ndarray, of: np.ndarray) -> list[tuple[int, int, float, float, bool]]:
        """(text, item, cosine, share of its best passage in common, answer found), the best per pair."""
        best: dict[tuple[int, int], tuple[float, float, bool]] = {}
        slots = self.items.slots(words)
        for text, passage, cosine, start, size in self.search(slots, of):
            reach = np.maximum(size, self.items.lengths[passage]) // 2
            low, high = np.maximum(of[text], start - reach), np.minimum(of[text + 1], start + size + reach)
            keep = np.flatnonzero(self.reachable(slots, low, high, passage))
            for t, p, c, s, w, r, lo, hi in zip(*(x[keep].tolist() for x in (text, passage, cosine, start, size, reach, low, high)), strict=True):
                item = self.items.item_of[p]
                target, answer = self.items.words[p], self.items.answers[item]
                share = common_subsequence(target, words[lo:hi]) / len(target)
                rare = share >= COPIED or heaviest_subsequence(target, self.weights[p], words[lo:hi]) >= RARE * self.heavy[p]
                if share < REWORDED and not rare:
                    continue
                r = max(r, self.items.sizes[item])
                found = common_subsequence(answer, words[max(of[t], s - r):min(of[t + 1], s + w + r)]) >= ANSWER_SHARE * len(answer)
                if rare or found:
                    best[t, item] = max(best.get((t, item), (0.0, 0.0, False)), (share, round(c, 4), found))
        return [(t, i, c, s, f) for (t, i), (s, c, f) in best.items()]


def item_passages(items: DataFrame) -> DataFrame:
    """(item_id, text, answer) with the answer null where the table has none."""
    answer = F.col("answer") if "answer" in items.columns else F.lit(None).cast("string")
    return items.select("item_id", "text", answer.alias("answer"))


def contaminated(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS, rank: int = RANK, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """doc_id, item_id, cosine, share, answer_found: a row per document and item that it contains. ``keys`` name a document."""
    spark = docs.sparkSession
    own = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keys)
    item_key = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"{own}, item_id {item_key}, cosine double, share double, answer_found boolean"
    items = item_passages(benchmark)
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(1, -(-size["n"] // block_items), -(-(size["bytes"] or 0) // BLOCK_BYTES))
    out = spark.createDataFrame([], schema)
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        held = Items([tuple(r) for r in part.collect()])
        if not held.ids:
            continue
        n, found = passage_frequencies(docs, held)
        idf = np.log((n + 1) / (np.maximum(found, 1)))

        def passages(batch: pa.RecordBatch, held=held) -> pa.RecordBatch:
            slots = []
            for text in batch.column("text").to_pylist():
                words = held.slots(_words_of(text))
                slots += [words[k:k + PASSAGE_WORDS].tolist() for k in range(0, len(words), PASSAGE_WORDS // 2) if k == 0 or len(words) - k > PASSAGE_WORDS // 2]
            return pa.RecordBatch.from_arrays([pa.array([s for s in slots if s], pa.list_(pa.int64()))], names=["slots"])

        rows = kept_table(part.select("text").mapInArrow(per_batch(passages), "slots array<long>"), "passages")
        index = Index(held, idf, latent_space(rows, idf, rank))

        def work(batch: pa.RecordBatch, index=index) -> pa.RecordBatch:
            data, offsets = lower_bytes(batch.column("text"))
            found = []
            for i, _, chunk, bounds in A.chunks(data, offsets):
                words, of = word_hashes(chunk, bounds)
                found += [(i + t, *rest) for t, *rest in index.leaks(words, of)]
            docs_at = pa.array([f[0] for f in found], pa.int64())
            ids = pa.array([index.items.ids[f[1]] for f in found])
            return pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(docs_at) for c in keys], ids.cast(item_type), pa.array([f[2] for f in found], pa.float64()), pa.array([f[3] for f in found], pa.float64()), pa.array([f[4] for f in found], pa.bool_())],
                names=[*keys, "item_id", "cosine", "share", "answer_found"])

        item_type = pa.string() if item_key == "string" else pa.int32() if item_key == "int" else pa.int64()
        out = out.unionByName(docs.select(*keys, "text").mapInArrow(per_batch(work), schema))
    return out.groupBy(*keys, "item_id").agg(F.max(F.struct("share", "cosine", "answer_found")).alias("best")).select(
        *keys, "item_id", "best.cosine", "best.share", "best.answer_found")


def row_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """As ``contaminated``, with ROW_KEY: which rows contain an item, also among null or repeated ids."""
    return contaminated(with_row_key(docs.select("doc_id", "text")), benchmark, keys=("doc_id", *ROW_KEY))


def without_leaks(docs: DataFrame, leaks: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``leaks`` (of ``row_leaks``) lists; columns as they came."""
    return rows_named(docs, leaks, "left_anti")

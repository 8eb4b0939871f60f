"""Language identification: nearest of several centroids per language, by cosine.

A text is a normalised TF-IDF vector over hashed runs of one to three characters of its
lower-cased letters (words bounded by spaces). Document frequencies come from all
training rows. The centroids are found by spherical k-means among ``fit_rows`` training
rows of each language (a documented, bounded sample, picked by hash of the id; about that
many). The language of the nearest centroid is predicted. Each centroid has a reach, the
cosine distance within which nearly all of its training rows lie; a text beyond it is
``rejected`` (its nearest language is still reported).

Nulls: a null text, or one without a letter, is ``und`` with score 0. Rows without
language don't train. With no training rows everything is ``und``. Repeated rows are
predicted alike; an empty table gives no rows.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.arrays import mix, owners
from tidewright.llm.common import bucket_of, kept_table, per_batch

UNKNOWN = "und"
FOLDS, TEST_FOLD = 4, 2
FEATURES = 1 << 13
FIT_ROWS = 400
CENTROIDS = 4
#: Share of a centroid's training rows within its reach.
REACH_SHARE = 0.999
BATCH_CHARS, BATCH_TEXTS = 1 << 19, 256


@cache
def _letters() -> np.ndarray:
    """The lower-case code of each letter, 32 for everything else."""
    folded = np.full(0x110000, 32, np.uint32)
    for code in range(0x32400):  # no letters lie above
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            folded[code] = ord(low[0])
    return folded


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed n-grams, texts by FEATURES, and whether a text has letters."""
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1)[:-1] if len(texts) > 1 else np.zeros(0, np.int64)
    text_of = owners(np.concatenate([[0], ends, [len(codes)]]))
    folded = _letters()[np.minimum(codes, 0x10FFFF)]
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != 32) | (folded[:-1] != 32) | (text_of[1:] != text_of[:-1])
    folded, text_of = folded[keep].astype(np.uint64), text_of[keep]
    lettered = np.bincount(text_of[folded != 32], minlength=len(texts)) > 0
    counts = np.zeros(len(texts) * FEATURES, np.int64)
    shift = np.uint64(64 - 13)
    for n in (1, 2, 3):
        m = len(folded) - n + 1
        if m <= 0:
            break
        packed = np.full(m, n, np.uint64)
        for k in range(n):
            packed = (packed << np.uint64(18)) | folded[k:k + m]
        whole = (text_of[n - 1:] == text_of[:m]) & (packed & np.uint64(0x3FFFF) != 32) if n == 1 else text_of[n - 1:] == text_of[:m]
        slots = (mix(packed[whole]) >> shift).astype(np.int64)
        counts += np.bincount(text_of[:m][whole] * FEATURES + slots, minlength=len(counts))
    return counts.reshape(len(texts), FEATURES), lettered


def text_groups(texts: list[str]):
    """Positions of neighbouring texts, few and short enough for one dense block."""
    first, chars = 0, 0
    for i, text in enumerate(texts):
        if i > first and (i - first >= BATCH_TEXTS or chars + len(text) > BATCH_CHARS):
            yield first, i
            first, chars = i, 0
        chars += len(text)
    if texts:
        yield first, len(texts)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vectors = np.log1p(counts).astype(np.float32) * idf
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def document_frequencies(training: DataFrame) -> tuple[int, np.ndarray]:
    """Texts and, per feature, texts that have it. The driver gets FEATURES numbers."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        total = np.zeros(FEATURES, np.int64)
        for i, j in text_groups(texts):
            total += (gram_counts(texts[i:j])[0] > 0).sum(axis=0)
        slots = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(np.append(slots, -1)), pa.array(np.append(total[slots], len(texts)))], names=["slot", "n"])

    sums = training.select("text").mapInArrow(per_batch(work), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    found, n = np.zeros(FEATURES, np.int64), 0
    for row in sums:
        if row["slot"] < 0:
            n = row["n"]
        else:
            found[row["slot"]] = row["n"]
    return n, found


def spherical_kmeans(vectors: np.ndarray, k: int, steps: int = 15) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids, and for each the distance that holds REACH_SHARE of its rows."""
    centres = [vectors.mean(axis=0)]
    for _ in range(1, min(k, len(vectors))):  # each further start is the row farthest from the others
        centres.append(vectors[int(np.argmin(np.max(vectors @ np.stack(centres).T, axis=1)))])
    centroids = np.stack(centres)
    for _ in range(steps):
        centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
        nearest = np.argmax(vectors @ centroids.T, axis=1)
        centroids = np.stack([vectors[nearest == c].mean(axis=0) if (nearest == c).any() else centroids[c] for c in range(len(centroids))])
    centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
    cosines = vectors @ centroids.T
    nearest = np.argmax(cosines, axis=1)
    reach = np.array([1 - np.quantile(cosines[nearest == c, c], 1 - REACH_SHARE) if (nearest == c).any() else 0.0 for c in range(len(centroids))])
    return centroids, reach


class Centroids:
    def __init__(self, langs: list[str], vectors: np.ndarray, reach: np.ndarray, idf: np.ndarray):
        self.langs, self.vectors, self.reach, self.idf = langs, vectors, reach, idf

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine (0 to 1) and rejection of each text."""
        langs, scores, rejected = [], [], []
        texts = [t or "" for t in texts]
        for i, j in text_groups(texts):
            counts, lettered = gram_counts(texts[i:j])
            if not len(self.langs):
                lettered = np.zeros(j - i, bool)
                best, cosine = np.zeros(j - i, int), np.zeros(j - i)
            else:
                cosines = weighted(counts, self.idf) @ self.vectors.T
                best = np.argmax(np.round(cosines, 5), axis=1)
                cosine = cosines[np.arange(j - i), best].astype(float)
            langs += [self.langs[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
            scores.append(np.where(lettered, np.clip(np.round(cosine, 5), 0, 1), 0.0))
            rejected.append(~lettered if not len(self.langs) else ~lettered | (1 - cosine > self.reach[best]))
        return langs, np.concatenate(scores), np.concatenate(rejected)


def fit_centroids(training: DataFrame, fit_rows: int = FIT_ROWS, centroids: int = CENTROIDS) -> Centroids:
    """From rows of (doc_id, text, lang). The driver gets the centroids and frequencies only."""
    training = training.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    n, found = document_frequencies(training)
    idf = (np.log((n + 1) / (found + 1)) + 0.05).astype(np.float32)
    # A row per language, as many as models come to the driver below: written, it is broadcast by its size, so no text moves for it.
    sizes = kept_table(training.groupBy("lang").agg(F.count("*").alias("lang_rows")).withColumnRenamed("lang", "g_lang"), "lang-sizes")
    # A row's hash decides by itself whether it is in the sample, so no task ranks a language.
    share = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = training.withColumn("share", share).join(sizes, F.col("lang") == F.col("g_lang")).where(
        F.col("share") * F.col("lang_rows") < fit_rows).select("doc_id", "text", "lang")

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "text"])
        texts = rows["text"].tolist()
        parts = [weighted(gram_counts(texts[i:j])[0], idf) for i, j in text_groups(texts)]
        found, reach = spherical_kmeans(np.concatenate(parts), centroids)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "part": range(len(found)), "reach": reach.astype(float), "vector": [v.astype(np.float32).tolist() for v in found]})

    rows = sorted(sample.groupBy("lang").applyInPandas(cluster, "lang string, part int, reach double, vector array<float>").collect(), key=lambda r: (r["lang"], r["part"]))
    vectors = np.array([r["vector"] for r in rows], np.float32).reshape(-1, FEATURES)
    return Centroids([r["lang"] for r in rows], vectors, np.array([r["reach"] for r in rows]), idf)


def language_id(docs: DataFrame, training: DataFrame, **fit) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row of ``docs`` (only its text is read)."""
    model = fit_centroids(training, **fit)
    key = docs.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores, rejected = model.predict(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(per_batch(work), f"doc_id {key}, lang_pred string, score double, rejected boolean")


def held_out_languages(docs: DataFrame) -> DataFrame:
    """Learns from three quarters of ``docs``, predicts all; ``held_out`` marks the last quarter."""
    training = docs.where(bucket_of("doc_id", FOLDS) != TEST_FOLD).select("doc_id", "text", "lang")
    return language_id(docs, training).withColumn("held_out", bucket_of("doc_id", FOLDS) == TEST_FOLD).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected")

"""Spelling variants by pivotal grams: words one edit apart, and the form each belongs to.

Words are counted over all texts (see ``spoken_runs``); those of MIN_LETTERS code points and
MIN_COUNT occurrences stay. Bigrams are ordered by the number of words that hold them, rarest
first. A word's two pivots are disjoint bigrams, chosen by dynamic programming so that they lie
on two sides of its middle and the commoner of them is as rare as it can be; its gram prefix
is every bigram up to that one. One edit leaves at least one of two disjoint pivots whole, so of
two words an edit apart the one whose prefix ends earlier has a pivot in the prefix of the
other, at the same place counted from the start (edit behind the pivot) or from the end (edit
before it), and their lengths differ by one at most. Those are the position limits.

Bigrams of an alphabet are few, so a pivot alone would meet a fixed share of all words. The
whole text outside the edit is equal, too: a word's letters are divided into about REGIONS
regions, and each pivot is joined together with all letters outside one region of the other
half. The joined pairs are verified by edit distance, so neither a hash nor a region decides.

A join key holds nearly the whole word, so its groups are words that differ in one region
only; every word is counted once before anything is joined, however often it occurs. The
bigram order is bounded by the alphabet squared and is the only thing collected.

A null text has no words; a null ``doc_id`` counts as the empty text in the hash; repeated rows
count each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import kept_table, per_batch

MIN_LETTERS, MIN_COUNT = 7, 2
#: One run in so many loses a letter.
SLIP = 31
#: A form occurs so many times as often as the words that belong to it.
TIMES = 10
REGIONS = 10
#: Words whose keys one task makes.
TASK_WORDS = 1 << 15

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def spoken_runs(doc_id, text: str) -> Counter:
    """Runs of letters of a text in ASCII lower case; a run whose hash with the id 31 divides loses one letter."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in Counter(RUN.findall(text.encode().lower().decode())).items():
        if len(run) >= MIN_LETTERS:  # runs only become shorter
            code = zlib.crc32(run.encode(), start)
            if code % SLIP == 0:
                cut = code % len(run)
                run = run[:cut] + run[cut + 1:]
            if len(run) >= MIN_LETTERS:
                out[run] += n
    return out


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n of the words that are long and frequent enough."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: Counter = Counter()
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if text:
                counts.update(spoken_runs(doc_id, text))
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    counts = docs.select("doc_id", "text").mapInArrow(per_batch(work), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def bigram_order(words: DataFrame) -> dict[str, int]:
    """Place of each bigram, rarest first; at most the alphabet squared."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        held: Counter = Counter()
        for word in batch.column("word").to_pylist():
            held.update({word[i:i + 2] for i in range(len(word) - 1)})
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["gram", "n"])

    held = words.select("word").mapInArrow(per_batch(work), "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return {row["gram"]: place for place, row in enumerate(sorted(held, key=lambda r: (r["n"], r["gram"])))}


def pivots(ranks: list[int], middle: int) -> tuple[int, int, int]:
    """Start of the two pivots and the rank where the gram prefix ends.

    best[k] after letter i is the least possible rank of the commonest of k disjoint bigrams
    that end by i, the first before the middle and the second from there on.
    """
    best = [(-1, ()), None, None]
    for i, rank in enumerate(ranks):
        k = 1 if i + 2 <= middle else 2 if i >= middle else 0
        if k and best[k - 1] is not None:
            chosen = (max(best[k - 1][0], rank), (*best[k - 1][1], i))
            if best[k] is None or chosen < best[k]:
                best[k] = chosen
    end, (first, second) = best[2]
    return first, second, end


def regions(length: int) -> list[tuple[int, int, bool]]:
    """(start, end, lies before the middle) of the regions that a word's letters are divided into."""
    middle, width = length // 2, -(-length // REGIONS)
    return [(a, min(a + width, middle), True) for a in range(0, middle, width)] + [(a, min(a + width, length), False) for a in range(middle, length, width)]


def pivot_rows(word: str, order: dict[str, int]) -> Iterator[tuple[str, int, int]]:
    """(key, prefix end, pivot's place) for each region that an edit may lie in: the pivot of the other half with all letters outside the region."""
    ranks = [order[word[i:i + 2]] for i in range(len(word) - 1)]
    first, second, end = pivots(ranks, len(word) // 2)
    for a, b, before in regions(len(word)):
        yield f"{len(word)} {a} {word[:a]} {word[b:]}", end, second if before else first


def prefix_rows(word: str, order: dict[str, int]) -> Iterator[tuple[str, int, int]]:
    """(key, prefix end, places of the prefix as bits) for words one letter shorter, of equal length and one longer.

    Places are counted in the other word: from the end where the edit lies before the pivot.
    Only keys whose half holds a gram of the prefix are made. Bits repeat every 63 letters.
    """
    ranks = [order[word[i:i + 2]] for i in range(len(word) - 1)]
    end = pivots(ranks, len(word) // 2)[2]
    prefix = [i for i, rank in enumerate(ranks) if rank <= end]
    for other in (len(word) - 1, len(word), len(word) + 1):
        if other < MIN_LETTERS:
            continue
        more, middle = len(word) - other, other // 2
        front = sum({1 << i % 63 for i in prefix if i + 2 <= middle})
        back = sum({1 << (i - more) % 63 for i in prefix if i - more >= middle})
        for a, b, before in regions(other):
            if places := back if before else front:
                yield f"{other} {a} {word[:a]} {word[b + more:]}", end, places


def keyed(words: DataFrame, order: dict[str, int], rows, names: tuple[str, ...]) -> DataFrame:
    """A row per key of each word: key (hash), word, n, prefix end, place or places, under ``names``."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [[], [], [], [], []]
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
            for key, end, place in rows(word, order):
                for column, value in zip(columns, (key, word, n, end, place), strict=True):
                    column.append(value)
        types = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "word", "n", "prefix_end", "place"])

    made = words.select("word", "n").mapInArrow(per_batch(work), "key string, word string, n long, prefix_end int, place long")
    return made.select(F.xxhash64("key").alias(names[0]), F.col("word").alias(names[1]), F.col("n").alias(names[2]), F.col("prefix_end").alias(names[3]), F.col("place").alias(names[4]))


def near_words(words: DataFrame) -> DataFrame:
    """one, one_n, two, two_n: each pair of words exactly one edit apart, once, one before two."""
    order = bigram_order(words)
    # A word makes some thirty keys, so its tasks follow the number of words, not the bytes of their small table.
    words = words.repartition(max(1, -(-words.count() // TASK_WORDS)), "word")
    probes = keyed(words, order, pivot_rows, ("key", "word", "n", "prefix_end", "pivot"))
    index = keyed(words, order, prefix_rows, ("of_key", "of_word", "of_n", "of_end", "places"))
    met = probes.join(index, (F.col("key") == F.col("of_key")) & (F.col("prefix_end") <= F.col("of_end"))
                      & F.expr("(places >> CAST(pivot % 63 AS INT)) & 1 = 1") & (F.col("word") != F.col("of_word")))
    near = met.where(F.levenshtein("word", "of_word", 1) == 1)
    swapped = F.col("word") > F.col("of_word")
    def side(yes: str, no: str):
        return F.when(swapped, F.col(yes)).otherwise(F.col(no))
    return near.select(side("of_word", "word").alias("one"), side("of_n", "n").alias("one_n"), side("word", "of_word").alias("two"), side("n", "of_n").alias("two_n")).dropDuplicates(["one", "two"])


def word_forms(words: DataFrame) -> DataFrame:
    """word, n_near, form, form_n of words with near ones; form is null where no near word is frequent enough."""
    both = near_words(words).select(F.inline(F.array(
        F.struct(F.col("one").alias("word"), F.col("one_n").alias("n"), F.col("two").alias("other"), F.col("two_n").alias("other_n")),
        F.struct(F.col("two").alias("word"), F.col("two_n").alias("n"), F.col("one").alias("other"), F.col("one_n").alias("other_n")))))
    best = both.groupBy("word").agg(F.first("n").alias("n"), F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("best"))
    often = -F.col("best.less") >= TIMES * F.col("n")
    return best.select("word", "n_near", F.when(often, F.col("best.other")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root for words with a form: the last word on its chain, by doubling the steps.

    Each form occurs TIMES as often as its word, so chains are as short as the counts are long in digits.
    """
    links = kept_table(forms.select("word", F.col("form").alias("root")), "links")
    while True:
        onward = links.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = kept_table(links.join(onward, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "links")
        links = step.select("word", "root")
        if step.where("moved").isEmpty():
            return links


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = kept_table(word_counts(docs), "words")
    forms = kept_table(word_forms(words), "forms").withColumnRenamed("word", "f_word")
    ends = roots(forms.where("form IS NOT NULL").withColumnRenamed("f_word", "word")).withColumnsRenamed({"word": "r_word", "root": "r_root"})
    out = words.join(forms, F.col("word") == F.col("f_word"), "left").join(ends, F.col("word") == F.col("r_word"), "left")
    return out.select("word", "form", F.coalesce("r_root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n")

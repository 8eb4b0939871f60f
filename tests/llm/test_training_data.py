"""Each operator against a brute-force version, and on nulls, empty texts, repeats and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from tidewright.llm import (
    arrays, decontaminate, html_text, language_id, near_dedup, quality_model, quality_rules, sharding, source_mix, substring_dedup, text_stats, token_counts,
)
from tidewright.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Extra columns whose names operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, x int, id int, part int, hash int, share int, size int, bucket int, kept int, shard int, row_key int"


def rows(*docs):
    return [(i, t, lang, src, len(t or ""), *[1] * 10) for i, t, lang, src in docs]


def sentence(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    rng = random.Random(3)
    long = sentence(rng, 9000)
    base = sentence(rng, 120)
    docs = rows((1, base, "aa", "s"), (2, base, "aa", "s"), (2, base, "aa", "s"), (3, None, "aa", None), (4, "", None, "s"), (5, " \n\t", "bb", "t"),
                (6, long, "bb", "t"), (7, base + " tail end", None, None), (None, sentence(rng, 80), "aa", "s"), (8, "a", "aa", "s"), (9, "1 2 3", "bb", None), (10, long + " x", "bb", "t"))
    docs.append((None, None, None, None, None, *[None] * 10))
    return spark.createDataFrame(docs, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# --- 1

def test_language_held_out_accuracy(spark, documents):
    got = language_id.held_out_languages(documents)
    right = got.join(documents.select("doc_id", "lang"), "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).head()[0]
    assert right > 0.95
    assert {r.doc_id: r.held_out for r in got.collect()} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _ in texts_of(documents)}


def test_language_odd(odd, none):
    got = language_id.held_out_languages(odd).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got} <= {"aa", "bb", "und"}
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (3, 4, 5, 9))
    assert language_id.held_out_languages(none).count() == 0
    assert {r.lang_pred for r in language_id.language_id(odd, none).collect()} == {"und"}


def test_language_rejects_far_texts(spark):
    rng = random.Random(1)
    train = spark.createDataFrame([(i, sentence(rng, 60, "abc" if i % 2 else "xyz"), "p" if i % 2 else "q") for i in range(80)], "doc_id long, text string, lang string")
    asked = spark.createDataFrame([(1, sentence(rng, 60, "abc")), (2, sentence(rng, 60, "mnk"))], "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.language_id(asked, train).collect()}
    assert got[1].lang_pred == "p" and not got[1].rejected and got[2].rejected


# --- 2, 8

def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    triples = Counter(zip(words, words[1:], words[2:]))
    marked = {i + k for i in range(len(words) - 2) if triples[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(marked)


def test_quality_base_counts(documents, odd):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for docs in (documents, odd):
        got = Counter((r.doc_id, *[r[n] for n in names], r.base_failed) for r in quality_rules.quality_rules(docs).collect())
        want = Counter()
        for i, t in texts_of(docs):
            b = brute_counts(t)
            want[i, *b, b[0] < 50 or 100 * b[4] > 50 * b[0]] += 1
        assert got == want


def test_quality_keeps_clean_and_drops_junk(spark):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_rules.quality_rules(big).where("not base_failed").join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in got}
    assert n.get((1, False), 0) == 0
    assert n.get((0, True), 0) < 0.3 * n.get((0, False), 0)


def test_quality_empty_and_stage(odd, none):
    assert quality_rules.quality_rules(none).count() == 0
    kept = quality_rules.drop_rejected(odd, quality_rules.quality_rules(odd))
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} <= {1, 2, 6, 7, 10, None}


def test_mcd_ignores_half_that_lies_elsewhere():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 1, (600, 3)), rng.normal(50, 1, (400, 3))])
    centre, scatter = quality_rules.mcd(x, np.full(3, 1e-3))
    assert np.abs(centre).max() < 0.3 and np.all(np.diag(scatter) < 3)


def test_quality_model(spark, documents, odd, none):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality_model.quality_scores(documents, labels)
    joined = got.join(labels, "doc_id").where("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).head()[0]
    assert joined > 0.85
    assert {r.doc_id: r.held_out for r in got.collect()} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in texts_of(documents)}
    for marks in (labels, labels.where("quality = 1"), labels.where("false")):
        some = quality_model.quality_scores(odd, marks).collect()
        assert len(some) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in some)
    assert quality_model.quality_scores(none, labels).count() == 0


# --- 3

def test_mix(spark, documents, odd, none):
    got = source_mix.mixed_sources(documents).join(documents.select("doc_id", "source"), "doc_id").collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(WORD.findall(t or ""))) for i, t in texts_of(documents))
    taken, target, sizes = Counter(), {}, Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        sizes[r.source] += r.size
        target[r.source] = r.target
    assert abs(sum(target.values()) - 1.5 * sum(sizes.values())) < 1e-6 * sum(sizes.values())
    assert all(target[s] <= 2 * sizes[s] + 1e-9 and abs(taken[s] - target[s]) <= max(0.05 * target[s], 160) for s in target)
    again = {r.doc_id: r.taken for r in source_mix.mixed_sources(documents.repartition(5)).collect()}
    assert again == {r.doc_id: r.taken for r in got}
    assert source_mix.mixed_sources(odd).count() == odd.count()
    assert all(r.taken <= 2 * r.size for r in source_mix.mixed_sources(odd).collect())
    assert source_mix.mixed_sources(none).count() == 0
    copies = source_mix.mixed_documents(documents)
    assert copies.columns == documents.columns and copies.count() > 0 and source_mix.mixed_documents(none).count() == 0


def test_mix_targets_and_permutations():
    assert source_mix.water_filled([10, 100, 100], [5, 2, 1]) == pytest.approx([20, 590 / 3, 295 / 3])
    assert source_mix.water_filled([10, 50, 100, 0], [5, 2, 1, 5]) == [20.0, 100.0, 120.0, 0.0]
    for n in (1, 2, 7, 64, 1000):
        j = np.arange(n)
        assert sorted(source_mix.permuted(j, np.full(n, n), np.full(n, 9, np.uint64))) == list(range(n))


# --- 4

def brute_classes(texts, threshold=0.8):
    shingles = []
    for _, text in texts:
        w = WORD.findall(text or "")
        shingles.append(Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)]) if w else Counter())
    root = list(range(len(texts)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(texts)):
        for b in range(a):
            common = sum((shingles[a] & shingles[b]).values())
            if common and common >= threshold * (shingles[a].total() + shingles[b].total() - common):
                ra, rb = find(a), find(b)
                root[ra] = rb
    ids = {}
    for a, (i, _) in enumerate(texts):
        ids.setdefault(find(a), []).append(i)
    return {tuple(sorted(v)) for v in ids.values()}


def test_near_duplicates(spark, documents):
    rng = random.Random(5)
    extra, base = [], sentence(rng, 300).split()
    for k in range(60):  # a dense group, larger than a bucket that gives all its pairs
        words = base[:]
        words[rng.randrange(300)] = "changed"
        extra.append((10_000 + k, " ".join(words)))
    docs = documents.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = {}
    for r in near_dedup.near_duplicates(docs).collect():
        got.setdefault(r.class_id, []).append(r.doc_id)
    assert {tuple(sorted(v)) for v in got.values()} == brute_classes(texts_of(docs))
    assert all(min(v) == k for k, v in got.items())


def test_near_duplicates_in_large_buckets(spark):
    """Copies of one text at about the threshold to each other, also over several blocks."""
    rng = random.Random(11)
    base, texts = sentence(rng, 600).split(), []
    for k in range(300):
        # Nine edits: most texts are below the threshold to each other, some share five places and are at 0.803.
        places = rng.sample(range(0, 595, 5), 9)
        if k >= 240:
            places = [*last[:5], *rng.sample(sorted(set(range(0, 595, 5)) - set(last)), 4)] if k % 2 else places
            last = places
        words = base[:]
        for at in places:
            words[at + 4] = f"w{rng.randrange(10 ** 6)}"
        texts.append((k, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = brute_classes(texts)
    assert len(want) > 1 and max(map(len, want)) > 1
    got = {}
    for r in near_dedup.near_duplicates(docs).collect():
        got.setdefault(r.class_id, []).append(r.doc_id)
    assert {tuple(sorted(v)) for v in got.values()} == want


def test_common_counts():
    rng = np.random.default_rng(3)
    sides = [np.unique(rng.integers(0, 2000, (n * 40, 1)) ** 2 // 2000 * 100 + rng.integers(0, n, (n * 40, 1)), axis=0)[:, 0] for n in (30, 20)]
    left, right = [((s // 100).astype(np.uint64), s % 100) for s in sides]
    sets = [[set(u[t == k].tolist()) for k in range(n)] for (u, t), n in ((left, 30), (right, 20))]
    assert near_dedup.common_counts(left, right, 30, 20).tolist() == [[len(a & b) for b in sets[1]] for a in sets[0]]


def test_near_duplicates_odd(odd, none):
    got = near_dedup.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    assert {r.doc_id: r.class_id for r in got if r.doc_id in (1, 2, 7, 10)} == {1: 1, 2: 1, 7: 1, 10: 6}
    kept = near_dedup.one_of_each(odd)
    assert kept.columns == odd.columns
    # Of the two rows without an id, one has words and one has none: both stay.
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 8, 9]
    assert near_dedup.near_duplicates(none).count() == 0 and near_dedup.one_of_each(none).count() == 0


def test_rows_without_ids_and_two_texts_under_one(spark):
    """Null ids and repeated ids are told apart by their texts in all three stages that drop rows."""
    rng = random.Random(21)
    a, b, c, d = (sentence(rng, 200) for _ in range(4))
    near_a = a + " tail"
    docs = [(1, a), (None, near_a), (None, b), (None, b), (None, c), (None, c + " end"), (2, d), (2, b), (None, None), (None, "")]
    df = spark.createDataFrame([(i, t, "en", "s", k) for k, (i, t) in enumerate(docs)], "doc_id long, text string, lang string, source string, n_chars int")
    classes = near_dedup.near_duplicates(df).collect()
    assert len(classes) == 10
    got = Counter((r.doc_id, r.class_id, r.class_size, r.class_key is None) for r in classes)
    assert got == Counter({(1, 1, 2, False): 1, (None, 1, 2, False): 1, (None, 2, 3, False): 2, (2, 2, 3, False): 1,
                           (None, None, 2, False): 2, (2, 2, 1, False): 1, (None, None, 2, True): 2})
    left = [(r.doc_id, r.text) for r in near_dedup.one_of_each(df).collect()]
    assert sorted(map(str, left)) == sorted(map(str, [(1, a), (2, b), (2, d), (None, None), (None, ""), (None, next(t for i, t in left if t in (c, c + " end")))]))

    junk = "word " * 100
    mixed = df.union(spark.createDataFrame([(None, junk, "en", "s", 10), (2, junk, "en", "s", 11)], df.schema))
    verdicts = quality_rules.row_verdicts(mixed)
    kept = {(r.doc_id, r.text) for r in quality_rules.drop_rejected(mixed, verdicts).collect()}
    judged = {(r.doc_id, r.n_words): r.kept for r in verdicts.collect()}
    assert (None, junk) not in kept and (2, junk) not in kept
    assert {(i, t) for i, t in docs if t and judged[i, len(t.split())]} <= kept

    bench = spark.createDataFrame([(7, b)], "item_id long, text string")
    clean = [(r.doc_id, r.text) for r in decontaminate.without_leaks(df, decontaminate.row_leaks(df, bench)).collect()]
    assert sorted(map(str, clean)) == sorted(map(str, [(i, t) for i, t in docs if t != b]))


def test_darts_estimate_similarity():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 2 ** 63, 900).astype(np.uint64), rng.integers(0, 2 ** 63, 100).astype(np.uint64)
    units = np.concatenate([a, a[:800], b])
    owner = np.repeat([0, 1], [900, 900])
    first, second = near_dedup.dart_signatures(units, owner, 2)
    assert abs(np.mean(first == second) - 800 / 1000) < 0.12


# --- 5

def test_decontamination(spark, odd, none):
    rng = random.Random(8)
    items = [(k, sentence(rng, 20 + k, "abcdefghijkl") + ". " + sentence(rng, 6, "abcdefghijkl")) for k in range(12)] + [(90, None), (91, "")]
    docs = [(i, sentence(rng, 300, "abcdefghijkl")) for i in range(40)]
    want = set()
    for k in range(6):
        words = items[k][1].split()
        if k % 2:  # a paraphrase: every sixth word replaced
            words = [w if n % 6 else "zzz" for n, w in enumerate(words)]
        docs.append((100 + k, sentence(rng, 50) + " " + " ".join(words).upper() + " " + sentence(rng, 50)))
        want.add((100 + k, k))
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for blocks in (2048, 5):
        assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench, block_items=blocks).collect()} == want
    assert {r.doc_id for r in decontaminate.without_leaks(df, decontaminate.contaminated(df, bench)).collect()} == set(range(40))
    assert decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.contaminated(odd, bench.where("false")).count() == 0
    assert decontaminate.contaminated(odd, bench).count() == 0


def test_decontamination_recall_of_paraphrases(spark, documents):
    """Every item is planted whole, with a third and with half of its words replaced by words of other texts."""
    rng = random.Random(17)
    bench = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect() if len(r.text.split()) >= 10]
    assert len(items) >= 100
    pool = [w for r in documents.select("text").collect() for w in r.text.split()]
    planted, want = [], {}
    for share in (0.0, 1 / 3, 0.5):
        for item, text in items:
            words = text.split()
            for place in rng.sample(range(len(words)), round(share * len(words))):
                words[place] = rng.choice(pool)
            want[1_000_000 + len(planted)] = (share, item)
            planted.append((1_000_000 + len(planted), " ".join(rng.choices(pool, k=90) + words + rng.choices(pool, k=90))))
    plain = [(2_000_000 + k, " ".join(rng.choices(pool, k=250))) for k in range(300)]  # the same words, no item
    docs = documents.select("doc_id", "text").union(spark.createDataFrame(planted + plain, "doc_id long, text string"))
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    for share in (0.0, 1 / 3, 0.5):
        mine = [(d, i) for d, (s, i) in want.items() if s == share]
        assert sum(pair in found for pair in mine) >= 0.9 * len(mine), share
    assert not {d for d, _ in found if d >= 2_000_000}


def test_heaviest_subsequence():
    rng = np.random.default_rng(6)
    for _ in range(40):
        a, b, w = rng.integers(0, 6, 12), rng.integers(0, 6, 20), rng.random(12)
        table = np.zeros((13, 21))
        for i in range(12):
            for j in range(20):
                table[i + 1, j + 1] = max(table[i, j + 1], table[i + 1, j], table[i, j] + w[i] if a[i] == b[j] else 0)
        assert np.isclose(decontaminate.heaviest_subsequence(a, w, b), table[-1, -1])


def test_decontamination_of_long_items(spark):
    """Parts of long items, whole ones, and ones with a third of the words replaced, in one block or several."""
    rng = random.Random(9)
    items = [(k, sentence(rng, n, "abcdefghijkl") + ". " + sentence(rng, 6, "abcdefghijkl")) for k, n in enumerate((300, 300, 700, 900, 300, 700))]
    docs, want = [(i, sentence(rng, 900, "abcdefghijkl")) for i in range(10)], set()
    for k, text in items:
        words = text.split()
        words = words[60:160] if k < 2 else words if k < 4 else [w if n % 3 else f"z{rng.randrange(10 ** 6)}" for n, w in enumerate(words)]
        if k >= 4:
            words[-6:] = text.split()[-6:]
        docs.append((100 + k, " ".join([sentence(rng, 200), *words, sentence(rng, 200)])))
        want.add((100 + k, k))
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for blocks in (2048, 2):
        assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench, block_items=blocks).collect()} == want


def test_common_subsequence():
    rng = random.Random(4)
    for _ in range(50):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(1, 30))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common_subsequence(np.array(a), np.array(b)) == table[-1][-1]


# --- 6

@pytest.mark.parametrize("limit", [1 << 30, 60_000, 3000, 1])
def test_sharding_equals_sql(documents, limit):
    assert compare(sharding.extendible_shards(documents, limit), connect(SF), sharding.extendible_shards_sql(limit)) == []


def test_sharding_odd(odd, none):
    got = sharding.extendible_shards(odd, 2000).collect()
    assert len(got) == odd.count() and sum(r.n_bytes for r in got) == sum(len((t or "").encode()) for _, t in texts_of(odd))
    assert sharding.extendible_shards(none).count() == 0


# --- 7

def brute_substrings(texts):
    docs, first, out = sorted(((i, (t or "").encode()) for i, t in texts), key=lambda d: (d[0] is None, d[0] or 0)), {}, Counter()
    for i, b in docs:
        for p in range(len(b) - 49):
            first.setdefault(b[p:p + 50], i)
    for i, b in docs:
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] != i:
                gone[p:p + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i, len(b), sum(gone), (b"\0" + bytes(gone)).count(b"\0\1"), hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("settings", [{}, {"hot": 1, "bucket_bytes": 40_000}])
def test_substring_dedup(documents, odd, settings):
    for docs in (documents, odd):
        assert Counter(tuple(r) for r in substring_dedup.substring_dedup(docs, **settings).collect()) == brute_substrings(texts_of(docs))


def test_substring_dedup_periodic_and_empty(spark, none):
    texts = [(1, "ab" * 60), (2, "xab" + "ab" * 50 + "y"), (3, "é" * 80), (4, "é" * 24), (5, "z" + "é" * 30), (6, "short"), (7, "q" * 49), (8, "q" * 49)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert Counter(tuple(r) for r in substring_dedup.substring_dedup(df).collect()) == brute_substrings(texts)
    assert substring_dedup.substring_dedup(none).count() == 0


def test_repeated_windows_by_transform():
    rng = random.Random(6)
    base = "".join(rng.choice("ab ") for _ in range(400)).encode()
    texts = [base[p:p + rng.randint(50, 90)] for p in (rng.randrange(300) for _ in range(40))]
    doc = np.array([rng.randrange(12) for _ in texts])
    least = {}
    for t, d in zip(texts, doc, strict=True):
        for p in range(len(t) - 49):
            least[t[p:p + 50]] = min(least.get(t[p:p + 50], 99), d)
    got = substring_dedup.repeated_windows(texts, doc)
    assert [list(g) for g in got] == [[p for p in range(len(t) - 49) if least[t[p:p + 50]] < d] for t, d in zip(texts, doc, strict=True)]


# --- 9

def test_html_text():
    page = """<html><head><title>T</title></head><body><header>Site</header><nav><a href=x>A</a></nav><div class="cookie-notice">We use cookies</div><article><h1>Head &amp; tail</h1>
    <p>A  long <b>first</b> paragraph,<br>with text that goes on and on for a while.<p>Short.</p><div class="ad">Buy now</div><p>Another long paragraph with <a href=y>a link</a> and more text to read.<form><input><button>Go</button></form></article>
    <aside>More</aside><section id="comments"><p>first! a reader comment that is long enough to look like text</p></section><footer>f</footer><script>var a = "<p>x</p>";</script></body></html>"""
    assert html_text.main_text(page) == ("Head & tail\nA long first paragraph, with text that goes on and on for a while.\nShort.\nAnother long paragraph with a link and more text to read.")
    assert html_text.main_text(page.replace("article", 'div')) == html_text.main_text(page)
    for broken in (None, "", "<", "<p", "<!-- x", "<p>a<script>b", "&#x110000; &nosuch; <p>", "</p></div>text"):
        assert isinstance(html_text.main_text(broken), str)
    assert html_text.main_text("</p></div>text") == "text"


def test_html_keeps_parts_of_the_article():
    long = "A paragraph with text that goes on and on for quite a while, as running text does. " * 3
    page = f"""<html><body><nav class="navbar"><a href=x>A</a></nav><article><h2 id="search">Search</h2><p>{long}</p><div class="table-responsive"><table><tr><td>cell one</td></tr></table></div>
    <section id="discussion"><h3>Discussion</h3><p>{long}</p></section><section id="related-work"><p>{long}</p></section><div id="navigation-system"><p>{long}</p></div><div class="ad-box">Buy</div></article></body></html>"""
    text = " ".join(long.split())
    assert html_text.main_text(page) == "\n".join(["Search", text, "cell one", "Discussion", text, text, text])


def test_html_keeps_a_lead_and_sibling_articles():
    long, lead = "Text of the story that goes on and on for quite a while, as it does. " * 3, "The lead of the story says what the rest of it tells. " * 4
    text = " ".join(long.split())
    page = f"<html><body><div class='menu'><a href=x>A</a></div><div><div><p>{lead}</p></div><div>{f'<p>{long}</p>' * 12}</div></div></body></html>"
    assert html_text.main_text(page) == "\n".join([" ".join(lead.split()), *[text] * 12])
    two = f"<html><body><nav><a href=x>A</a></nav><article><p>{long}</p></article><article><p>{long}</p></article><footer>f</footer></body></html>"
    assert html_text.main_text(two) == "\n".join([text, text])


def test_html_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x é</p>", 5), (1, "u", "<p>x é</p>", 5), (None, None, None, None)], "page_id long, url string, html string, text int")
    got = html_text.page_texts(pages).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "", 0), (1, "x é", 3), (1, "x é", 3)]
    assert html_text.page_texts(pages.where("false")).count() == 0


# --- 10

def test_token_histogram(spark, documents, odd, none):
    for docs in (documents, odd):
        lengths = [len(token_counts.encoder(token_counts.VOCABULARY).encode_ordinary(t or "")) for _, t in texts_of(docs)]
        histogram = token_counts.length_histogram(token_counts.encoded_lengths(docs))
        got = {r.n_tokens: r for r in histogram.collect()}
        assert {n: r.n_docs for n, r in got.items()} == Counter(lengths)
        for n, r in got.items():
            assert (r.docs_at_least, r.tokens_at_least) == (sum(x >= n for x in lengths), sum(x for x in lengths if x >= n))
            assert r.truncated_total == sum(min(x, n) for x in lengths)
        for r in token_counts.at_limits(histogram, [0, 7, 300, 10 ** 6]).collect():
            assert (r.docs_longer, r.truncated_total) == (sum(x > r.limit for x in lengths), sum(min(x, r.limit) for x in lengths))
        assert token_counts.length_at(histogram, 0.5).head()[0] == sorted(lengths)[(len(lengths) + 1) // 2 - 1]
    assert token_counts.length_histogram(token_counts.encoded_lengths(none)).count() == 0


# --- all

def test_queries_have_rows_and_twins(spark):
    con = connect(SF)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    for name, sql in ORACLE_SQL.items():
        assert compare(QUERIES[name](spark, SF), con, sql) == []


def test_spans_and_hashes():
    data = np.frombuffer(b"ab ab\tcab", np.uint8)
    starts, ends, of = arrays.word_spans(data, np.array([0, 2, 9]))
    assert (starts.tolist(), ends.tolist(), of.tolist()) == ([0, 3, 6], [2, 5, 9], [0, 1, 3])
    hashes = arrays.span_hashes(data, starts, ends)
    assert hashes[0] == hashes[1] != hashes[2]
    assert text_stats.count_batch(pa.array(["a b", None]))["n_words"].tolist() == [2, 0]


def test_shuffles_of_a_kept_table_are_dropped(spark):
    import time

    from tidewright.llm.common import DROP_SHUFFLES, kept_table
    files = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+\.data", spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")))
    before, setting = files(), spark.conf.get(DROP_SHUFFLES)
    rows = spark.range(5000).groupBy((F.col("id") % 999).alias("k")).count()
    kept = kept_table(rows, "counts")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(DROP_SHUFFLES) == setting
    assert kept.agg(F.sum("count")).first()[0] == 5000 and rows.count() == 999

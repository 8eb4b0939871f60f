"""License scan, source divergence and spelling variants: SQL twins, brute force, odd tables."""

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from oracle import compare, connect

from tidewright.llm import divergence, licenses, spelling

SF = "/root/testdata/sf0.001"
# Extra columns whose names the operators use inside.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row int, template int, place int, diagonal int, words int, found int, "
          "label string, p int, q int, n int, term string, block int, low int, kept int, word string, form string, key int, other int")


def rows(*docs):
    return [(i, t, lang, src, len(t or ""), *[1] * 6, "x", *[1] * 3, "y", *[1] * 3, "v", "w", 1, 1) for i, t, lang, src in docs]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns, text beyond ASCII."""
    rng = random.Random(11)
    long = " ".join(rng.choice(["license", "mit", "cc", "by", "the", "apache", "öffentlichkeit"]) for _ in range(9000))
    notice = "Released under the MIT License. All rights reserved."
    docs = rows((1, notice, "aa", "s"), (1, notice, "aa", "s"), (2, None, "aa", None), (3, "", None, "s"), (4, " \n.\t", "aa", "t"), (5, long, "aa", "t"),
                (None, "cc-by CC BY cc  by", None, None), (None, "cc-by CC BY cc  by", None, None), (6, "MİT LICENSE mit\u0000license", "bb", "z"), (7, "one", "bb", ""),
                (8, "gnu " * 40 + "general public license", "aa", "z"), (9, "x" * 70000, "cc", "s"), (10, "Öffentlichkeit öffentlichkeit offentlichkeit " * 12, "aa", "s"))
    docs.append((None,) * 23)
    return spark.createDataFrame(docs, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def twin(df):
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text", "lang", "source").toArrow())
    return con


# --- 11

def test_license_scan_equals_sql(spark, odd, none):
    sql = licenses.license_scan_sql()
    assert compare(licenses.license_scan(spark.read.parquet(f"{SF}/documents.parquet")), connect(SF), sql) == []
    assert compare(licenses.license_scan(odd), twin(odd), sql) == []
    assert licenses.license_scan(none).count() == 0


def brute_base(text):
    words = [w for w in re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))]
    places = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_license_base_equals_brute_force(spark, odd):
    for df in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        want = Counter((r.doc_id, *brute_base(r.text)) for r in df.select("doc_id", "text").collect())
        assert Counter(tuple(r)[:6] for r in licenses.license_scan(df).collect()) == want


def test_license_bodies_with_edits(spark):
    body = next(text for text, label in licenses.NOTICES if text.startswith("Permission is hereby granted, free"))
    words = body.split()
    cut = " ".join(w for i, w in enumerate(words) if i % 30 != 7)
    put_in = " ".join(w + (" indeed" if i % 25 == 3 else "") for i, w in enumerate(words))
    half = " ".join(words[:len(words) // 2])
    shuffled = " ".join(random.Random(1).sample(words, len(words)))
    texts = [body, cut, put_in, half, shuffled, "Before. " + put_in.upper() + " after", "Licensed under CC BY-NC 4.0.", "Licensed, under CC BY 4.0; all rights are reserved", "all rights reserved"]
    got = {r.doc_id: r for r in licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].labels for i in range(9)] == ["mit", "mit", "mit", "", "", "mit", "cc-by,cc-by-nc-4.0", "cc-by,cc-by-4.0", "all-rights-reserved"]
    assert got[0].score == 1.0 and 0.8 <= got[1].score < 1.0 and 0.8 <= got[2].score < 1.0 and got[3].score == 0.0
    spans = licenses.license_spans(spark.createDataFrame([(1, "a b c mit license " + body)], "doc_id long, text string")).collect()
    assert {(r.label, r.strict, r.first_word) for r in spans} == {("mit", True, 3), ("mit", False, 5)}


def test_license_own_templates_and_plan(spark):
    own = [licenses.template("alpha beta gamma", "abc"), licenses.template("beta gamma", "bc", strict=True)]
    df = spark.createDataFrame([(1, "alpha beta gamma beta gamma"), (2, "alpha gamma")], "doc_id long, text string")
    assert {(r.doc_id, r.n_base, r.labels) for r in licenses.license_scan(df, own).collect()} == {(1, 2, "abc,bc"), (2, 0, "")}
    with pytest.raises(ValueError):
        licenses.template("one", "x")
    plan = licenses.license_scan(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ExistingRDD" not in plan.split("BroadcastExchange")[-1]


# --- 12

def test_divergence_equals_sql(spark, odd, none):
    for least in (30, 2):
        assert compare(divergence.source_divergence(spark.read.parquet(f"{SF}/documents.parquet"), least), connect(SF), divergence.source_divergence_sql(least)) == []
    for least in (30, 1):
        assert compare(divergence.source_divergence(odd, least), twin(odd), divergence.source_divergence_sql(least)) == []
    assert divergence.source_divergence(none).count() == 0


def test_divergence_in_many_cells(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100)]
    docs = [(i, " ".join(rng.choices(words, k=30)), "l" + str(i % 3 > 0), f"s{i % 40}" if i % 50 else "lonely") for i in range(900)]
    df = spark.createDataFrame(docs + [(900, "", "l1", "empty"), (901, None, "l2", "a"), (902, None, "l2", "b")], "doc_id long, text string, lang string, source string")
    monkeypatch.setattr(divergence, "GROUP_BLOCK", 7)
    monkeypatch.setattr(divergence, "TERM_BLOCK", 9)
    assert compare(divergence.source_divergence(df, 5, 3), twin(df), divergence.source_divergence_sql(5, 3)) == []


def test_shares_are_exact_beyond_long(spark):
    from pyspark.sql import functions as F
    n, total, kept = 123_456_789_012_345, 987_654_321_098_765_432, 1_000_003
    got = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(kept)).alias("p")).first().p
    assert got == 1 + 1_000_000_000 * (n + 5) // (total + 5 * kept)


# --- 13

def brute_variants(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if code % 31 == 0:
                word = word[:code % len(word)] + word[code % len(word) + 1:]
            counts[word] += len(word) >= 7
    n_of = {w: n for w, n in counts.items() if n >= 2}
    letters = sorted(set("".join(n_of)))
    form, near = {}, {}
    for w in n_of:
        made = {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + x + w[i:] for i in range(len(w) + 1) for x in letters} | {w[:i] + x + w[i + 1:] for i in range(len(w)) for x in letters}
        near[w] = [x for x in made if x in n_of and x != w]
        best = min(near[w], key=lambda x: (-n_of[x], x), default=None)
        if best and n_of[best] >= 10 * n_of[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {(w, form.get(w), root(w), n, len(near[w]), n_of[form[w]] if w in form else None) for w, n in n_of.items()}


def check_variants(df):
    got = [tuple(r) for r in spelling.spelling_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got)) and set(got) == brute_variants([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    return got


def test_spelling_equals_brute_force(spark, odd, none):
    check_variants(spark.read.parquet(f"{SF}/documents.parquet"))
    check_variants(odd)
    assert spelling.spelling_variants(none).count() == 0


def test_spelling_of_dense_and_repetitive_words(spark):
    rng = random.Random(8)
    # Few letters: equal bigrams within a word, ties in the order, edits at both ends and in the middle.
    words = ["".join(rng.choice("abß"[:k]) for _ in range(rng.randint(7, 9))) for k in (1, 2, 2, 3) for _ in range(250)] + ["a" * n for n in range(7, 14)] + ["ab" * 40, "ab" * 39 + "a", "b" + "ab" * 39]
    text = [(i, " ".join(rng.choices(words, weights=[1 + 400 * (k % 37 == 0) for k in range(len(words))], k=700))) for i in range(60)]
    got = check_variants(spark.createDataFrame(text, "doc_id long, text string"))
    assert sum(r[1] is not None for r in got) > 50


def test_spelling_chains(spark):
    text = [(i, " ".join(["letters"] * 900 + ["lettersa"] * 30 + ["lettersab"] + ["lettersabc"] * (i in (1, 2)))) for i in range(30)]
    got = check_variants(spark.createDataFrame(text, "doc_id long, text string"))
    assert sum(r[2] == "letters" != r[0] for r in got) >= 3
    assert any(r[0] == "lettersabc" and r[1] == "lettersab" and r[2] == "letters" for r in got)


def test_pivots_are_disjoint_and_rare():
    assert spelling.pivots([5, 1, 9, 9, 2, 7], 3) == (1, 4, 2)
    rng = random.Random(2)
    for _ in range(200):
        ranks = [rng.randint(0, 30) for _ in range(rng.randint(6, 15))]
        middle = (len(ranks) + 1) // 2
        first, second, end = spelling.pivots(ranks, middle)
        assert first + 2 <= middle <= second and end == max(min(ranks[:middle - 1]), min(ranks[middle:])) == max(ranks[first], ranks[second])

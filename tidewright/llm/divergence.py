"""Source divergence audit: exact distances between the term shares of all sources of a language.

Terms are runs of ASCII letters and of all characters beyond ASCII, lower-cased in A-Z only.
A language keeps the terms that at least ``min_docs`` of its documents hold. With n the count
of a kept term in a group (language and source), N the group's sum over the V kept terms and
M the same for the language, a term's share is the whole number
p = 1 + floor(10^9 (n + 5) / (N + 5 V)), worked out in decimals. The distance of two groups is
the sum of |p - q| over all kept terms; a group's marked terms are those with p above the
language's q.

The pairs are a cube: sources are hashed to blocks of about GROUP_BLOCK, terms to blocks of
about TERM_BLOCK, and a task owns a cell (block, block, term block). Each slice of counts is
replicated to the cells that need it, once per block of sources, with a row that names each
group; a cell adds up its part of each pair over the terms that occur in it, and the parts are
summed along the term axis. Kept terms that no group of the two blocks holds never enter a
cell: they are V less the cells' terms, and each adds the distance of the shares of a count of 0.

A cell holds at most its blocks whatever the corpus, hot sources included: counts are summed
inside the batches and again before each shuffle, and terms spread by hash. One row per
language and per group is joined from written tables, so Spark broadcasts them by their size
or else sorts. The pairs of a language are part of the result; they are made cell by cell.

Nulls: a null text, language or source is read as ''. Groups without terms are compared as
well (all counts 0); if a language keeps no term its distances are 0. Repeated rows count
each. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import kept_table, per_batch

MIN_DOCS, TOP = 30, 50
SCALE, PRIOR = 1_000_000_000, 5
GROUP_BLOCK, TERM_BLOCK = 16, 4096

#: A term in UTF-8 bytes whose A-Z are lower-cased.
TERM = re.compile(rb"[a-z\x80-\xff]+")


def read_groups(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def count_terms(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Occurrences and documents of each term and group of a batch."""
    counts: dict[tuple, Counter] = defaultdict(Counter)
    docs: dict[tuple, Counter] = defaultdict(Counter)
    texts = batch.column("text").cast(pa.large_string()).cast(pa.large_binary()).to_pylist()
    for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts, strict=True):
        found = Counter(TERM.findall(text.lower()))
        counts[lang, source].update(found)
        docs[lang, source].update(found.keys())
    langs, sources, terms, n, n_docs = [], [], [], [], []
    for group, found in counts.items():
        langs += [group[0]] * len(found)
        sources += [group[1]] * len(found)
        terms += found.keys()
        n += found.values()
        held = docs[group]
        n_docs += [held[t] for t in found]
    arrays = [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(n_docs, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "docs"])


def kept_terms(texts: DataFrame, min_docs: int) -> DataFrame:
    """lang, source, term, n, n_lang of the terms that enough documents of the language hold."""
    counts = texts.mapInArrow(per_batch(count_terms), "lang string, source string, term string, n long, docs long").groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    summed = counts.withColumns({"n_lang": F.sum("n").over(term), "docs_lang": F.sum("docs").over(term)})
    return summed.where(F.col("docs_lang") >= min_docs).select("lang", "source", "term", "n", "n_lang")


def share(count: Column, total: Column, kept: Column) -> Column:
    """p of a count, exact; null where nothing is kept."""
    above = (count + PRIOR).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (total + PRIOR * kept).cast("decimal(20,0)")
    return F.when(kept > 0, 1 + F.call_function("div", above, below))


def group_table(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """A row per group: lang, source, total, kept (V), lang_total, blocks and block of sources, term blocks, p of a count of 0."""
    names = texts.select("lang", "source").distinct()
    totals = terms.groupBy("lang", "source").agg(F.sum("n").alias("total")).withColumnsRenamed({"lang": "t_lang", "source": "t_source"})
    per_lang = terms.select("lang", "term", "n_lang").distinct().groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n_lang").alias("lang_total")).withColumnRenamed("lang", "k_lang")
    sizes = names.groupBy("lang").agg(F.count("*").alias("sources")).withColumnRenamed("lang", "s_lang")
    zero = F.lit(0).cast("bigint")
    rows = names.join(totals, (F.col("lang") == F.col("t_lang")) & (F.col("source") == F.col("t_source")), "left").join(
        per_lang, F.col("lang") == F.col("k_lang"), "left").join(sizes, F.col("lang") == F.col("s_lang"))
    rows = rows.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "kept", "lang_total")], F.ceil(F.col("sources") / GROUP_BLOCK).alias("blocks"))
    return rows.withColumns({
        "block": F.pmod(F.xxhash64("source"), F.col("blocks")),
        "term_blocks": F.greatest(F.lit(1), F.ceil(F.col("kept") / TERM_BLOCK)),
        "p_zero": F.coalesce(share(zero, F.col("total"), F.col("kept")), zero),
    })


def replicated(rows: DataFrame) -> DataFrame:
    """Each row once per cell of its block: with itself and every other block of the language."""
    each = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    return each.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other")


def cell_distances(cell: pa.Table) -> pa.Table:
    """Partial distances of the pairs of one cell, and the number of terms they cover."""
    schema = pa.schema([("lang", pa.string()), ("one", pa.string()), ("two", pa.string()), ("part", pa.int64()), ("terms", pa.int64())])
    source = cell["source"].combine_chunks().dictionary_encode()
    term = cell["term"].combine_chunks().dictionary_encode()
    names = source.dictionary.to_pylist()
    of = source.indices.to_numpy()
    shares = np.zeros((len(names), len(term.dictionary)), np.int64)
    block = np.zeros(len(names), np.int64)
    block[of] = cell["block"].to_numpy()
    shares[of] = cell["p_zero"].to_numpy()[:, None]
    held = term.indices.is_valid().to_numpy(zero_copy_only=False)  # the others only name a group
    shares[of[held], term.indices.drop_null().to_numpy()] = cell["p"].to_numpy()[held]
    low, high = cell["low"][0].as_py(), cell["high"][0].as_py()
    rows = []
    for i in np.flatnonzero(block == low):
        for j in np.flatnonzero(block == high):
            if low < high or names[i].encode() < names[j].encode():
                one, two = sorted((names[i], names[j]), key=str.encode)
                rows.append((one, two, int(np.abs(shares[i] - shares[j]).sum())))
    n = len(rows)
    one, two, part = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table([pa.array([cell["lang"][0].as_py()] * n, pa.string()), pa.array(one, pa.string()), pa.array(two, pa.string()),
                     pa.array(part, pa.int64()), pa.array([shares.shape[1]] * n, pa.int64())], schema=schema)


def pair_distances(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, one, two, distance of every pair of sources of a language, one before two."""
    columns = ["lang", "source", "blocks", "block", "term_block", "term", "p", "p_zero"]
    own = rows.withColumn("term_block", F.pmod(F.xxhash64("term"), F.col("term_blocks"))).select(columns)
    # Every group takes part in all its cells, also where it has none of the terms.
    named = groups.withColumns({"term_block": F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("term_blocks") - 1)), "term": F.lit(None).cast("string"), "p": F.col("p_zero")})
    slices = replicated(own.unionByName(named.select(columns)))
    parts = slices.select("lang", "source", "block", "low", "high", "term_block", "term", "p", "p_zero").groupBy("lang", "low", "high", "term_block").applyInArrow(
        cell_distances, "lang string, one string, two string, part long, terms long")
    summed = parts.groupBy("lang", "one", "two").agg(F.sum("part").alias("part"), F.sum("terms").alias("terms")).withColumnsRenamed({"lang": "p_lang", "one": "p_one", "two": "p_two"})
    side = replicated(groups.select("lang", "source", "blocks", "block", "p_zero", "kept"))
    first = side.where(F.col("block") == F.col("low")).select("lang", "low", "high", "kept", F.col("source").alias("a"), F.col("p_zero").alias("a_zero"))
    second = side.where(F.col("block") == F.col("high")).select(
        F.col("lang").alias("b_lang"), F.col("low").alias("b_low"), F.col("high").alias("b_high"), F.col("source").alias("b"), F.col("p_zero").alias("b_zero"))
    pairs = first.join(second, (F.col("lang") == F.col("b_lang")) & (F.col("low") == F.col("b_low")) & (F.col("high") == F.col("b_high")) & ((F.col("low") < F.col("high")) | (F.col("a") < F.col("b"))))
    pairs = pairs.select("lang", F.least("a", "b").alias("one"), F.greatest("a", "b").alias("two"), "kept", F.abs(F.col("a_zero") - F.col("b_zero")).alias("zero"))
    both = pairs.join(summed, (F.col("lang") == F.col("p_lang")) & (F.col("one") == F.col("p_one")) & (F.col("two") == F.col("p_two")), "left")
    nothing = F.lit(0).cast("bigint")
    unseen = F.col("kept") - F.coalesce("terms", nothing)
    return both.select("lang", "one", "two", (F.coalesce("part", nothing) + unseen * F.col("zero")).alias("distance"))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank: distances to all other
    sources of the language, and the ``top`` terms a group uses more than its language."""
    texts = read_groups(docs)
    terms = kept_table(kept_terms(texts, min_docs), "kept-terms")
    groups = kept_table(group_table(texts, terms), "groups")
    own = groups.withColumnsRenamed({"lang": "g_lang", "source": "g_source"})
    rows = terms.join(own, (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("g_source"))).withColumns({
        "p": share(F.col("n"), F.col("total"), F.col("kept")), "q": share(F.col("n_lang"), F.col("lang_total"), F.col("kept"))})
    pairs = pair_distances(rows, groups)
    pairs = pairs.select("lang", "distance", F.inline(F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item")), F.struct(F.col("two").alias("source"), F.col("one").alias("item")))))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.col("distance").alias("value")).withColumn("rank", F.row_number().over(order))
    marked = rows.where(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    marked = marked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(marked)


def source_divergence_sql(min_docs: int = MIN_DOCS, top: int = TOP) -> str:
    """DuckDB twin over ``documents``: every pair of groups over every kept term."""
    def p(count: str, total: str) -> str:
        return f"1 + CAST(({SCALE}::HUGEINT * ({count} + {PRIOR})) // ({total} + {PRIOR} * v) AS BIGINT)"

    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), w AS (SELECT row, lang, source, unnest(words) AS term FROM d
), k AS (SELECT lang, term, count(*) AS n_lang FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= {min_docs}
), l AS (SELECT lang, count(*) AS v, CAST(sum(n_lang) AS BIGINT) AS n_all FROM k GROUP BY lang
), c AS (SELECT w.lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY w.lang, source, term
), g AS (SELECT lang, source, coalesce(v, 0) AS v, n_all FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN l USING (lang)
), t AS (SELECT lang, source, CAST(sum(n) AS BIGINT) AS n_group FROM c GROUP BY lang, source
), x AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, {p("coalesce(n, 0)", "coalesce(n_group, 0)")} AS p, {p("n_lang", "n_all")} AS q
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS one, y.source AS two, sum(abs(x.p - y.p)) AS value
             FROM x JOIN x y ON x.lang = y.lang AND x.term = y.term GROUP BY x.lang, x.source, y.source) s
    ON s.lang = a.lang AND one = a.source AND two = b.source
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, p - q, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS INTEGER)
  FROM x WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {top}
"""

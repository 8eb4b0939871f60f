"""License scan by diagonal voting: word k-grams of the texts joined to template positions.

Every text becomes words, and the hashes of all its rolling word grams (SHORT_GRAM words for
templates under LONG_WORDS words, else LONG_GRAM) are joined to the grams of the templates.
A hit of word p with template place t votes for the diagonal p - t: an exact copy puts all
its votes on one diagonal, a copy with words put in or left out on neighbouring ones. Votes
are summed by row, template and diagonal, diagonals of one template at most ``slack`` apart
(an eighth of the template's words, at least 1) are merged, and a merged span is verified:
the template's words that its hits cover must be at least SHARE of the template and of the
span. Of verified spans that overlap, the one that covers most words stays (ties: larger
share, earlier template), so a notice is not also its near relative. Phrases are the strict
templates: one diagonal, every gram of it; they all stay.

Only DataFrame functions: the grams of the templates are a list given by the caller, a row
per word of it, so their broadcast is bounded by that list and not by the data; all hits of a
row are shuffled once, by row, and every row sends one marker along, so rows without a hit
need no second pass. A row's hits are bounded by its own length.

Lower case is A-Z only. Nulls: a null text has no words, and neither has an empty one; such
rows return 0 words, no places, empty label texts and score 0. A null ``doc_id`` stays null.
Repeated rows are judged and returned each. Other columns are ignored. An empty table gives
no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHORT_GRAM, LONG_GRAM, LONG_WORDS = 2, 4, 10
SHARE = 0.8
#: Score of a text that only names a license; a verified notice or body scores the share it covers.
NAMED = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and labels that must be found exactly.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Wording of public licenses and notices.
NOTICES = [
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("Released under the MIT License", "mit"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3.0"),
    ("This work is licensed under the GNU General Public License, version 2", "gpl-2.0"),
    ("Licensed under CC BY 4.0", "cc-by-4.0"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa-4.0"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc-4.0"),
    ("Licensed under CC BY-ND 4.0", "cc-by-nd-4.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc-4.0"),
    ("All rights reserved", "all-rights-reserved"),
    ("SPDX-License-Identifier: Apache-2.0", "apache-2.0"),
    ("SPDX-License-Identifier: MIT", "mit"),
    ("SPDX-License-Identifier: GPL-3.0-only", "gpl-3.0"),
    ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3.0"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
     "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
     "permit persons to whom the Software is furnished to do so, subject to the following conditions", "mit"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
     "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by "
     "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
     "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
     "governing permissions and limitations under the License", "apache-2.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
     "version", "gpl-3.0"),
    ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
     "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
     "details", "gpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met", "bsd"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/", "mpl-2.0"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
]


@dataclass(frozen=True)
class Template:
    """Words to look for; ``strict`` ones count at every exact place and only there."""
    words: tuple[str, ...]
    label: str
    strict: bool

    @property
    def gram(self) -> int:
        return SHORT_GRAM if len(self.words) < LONG_WORDS else LONG_GRAM

    @property
    def slack(self) -> int:
        return 0 if self.strict else max(1, len(self.words) // 8)


def template(text: str, label: str, strict: bool = False) -> Template:
    lowered = text.translate(str.maketrans(UPPER, LOWER))
    words = tuple(w for w in re.split(SEPARATORS, lowered) if w)
    if len(words) < SHORT_GRAM:
        raise ValueError(f"a template needs {SHORT_GRAM} words: {text!r}")
    return Template(words, label, strict)


def standard_templates() -> list[Template]:
    return [template(text, label, True) for text, label in PHRASES] + [template(text, label) for text, label in NOTICES]


def words_of(text: Column) -> Column:
    """Words of a text, an empty array for a null one."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def gram_hash(words: list[Column]) -> Column:
    return F.xxhash64(F.lit(len(words)), *words)


def rolling_hashes(words: Column, gram: int) -> Column:
    """Hash of each run of ``gram`` neighbouring words."""
    places = F.sequence(F.lit(0), F.size(words) - gram)
    each = F.transform(places, lambda i: gram_hash([words[i + k] for k in range(gram)]))
    return F.when(F.size(words) >= gram, each).otherwise(F.array().cast("array<bigint>"))


def template_grams(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """A row per template and place: wanted (hash), template, place, gram, n_template, slack, label, strict;
    and the marker that every row of the input meets (wanted 0, template -1)."""
    def row(wanted: Column, number: int, place: int, gram: int, size: int, slack: int, label: str, strict: bool) -> Column:
        return F.struct(wanted.alias("wanted"), *[F.lit(v).alias(n) for v, n in (
            (number, "template"), (place, "place"), (gram, "gram"), (size, "n_template"), (slack, "slack"), (label, "label"), (strict, "strict"))])

    rows = [row(F.lit(0).cast("bigint"), -1, 0, 0, 0, 0, "", False)]
    for number, t in enumerate(templates):
        for place in range(len(t.words) - t.gram + 1):
            wanted = gram_hash([F.lit(w) for w in t.words[place:place + t.gram]])
            rows.append(row(wanted, number, place, t.gram, len(t.words), t.slack, t.label, t.strict))
    return spark.range(1).select(F.inline(F.array(*rows)))


def gram_hits(docs: DataFrame, templates: list[Template]) -> DataFrame:
    """A row per word gram of a text that a template holds, and one marker per row of ``docs``.

    Grams of both lengths are one array per text: first the short ones, then the long ones,
    then the marker. ``row`` tells rows of ``docs`` apart, whatever their ids.
    """
    texts = docs.select(F.col("doc_id"), F.monotonically_increasing_id().alias("row"), words_of(F.col("text")).alias("words"))
    grams = texts.select(
        "doc_id", "row", F.size("words").cast("bigint").alias("n_words"),
        F.concat(rolling_hashes(F.col("words"), SHORT_GRAM), rolling_hashes(F.col("words"), LONG_GRAM), F.array(F.lit(0).cast("bigint"))).alias("grams"))
    # The arrays are never empty; the outer form spares a filter that would compute them twice.
    found = grams.select("doc_id", "row", "n_words", F.posexplode_outer("grams").alias("at", "found"))
    hits = found.join(F.broadcast(template_grams(docs.sparkSession, templates)), F.col("found") == F.col("wanted"))
    n_short = F.greatest(F.col("n_words") - (SHORT_GRAM - 1), F.lit(0))
    word = F.when(F.col("gram") == LONG_GRAM, F.col("at") - n_short).otherwise(F.col("at"))
    return hits.select("row", "doc_id", "n_words", "template", "place", "gram", "n_template", "slack", "label", "strict", (word - F.col("place")).alias("diagonal"))


def verified_spans(hits: DataFrame) -> DataFrame:
    """Merged diagonals with their span of words and the share of the template they cover, and the markers.

    ``hits`` lie in one partition per row, so neither the sums nor the window shuffle again.
    """
    key = ["row", "doc_id", "n_words", "template", "gram", "n_template", "slack", "label", "strict"]
    diagonals = hits.groupBy(*key, "diagonal").agg(F.collect_list("place").alias("places"))
    before = Window.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(before)
    parted = diagonals.withColumn("parted", F.when((gap <= F.col("slack")), 0).otherwise(1))
    chains = parted.withColumn("chain", F.sum("parted").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    spans = chains.groupBy(*key, "chain").agg(
        F.flatten(F.collect_list("places")).alias("places"),
        F.min(F.col("diagonal") + F.array_min("places")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("places") + F.col("gram")).alias("past"))
    covered = F.size(F.array_distinct(F.flatten(F.transform(F.array_distinct("places"), lambda t: F.sequence(t, t + F.col("gram") - 1)))))
    spans = spans.withColumns({"covered": covered, "plain": ~F.col("strict") & (F.col("template") >= 0)})
    share = F.col("covered") / F.greatest(F.col("n_template").cast("bigint"), F.col("past") - F.col("first"))
    spans = spans.withColumn("share", F.when(F.col("template") < 0, 0.0).otherwise(share))
    verified = spans.where(F.col("share") >= F.when(F.col("template") < 0, 0.0).when(F.col("strict"), 1.0).otherwise(SHARE))
    along = Window.partitionBy("row", "plain").orderBy("first", "past", "template")
    reached = F.max("past").over(along.rowsBetween(Window.unboundedPreceding, -1))
    places = verified.withColumn("fresh", F.when(F.col("first") < reached, 0).otherwise(1)).withColumn("region", F.sum("fresh").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    best = Window.partitionBy("row", "plain", "region").orderBy(F.col("covered").desc(), F.col("share").desc(), "template", "first")
    return places.withColumn("best", F.row_number().over(best)).where(~F.col("plain") | (F.col("best") == 1))


def license_spans(docs: DataFrame, templates: list[Template] | None = None) -> DataFrame:
    """doc_id, label, strict, first_word, past_word, share: a row per verified span of a text."""
    spans = verified_spans(gram_hits(docs, templates or standard_templates()).repartition("row"))
    return spans.where("template >= 0").select("doc_id", "label", "strict", F.col("first").alias("first_word"), F.col("past").alias("past_word"), "share")


def license_scan(docs: DataFrame, templates: list[Template] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row."""
    spans = verified_spans(gram_hits(docs, templates or standard_templates()).repartition("row"))
    strict, marker = F.col("strict"), F.col("template") < 0

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(labels)), ",")

    return spans.groupBy("row", "doc_id", "n_words").agg(
        F.count_if(strict).alias("n_base"),
        F.min(F.when(strict, F.col("first"))).alias("first_word"),
        F.max(F.when(strict, F.col("first"))).alias("last_word"),
        joined(F.when(strict, F.col("label"))).alias("base_labels"),
        joined(F.when(~marker, F.col("label"))).alias("labels"),
        F.max(F.when(strict, F.lit(NAMED)).otherwise(F.col("share"))).alias("score"),
    ).drop("row")


def license_scan_sql(templates: list[Template] | None = None) -> str:
    """DuckDB twin over ``documents``: grams as text, the same diagonals, chains and shares."""
    values = ",\n    ".join(
        f"({number}, [{', '.join(repr(w) for w in t.words)}], '{t.label}', {t.strict}, {t.gram}, {t.slack})"
        for number, t in enumerate(templates or standard_templates()))
    return rf"""
WITH t(template, words, label, strict, gram, slack) AS (VALUES
    {values}
), tg AS (
  SELECT template, label, strict, gram, slack, len(words) AS n_template, place::BIGINT AS place,
         array_to_string(words[place + 1:place + gram], ' ') AS wanted
  FROM t, unnest(range(len(words) - gram + 1)) AS p(place)
), d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), g AS (
  SELECT row, k AS gram, i, array_to_string(words[i + 1:i + k], ' ') AS found
  FROM d, (VALUES ({SHORT_GRAM}), ({LONG_GRAM})) AS s(k), unnest(range(len(words) - k + 1)) AS p(i)
), hits AS (
  SELECT row, template, label, strict, tg.gram, slack, n_template, place, i - place AS diagonal
  FROM g JOIN tg ON g.gram = tg.gram AND found = wanted
), parted AS (
  SELECT *, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY row, template ORDER BY diagonal, place) <= slack, false) AS near
  FROM hits
), chains AS (
  SELECT *, sum(CASE WHEN near THEN 0 ELSE 1 END) OVER (PARTITION BY row, template ORDER BY diagonal, place ROWS UNBOUNDED PRECEDING) AS chain
  FROM parted
), spans AS (
  SELECT row, template, label, strict, n_template, chain, min(diagonal + place) AS first, max(diagonal + place + gram) AS past,
         len(list_distinct(flatten(list(range(place, place + gram))))) AS covered
  FROM chains GROUP BY row, template, label, strict, n_template, chain
), verified AS (
  SELECT *, covered / greatest(n_template, past - first) AS share FROM spans
  WHERE covered / greatest(n_template, past - first) >= CASE WHEN strict THEN 1.0 ELSE {SHARE} END
), reached AS (
  SELECT *, max(past) OVER (PARTITION BY row, strict ORDER BY first, past, template ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto
  FROM verified
), regions AS (
  SELECT *, sum(CASE WHEN first < upto THEN 0 ELSE 1 END) OVER (PARTITION BY row, strict ORDER BY first, past, template ROWS UNBOUNDED PRECEDING) AS region
  FROM reached
), kept AS (
  SELECT * FROM regions
  QUALIFY strict OR row_number() OVER (PARTITION BY row, strict, region ORDER BY covered DESC, share DESC, template, first) = 1
), summed AS (
  SELECT row, count(*) FILTER (strict) AS n_base, min(first) FILTER (strict) AS first_word, max(first) FILTER (strict) AS last_word,
         coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (strict), '') AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
         max(CASE WHEN strict THEN {NAMED}::DOUBLE ELSE share END) AS score
  FROM kept GROUP BY row
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN summed USING (row)
"""

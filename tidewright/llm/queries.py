"""One query per operator with production settings, and DuckDB twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewright.llm import (
    decontaminate, divergence, html_text, language_id, licenses, near_dedup, quality_model, quality_rules, sharding, source_mix, spelling, substring_dedup, token_counts,
)
from tidewright.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": lambda spark, sf: language_id.held_out_languages(table(spark, sf, "documents")),
    "op2_quality_rules": lambda spark, sf: quality_rules.quality_rules(table(spark, sf, "documents")),
    "op3_source_mix": lambda spark, sf: source_mix.mixed_sources(table(spark, sf, "documents")),
    "op4_near_duplicates": lambda spark, sf: near_dedup.near_duplicates(table(spark, sf, "documents")),
    "op5_decontamination": lambda spark, sf: decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark")),
    "op6_sharding": lambda spark, sf: sharding.extendible_shards(table(spark, sf, "documents")),
    "op7_substring_dedup": lambda spark, sf: substring_dedup.substring_dedup(table(spark, sf, "documents")),
    "op8_quality_model": lambda spark, sf: quality_model.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op9_html_text": lambda spark, sf: html_text.page_texts(table(spark, sf, "pages")),
    "op10_token_counts": lambda spark, sf: token_counts.length_histogram(token_counts.encoded_lengths(table(spark, sf, "documents"))),
    "op11_license_scan": lambda spark, sf: licenses.license_scan(table(spark, sf, "documents")),
    "op12_source_divergence": lambda spark, sf: divergence.source_divergence(table(spark, sf, "documents")),
    "op13_spelling_variants": lambda spark, sf: spelling.spelling_variants(table(spark, sf, "documents")),
}

ORACLE_SQL: dict[str, str] = {
    "op6_sharding": sharding.extendible_shards_sql(),
    "op11_license_scan": licenses.license_scan_sql(),
    "op12_source_divergence": divergence.source_divergence_sql(),
}

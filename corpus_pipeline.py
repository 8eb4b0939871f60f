"""The corpus pipeline: five operators, each working on what the one before kept.

quality rules drop outliers, near-duplicates leave one document of each class, documents
that contain benchmark items go, sources are mixed to their target weights, and what is
left is dealt to shards. Every stage but the last returns the columns of ``documents``; the
last adds ``shard`` and ``depth``. Each stage is written to the folder all executors
share and read again, so a lost executor repeats at most one stage.

Nulls, empty texts, repeated rows and empty tables are as each operator defines them. The
first three stages tell rows apart by id and text, so rows with a null ``doc_id`` and different
texts under one id are judged each by itself. Columns of the input named ``shard`` or ``depth``
are replaced by the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import decontaminate, near_dedup, quality_rules, sharding, source_mix
from tidewright.llm.common import kept_table, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.drop_rejected(docs, quality_rules.row_verdicts(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, decontaminate.row_leaks(docs, table(spark, sf_dir, "benchmark")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    places = sharding.extendible_shards(docs).select(F.col("doc_id").alias("__id"), "shard", "depth").dropDuplicates(["__id"])
    own = [docs[c] for c in docs.columns if c not in ("shard", "depth")]
    return docs.join(places, docs["doc_id"].eqNullSafe(F.col("__id"))).select(*own, places["shard"], places["depth"])


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near),
    ("decontamination", leaks),
    ("source_mix", mixed),
    ("sharding", sharded),
]

#: SQL can express neither the estimates nor the signatures; tests compare stages with plain versions of their decisions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept_table(stage(spark, docs, sf_dir), name)
    return docs

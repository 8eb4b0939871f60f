"""Scans, schema work, row filters, validation and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.contracts import FEATURE_COLUMNS, STAT_COLUMNS
from tidewright.operators import clean, project, quality, views
from tidewright.operators.features import log_features, log_names
from tidewright.plans import bindings as B
from tidewright.plans.registry import query
from tidewright.session import scratch_path
from tidewright.sources import tables

# --- scans ----------------------------------------------------------------------------


@query("scan_partitioned", "WITH " + B.TICKS_SQL + """
SELECT seq, price_date, CAST(year(CAST(price_date AS DATE)) AS INTEGER) AS year,
       CAST(month(CAST(price_date AS DATE)) AS INTEGER) AS month, CAST(day(CAST(price_date AS DATE)) AS INTEGER) AS day
FROM ticks""")
def scan_partitioned(spark, sf):
    path = scratch_path(spark, "scan-partitioned")
    ticks = B.ticks(B.table(spark, sf, "events"))
    tables.write_partitioned(views.by_business_date(ticks), path)
    return tables.scan(spark, path).select("seq", "price_date", "year", "month", "day")


@query("scan_pruned_days", "WITH " + B.TICKS_SQL + """
SELECT seq, price_date, buy_price FROM ticks WHERE price_date >= '2024-01-21'""")
def scan_pruned_days(spark, sf):
    path = scratch_path(spark, "scan-pruned")
    ticks = B.ticks(B.table(spark, sf, "events"))
    tables.write_partitioned(views.by_business_date(ticks), path)
    recent = views.trailing_days(tables.scan(spark, path), 10, B.AS_OF, partitioned=True)
    return recent.select("seq", "price_date", "buy_price")


@query("scan_merge_schema", "WITH " + B.TICKS_SQL + f"""
SELECT seq, price_date, buy_price, CASE WHEN price_date >= '{B.HALF}' THEN source END AS source FROM ticks""")
def scan_merge_schema(spark, sf):
    path = scratch_path(spark, "scan-merge")
    ticks = B.ticks(B.table(spark, sf, "events")).select("seq", "price_date", "buy_price", "source")
    ticks.filter(F.col("price_date") < B.HALF).drop("source").write.parquet(f"{path}/layout=1")
    ticks.filter(F.col("price_date") >= B.HALF).write.parquet(f"{path}/layout=2")
    return tables.scan(spark, path, merge_schema=True).select("seq", "price_date", "buy_price", "source")


@query("scan_csv_roundtrip", """
SELECT p_partkey, p_name || ' "' || p_size || '", ' || p_brand AS p_name, p_type, p_retailprice FROM part""")
def scan_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "scan-csv")
    part = B.table(spark, sf, "part").withColumn(
        "p_name", F.concat("p_name", F.lit(' "'), "p_size", F.lit('", '), "p_brand"))
    columns = ["p_partkey", "p_name", "p_type", "p_retailprice"]
    tables.export_csv(part, path, columns)
    return tables.scan_csv(spark, path, part.select(*columns).schema)


# --- schemas ------------------------------------------------------------------------------


@query("schema_diff", """
WITH sides AS (
  SELECT 'c_custkey' AS "column", 'bigint' AS left_type, NULL AS right_type,
         count(c_custkey) AS left_values, NULL AS right_values FROM customer
  UNION ALL SELECT 'name', 'string', NULL, count(c_name), NULL FROM customer
  UNION ALL SELECT 'nationkey', 'int', NULL, count(c_nationkey), NULL FROM customer
  UNION ALL SELECT 'acctbal', 'double', NULL, count(c_acctbal), NULL FROM customer
  UNION ALL SELECT 'c_mktsegment', 'string', NULL, count(c_mktsegment), NULL FROM customer
  UNION ALL SELECT 's_suppkey', NULL, 'bigint', NULL, count(s_suppkey) FROM supplier
  UNION ALL SELECT 'name', NULL, 'string', NULL, count(s_name) FROM supplier
  UNION ALL SELECT 'nationkey', NULL, 'int', NULL, count(s_nationkey) FROM supplier
  UNION ALL SELECT 'acctbal', NULL, 'double', NULL, count(s_acctbal) FROM supplier)
SELECT "column", count(left_type) > 0 AS in_left, count(right_type) > 0 AS in_right,
       max(left_type) AS left_type, max(right_type) AS right_type,
       CAST(max(left_values) AS BIGINT) AS left_values, CAST(max(right_values) AS BIGINT) AS right_values
FROM sides GROUP BY "column" """)
def schema_diff(spark, sf):
    shared = ("name", "nationkey", "acctbal")
    customer = B.table(spark, sf, "customer").withColumnsRenamed({f"c_{c}": c for c in shared})
    supplier = B.table(spark, sf, "supplier").withColumnsRenamed({f"s_{c}": c for c in shared})
    return project.schema_diff(customer, supplier)


@query("schema_align_union", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT CAST(0 AS BIGINT), s_name, s_nationkey, s_acctbal, 'none' FROM supplier""")
def schema_align_union(spark, sf):
    customer = B.table(spark, sf, "customer")
    supplier = B.table(spark, sf, "supplier").withColumnsRenamed(
        {f"s_{c}": f"c_{c}" for c in ("name", "nationkey", "acctbal")})
    aligned = project.align_to(supplier, customer.schema, {"c_mktsegment": "none"}, fallback=0)
    return project.union_aligned(customer, aligned)


# --- filters --------------------------------------------------------------------------------


def _players(spark, sf):
    return B.players(B.table(spark, sf, "lineitem"))


@query("filter_complete_stats", "WITH " + B.PLAYERS_SQL + " SELECT player_id, name FROM players WHERE "
       + " AND ".join(f'"{c}" IS NOT NULL' for c in STAT_COLUMNS))
def filter_complete_stats(spark, sf):
    return quality.complete_stats(_players(spark, sf)).select("player_id", "name")


@query("filter_category_strict", "WITH " + B.PLAYERS_SQL + """
SELECT player_id, position, strong_foot FROM players
WHERE position <> 'Goalkeeper' AND strong_foot IN ('left', 'right', 'both')""")
def filter_category_strict(spark, sf):
    return quality.outfield_strict(_players(spark, sf)).select("player_id", "position", "strong_foot")


@query("filter_category_lenient", "WITH " + B.PLAYERS_SQL + """
SELECT player_id, position, strong_foot FROM players
WHERE (position IS NULL OR position <> 'Goalkeeper')
  AND (strong_foot IS NULL OR strong_foot IN ('left', 'right', 'both'))""")
def filter_category_lenient(spark, sf):
    return quality.outfield_lenient(_players(spark, sf)).select("player_id", "position", "strong_foot")


@query("filter_features_ready", "WITH " + B.PLAYERS_SQL + """
SELECT player_id, CAST(market_value AS DOUBLE) AS market_value FROM players
WHERE appearances > -1 AND minutes_per_goal IS NOT NULL AND market_value IS NOT NULL AND player_id IS NOT NULL""")
def filter_features_ready(spark, sf):
    logged = log_features(_players(spark, sf))
    needed = [*log_names(FEATURE_COLUMNS), "market_value", "player_id"]
    return quality.require_values(logged, needed).select("player_id", "market_value")


@query("drop_any_null", "WITH " + B.LABELLED_SQL + """
SELECT doc_id, lang, quality, toxic FROM labelled
WHERE lang IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL""")
def drop_any_null(spark, sf):
    labelled = B.labelled_documents(B.table(spark, sf, "documents"), B.table(spark, sf, "labels"))
    return quality.drop_any_null(labelled.select("doc_id", "lang", "quality", "toxic"))


# --- validation -------------------------------------------------------------------------------

_AMOUNT_BAD = '(isnan(CAST("{c}" AS DOUBLE)) OR "{c}" < 0)'
RULES_SQL = {
    **{f"missing_{c}": f'"{c}" IS NULL' for c in quality.PLAYER_REQUIRED},
    "goalkeeper": "position = 'Goalkeeper'",
    "unknown_foot": "strong_foot NOT IN ('left', 'right', 'both')",
    **{f"bad_{c}": _AMOUNT_BAD.format(c=c) for c in quality.PLAYER_AMOUNTS},
}
ACCEPTED_SQL = " AND ".join(f"NOT coalesce({rule}, false)" for rule in RULES_SQL.values())


def _checked(spark, sf):
    return quality.check_columns(_players(spark, sf), quality.PLAYER_REQUIRED)


@query("validate_records", "WITH " + B.PLAYERS_SQL + f"""
SELECT player_id, position, strong_foot, CAST(goals AS DOUBLE) AS goals FROM players WHERE {ACCEPTED_SQL}""")
def validate_records(spark, sf):
    return quality.accepted(_checked(spark, sf), quality.player_rules()).select("player_id", "position", "strong_foot", "goals")


@query("validate_reject_reasons", "WITH " + B.PLAYERS_SQL
       + f" SELECT 'accepted' AS reason, count(*) AS row_count FROM players WHERE {ACCEPTED_SQL} HAVING count(*) > 0"
       + "".join(f" UNION ALL SELECT '{name}', count(*) FROM players WHERE {rule} HAVING count(*) > 0"
                 for name, rule in RULES_SQL.items()))
def validate_reject_reasons(spark, sf):
    return quality.count_reasons(_checked(spark, sf), quality.player_rules())


# --- profiles -----------------------------------------------------------------------------------

_DOCUMENT_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


@query("profile_table", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS type, count(*) AS row_count, "
    f"count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count FROM documents"
    for c, t in _DOCUMENT_TYPES.items()))
def profile_table(spark, sf):
    return quality.profile_table(B.table(spark, sf, "documents"))


@query("null_profile", "WITH " + B.LABELLED_SQL + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count FROM labelled"
    for c in ("doc_id", "lang", "source", "n_chars", "quality", "toxic")))
def null_profile(spark, sf):
    return quality.null_profile(B.labelled_documents(B.table(spark, sf, "documents"), B.table(spark, sf, "labels")))


@query("distinct_categories", "SELECT DISTINCT p_type FROM part")
def distinct_categories(spark, sf):
    return quality.distinct_values(B.table(spark, sf, "part"), "p_type")


# --- NaN ---------------------------------------------------------------------------------------


@query("nan_to_null", "WITH " + B.PLAYERS_SQL + """
SELECT player_id, CASE WHEN NOT isnan(minutes_per_goal) AND NOT isinf(minutes_per_goal)
                       THEN CAST(minutes_per_goal AS DOUBLE) END AS minutes_per_goal FROM players""")
def nan_to_null(spark, sf):
    return clean.null_out_nan(_players(spark, sf)).select("player_id", "minutes_per_goal")

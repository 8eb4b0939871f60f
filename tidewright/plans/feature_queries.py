"""Splits, feature preparation and regression metrics with exact SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.operators import features as ft
from tidewright.operators.metrics import regression_metrics
from tidewright.plans import bindings as B
from tidewright.plans.registry import query

PERCENT_SQL = ("CAST(((((({key}) % 2147483647) * CAST(2654435761 AS BIGINT)) % 4294967296) >> 16) % 100 AS INTEGER)")
LINE_KEY = "l_orderkey * 8 + l_linenumber"
LINE_PERCENT = PERCENT_SQL.format(key=LINE_KEY)
STRATUM_NUMBER = "CAST('0x' || substr(md5(l_returnflag), 1, 8) AS BIGINT)"
STRATIFIED_PERCENT = PERCENT_SQL.format(key=f"(({LINE_KEY}) % 2147483647) + {STRATUM_NUMBER}")
STRATIFIED_CASE = f"""CASE WHEN {STRATIFIED_PERCENT} < 70 THEN 'train' WHEN {STRATIFIED_PERCENT} < 80
 THEN 'validation' ELSE 'test' END"""


def _lines(spark, sf):
    return B.table(spark, sf, "lineitem")


def line_key():
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


@query("split_deterministic", f"""
SELECT l_orderkey, l_linenumber, CASE WHEN {LINE_PERCENT} < 80 THEN 'train' ELSE 'test' END AS split FROM lineitem""")
def split_deterministic(spark, sf):
    return ft.with_split(_lines(spark, sf), line_key()).select("l_orderkey", "l_linenumber", "split")


@query("stratified_split", f"""
SELECT l_orderkey, l_linenumber, l_returnflag, {STRATIFIED_CASE} AS split FROM lineitem""")
def stratified_split(spark, sf):
    split = ft.with_stratified_split(_lines(spark, sf), F.col("l_returnflag"), line_key())
    return split.select("l_orderkey", "l_linenumber", "l_returnflag", "split")


@query("split_distribution", f"""
SELECT l_returnflag, {STRATIFIED_CASE} AS split, count(*) AS row_count FROM lineitem GROUP BY 1, 2""")
def split_distribution(spark, sf):
    split = ft.with_stratified_split(_lines(spark, sf), F.col("l_returnflag"), line_key())
    return ft.split_distribution(split, ["l_returnflag", "split"])


INDEX_SQL = """WITH labels AS (
  SELECT {c} AS label, count(*) AS label_count,
         CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS label_index
  FROM {t} WHERE {c} IS NOT NULL GROUP BY {c})
"""


@query("string_index_freq", INDEX_SQL.format(c="p_brand", t="part") + """
SELECT p_partkey, p_brand, label_index AS brand_index FROM part LEFT JOIN labels ON p_brand = label""")
def string_index_freq(spark, sf):
    part = B.table(spark, sf, "part").select("p_partkey", "p_brand")
    return ft.apply_index(part, ft.frequency_index(part, "p_brand"), "p_brand", "brand_index")


@query("string_index_labels", INDEX_SQL.format(c="source", t="documents") + "SELECT * FROM labels")
def string_index_labels(spark, sf):
    return ft.frequency_index(B.table(spark, sf, "documents"), "source")


@query("one_hot", INDEX_SQL.format(c="event_type", t="events") + """
SELECT event_id, event_type,
""" + ", ".join(f"CASE WHEN label_index = {i} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS type_{i}" for i in range(4))
       + " FROM events LEFT JOIN labels ON event_type = label")
def one_hot(spark, sf):
    events = B.table(spark, sf, "events").select("event_id", "event_type")
    labels = ft.frequency_index(events, "event_type")
    indexed = ft.apply_index(events, labels, "event_type", "type_index")
    return ft.one_hot(indexed, "type_index", labels.count(), "type").drop("type_index")


@query("one_hot_unseen", """
WITH codes AS (
  SELECT CAST(quality AS VARCHAR) AS code, row_number() OVER (ORDER BY count(*) DESC, CAST(quality AS VARCHAR)) - 1 AS place
  FROM labels WHERE quality IS NOT NULL GROUP BY quality)
SELECT d.doc_id,
       CASE WHEN place = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS quality_0,
       CASE WHEN place = 1 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS quality_1
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN codes ON CAST(l.quality AS VARCHAR) = code""")
def one_hot_unseen(spark, sf):
    """Documents without a label get neither column; the last label keeps its own."""
    marks = B.table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    codes = ft.frequency_index(marks, "quality")
    docs = B.table(spark, sf, "documents").select("doc_id").join(marks, "doc_id", "left")
    indexed = ft.apply_index(docs, codes, "quality", "quality_index")
    return ft.one_hot(indexed, "quality_index", codes.count() + 1, "quality").drop("quality", "quality_index")


@query("log_features", "WITH " + B.PLAYERS_SQL + """
SELECT player_id, round(ln(1 + CAST(goals AS DOUBLE)), 9) AS goals_log,
       round(ln(1 + CAST(appearances AS DOUBLE)), 9) AS appearances_log,
       CASE WHEN goals_conceded > -1 THEN round(ln(1 + CAST(goals_conceded AS DOUBLE)), 9) END AS goals_conceded_log
FROM players""")
def log_features(spark, sf):
    columns = ["goals", "appearances", "goals_conceded"]
    logged = ft.log_features(B.players(_lines(spark, sf)), columns)
    return logged.select("player_id", *[F.round(f"{c}_log", 9).alias(f"{c}_log") for c in columns])


@query("calendar_features", "WITH " + B.TICKS_SQL + """
SELECT seq, CAST(year(CAST(price_date AS DATE)) AS DOUBLE) AS year,
       CAST(month(CAST(price_date AS DATE)) AS DOUBLE) AS month, CAST(day(CAST(price_date AS DATE)) AS DOUBLE) AS day
FROM ticks""")
def calendar_features(spark, sf):
    return ft.calendar_features(B.ticks(B.table(spark, sf, "events"))).select("seq", "year", "month", "day")


@query("standard_scale", """
WITH fit AS (SELECT avg(l_quantity) AS qm, stddev_samp(l_quantity) AS qs, avg(l_discount) AS dm,
                    stddev_samp(l_discount) AS ds FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - qm) / qs, 6) AS l_quantity_scaled,
       round((l_discount - dm) / ds, 6) AS l_discount_scaled
FROM lineitem, fit""")
def standard_scale(spark, sf):
    columns = ["l_quantity", "l_discount"]
    scaled = ft.standard_scale(_lines(spark, sf).select("l_orderkey", "l_linenumber", *columns), columns)
    return scaled.select("l_orderkey", "l_linenumber",
                         *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in columns])


@query("assemble_features", "WITH " + B.PLAYERS_SQL + """
SELECT player_id, CAST(age AS DOUBLE) AS f_age, CAST(appearances AS DOUBLE) AS f_appearances,
       CAST(minutes_per_goal AS DOUBLE) AS f_minutes_per_goal
FROM players WHERE age IS NOT NULL AND appearances IS NOT NULL
  AND minutes_per_goal IS NOT NULL AND NOT isnan(minutes_per_goal)""")
def assemble_features(spark, sf):
    columns = ["age", "appearances", "minutes_per_goal"]
    rows = B.players(_lines(spark, sf)).select("player_id", *columns)
    vectors = ft.assemble(rows, columns).select("player_id", "features")
    return ft.vector_columns(vectors, "features", [f"f_{c}" for c in columns])


METRICS_SQL = """
WITH scored AS (SELECT l_returnflag, l_quantity AS label, 20 + l_discount * 100 AS prediction FROM lineitem)
SELECT {by} count(*) AS row_count, round(sqrt(avg((prediction - label) * (prediction - label))), 6) AS rmse,
       round(avg((prediction - label) * (prediction - label)), 6) AS mse,
       round(1 - avg((prediction - label) * (prediction - label)) / var_pop(label), 6) AS r2
FROM scored {group}"""


def _scored(spark, sf):
    return _lines(spark, sf).select(
        "l_returnflag", F.col("l_quantity").alias("label"), (20 + F.col("l_discount") * 100).alias("prediction"))


def _rounded(metrics):
    return metrics.withColumns({c: F.round(c, 6) for c in ("rmse", "mse", "r2")})


@query("regression_metrics", METRICS_SQL.format(by="", group=""))
def metrics_overall(spark, sf):
    return _rounded(regression_metrics(_scored(spark, sf)))


@query("regression_metrics_by_group", METRICS_SQL.format(by="l_returnflag,", group="GROUP BY l_returnflag"))
def metrics_by_group(spark, sf):
    return _rounded(regression_metrics(_scored(spark, sf), by=["l_returnflag"]))

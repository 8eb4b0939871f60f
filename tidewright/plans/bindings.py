"""The given tables seen as the entities the jobs work on.

Each binding exists twice, as a Spark select and as a DuckDB table expression
for the SQL twin of a query. Money is in whole cents so that sums are exact.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.date(2024, 1, 31)
HALF = "2024-01-16"  # middle of the event span: splits it into two batches


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- price ticks from events ------------------------------------------------------

TICK_EXPRESSIONS = (
    "event_id AS seq",
    "unix_millis(CAST(ts AS TIMESTAMP)) AS crawl_timestamp",
    "date_format(ts, 'yyyy-MM-dd') AS price_date",
    "event_type AS gold_type",
    "CAST(floor(value * 100 + 0.5D) AS INT) AS buy_price",
    "CAST(floor(value * 100 + 0.5D) AS INT) + CAST(event_id % 7 AS INT) AS sell_price",
    "concat('user_', user_id) AS source",
)


def ticks(events: DataFrame) -> DataFrame:
    return events.selectExpr(*TICK_EXPRESSIONS)


TICKS_SQL = """ticks AS (
  SELECT event_id AS seq, epoch_us(ts) // 1000 AS crawl_timestamp, strftime(ts, '%Y-%m-%d') AS price_date,
         event_type AS gold_type, CAST(floor(value * 100 + 0.5) AS INTEGER) AS buy_price,
         CAST(floor(value * 100 + 0.5) AS INTEGER) + CAST(event_id % 7 AS INTEGER) AS sell_price,
         'user_' || user_id AS source
  FROM events)"""

# --- devices from part --------------------------------------------------------------


def devices(part: DataFrame) -> DataFrame:
    """Device tiles as scraped: everything but id and time is text, some of it dirty."""
    return part.selectExpr(
        "1704067200000 + p_partkey AS crawl_timestamp",
        "CAST(p_partkey AS INT) AS product_id",
        "concat(p_name, CASE p_size % 3 WHEN 0 THEN concat(' ', p_size % 4 * 4 + 4, 'GB/', p_size % 5 * 64 + 64, 'GB') "
        "WHEN 1 THEN concat(' ', p_size % 5 * 64 + 64, 'GB') ELSE ' 4G' END) AS name",
        "p_brand AS brand",
        "p_type AS category",
        "CASE WHEN p_partkey % 4 <> 0 THEN split_part(p_name, ' ', 1) END AS color",
        "CASE WHEN p_partkey % 10 = 0 THEN 'N/A' ELSE CAST(p_retailprice AS STRING) END AS price",
        "CASE WHEN p_partkey % 7 <> 0 THEN "
        "concat(CAST(floor(p_retailprice) AS INT) + p_size % 20 * 7, '.0') END AS price_old",
        "CASE WHEN p_size % 5 <> 0 THEN concat(p_size % 5, '.', p_partkey % 10) END AS rating",
        "CASE p_size % 3 WHEN 0 THEN concat('sold ', p_size, ',', p_partkey % 10, 'K') "
        "WHEN 1 THEN CAST(p_partkey AS STRING) END AS sold",
        "'https://shop.example/list' AS source",
    )


DEVICES_SQL = """devices AS (
  SELECT 1704067200000 + p_partkey AS crawl_timestamp, CAST(p_partkey AS INTEGER) AS product_id,
         p_name || CASE p_size % 3 WHEN 0 THEN ' ' || (p_size % 4 * 4 + 4) || 'GB/' || (p_size % 5 * 64 + 64) || 'GB'
                   WHEN 1 THEN ' ' || (p_size % 5 * 64 + 64) || 'GB' ELSE ' 4G' END AS name,
         p_brand AS brand, p_type AS category,
         CASE WHEN p_partkey % 4 <> 0 THEN split_part(p_name, ' ', 1) END AS color,
         CASE WHEN p_partkey % 10 = 0 THEN 'N/A' ELSE CAST(p_retailprice AS VARCHAR) END AS price,
         CASE WHEN p_partkey % 7 <> 0
              THEN (CAST(floor(p_retailprice) AS INTEGER) + p_size % 20 * 7) || '.0' END AS price_old,
         CASE WHEN p_size % 5 <> 0 THEN (p_size % 5) || '.' || (p_partkey % 10) END AS rating,
         CASE p_size % 3 WHEN 0 THEN 'sold ' || p_size || ',' || (p_partkey % 10) || 'K'
                         WHEN 1 THEN CAST(p_partkey AS VARCHAR) END AS sold,
         'https://shop.example/list' AS source
  FROM part)"""

# --- players from lineitem ------------------------------------------------------------


def players(lineitem: DataFrame) -> DataFrame:
    """Player messages with the usual gaps: NULL stats, unknown foot, heights in two units, NaN rates."""
    return lineitem.selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS player_id",
        "concat('Player ', l_partkey) AS name",
        "concat('Club ', l_suppkey) AS player_club",
        "CAST(16 + l_linenumber * 3 AS FLOAT) AS age",
        "CASE l_returnflag WHEN 'R' THEN 'Goalkeeper' WHEN 'A' THEN 'Centre-Forward' END AS position",
        "'0' AS goalkeeper_or_not",
        "CAST(l_extendedprice / 10 AS FLOAT) AS market_value",
        "concat('Nation ', l_suppkey % 25) AS nationality",
        "CAST(CASE WHEN l_partkey % 2 = 0 THEN CAST(160 + l_suppkey % 40 AS DOUBLE) "
        "ELSE CAST(160 + l_suppkey % 40 AS DOUBLE) / 100 END AS FLOAT) AS player_height",
        "CASE WHEN l_suppkey % 5 <> 0 THEN concat('Agent ', l_suppkey % 11) END AS player_agent",
        "CASE WHEN l_linenumber = 7 THEN 'N/A' WHEN l_linenumber = 5 THEN 'both' "
        "WHEN l_linenumber = 6 THEN NULL WHEN l_linestatus = 'F' THEN 'left' ELSE 'right' END AS strong_foot",
        "CAST(2024 + l_linenumber % 5 AS STRING) AS contract_value_time",
        "CAST(nullif(l_quantity, 1.0D) AS FLOAT) AS appearances",
        "CAST(l_discount * 30 AS FLOAT) AS PPG",
        "CAST(floor(l_extendedprice / 5000) AS FLOAT) AS goals",
        "CAST(l_partkey % 13 AS FLOAT) AS assists",
        "CAST(l_linenumber % 2 AS FLOAT) AS own_goals",
        "CAST(l_suppkey % 9 AS FLOAT) AS substitutions_on",
        "CAST(l_partkey % 7 AS FLOAT) AS substitutions_off",
        "CAST(l_orderkey % 6 AS FLOAT) AS yellow_cards",
        "CAST(l_orderkey % 3 AS FLOAT) AS second_yellow_cards",
        "CAST(l_orderkey % 2 AS FLOAT) AS red_cards",
        "CAST(l_partkey % 3 AS FLOAT) AS penalty_goals",
        "CAST(CASE WHEN l_extendedprice < 5000 THEN CAST('NaN' AS DOUBLE) "
        "ELSE l_quantity * 90 / floor(l_extendedprice / 5000) END AS FLOAT) AS minutes_per_goal",
        "CAST(l_quantity * 90 AS FLOAT) AS minutes_played",
        "CAST(l_suppkey % 10 - 1 AS FLOAT) AS goals_conceded",
        "CAST(l_suppkey % 4 AS FLOAT) AS clean_sheet",
        "unix_millis(CAST(l_shipdate AS TIMESTAMP)) AS crawl_timestamp",
        "concat('https://site.example/profil/', l_partkey) AS source",
    )


PLAYERS_SQL = """players AS (
  SELECT l_orderkey || '-' || l_linenumber AS player_id, 'Player ' || l_partkey AS name,
         'Club ' || l_suppkey AS player_club, CAST(16 + l_linenumber * 3 AS FLOAT) AS age,
         CASE l_returnflag WHEN 'R' THEN 'Goalkeeper' WHEN 'A' THEN 'Centre-Forward' END AS position,
         '0' AS goalkeeper_or_not, CAST(l_extendedprice / 10 AS FLOAT) AS market_value,
         'Nation ' || (l_suppkey % 25) AS nationality,
         CAST(CASE WHEN l_partkey % 2 = 0 THEN CAST(160 + l_suppkey % 40 AS DOUBLE)
                   ELSE CAST(160 + l_suppkey % 40 AS DOUBLE) / 100 END AS FLOAT) AS player_height,
         CASE WHEN l_suppkey % 5 <> 0 THEN 'Agent ' || (l_suppkey % 11) END AS player_agent,
         CASE WHEN l_linenumber = 7 THEN 'N/A' WHEN l_linenumber = 5 THEN 'both'
              WHEN l_linenumber = 6 THEN NULL WHEN l_linestatus = 'F' THEN 'left' ELSE 'right' END AS strong_foot,
         CAST(2024 + l_linenumber % 5 AS VARCHAR) AS contract_value_time,
         CAST(nullif(l_quantity, 1.0) AS FLOAT) AS appearances, CAST(l_discount * 30 AS FLOAT) AS PPG,
         CAST(floor(l_extendedprice / 5000) AS FLOAT) AS goals, CAST(l_partkey % 13 AS FLOAT) AS assists,
         CAST(l_linenumber % 2 AS FLOAT) AS own_goals, CAST(l_suppkey % 9 AS FLOAT) AS substitutions_on,
         CAST(l_partkey % 7 AS FLOAT) AS substitutions_off, CAST(l_orderkey % 6 AS FLOAT) AS yellow_cards,
         CAST(l_orderkey % 3 AS FLOAT) AS second_yellow_cards, CAST(l_orderkey % 2 AS FLOAT) AS red_cards,
         CAST(l_partkey % 3 AS FLOAT) AS penalty_goals,
         CAST(CASE WHEN l_extendedprice < 5000 THEN CAST('NaN' AS DOUBLE)
                   ELSE l_quantity * 90 / floor(l_extendedprice / 5000) END AS FLOAT) AS minutes_per_goal,
         CAST(l_quantity * 90 AS FLOAT) AS minutes_played, CAST(l_suppkey % 10 - 1 AS FLOAT) AS goals_conceded,
         CAST(l_suppkey % 4 AS FLOAT) AS clean_sheet, epoch_ms(l_shipdate) AS crawl_timestamp,
         'https://site.example/profil/' || l_partkey AS source
  FROM lineitem)"""


#: What the models read of players: a row per customer, in the columns of PLAYER ({text}: the engine's name of the type).
CUSTOMER_PLAYERS = (
    "CAST(c_custkey AS {text}) AS player_id", "c_name AS name", "concat('Club ', c_mktsegment) AS player_club",
    "CAST(16 + c_custkey % 20 AS FLOAT) AS age",
    "CASE c_custkey % 6 WHEN 0 THEN 'Goalkeeper' WHEN 1 THEN NULL ELSE 'Centre-Forward' END AS position",
    "'0' AS goalkeeper_or_not", "CAST(c_acctbal + 1000 + c_custkey % 20 * 100 AS FLOAT) AS market_value",
    "concat('Nation ', c_nationkey) AS nationality",
    "CAST(CASE WHEN c_custkey % 2 = 0 THEN CAST(160 + c_custkey % 40 AS DOUBLE) "
    "ELSE CAST(160 + c_custkey % 40 AS DOUBLE) / 100 END AS FLOAT) AS player_height",
    "concat('Agent ', c_custkey % 300) AS player_agent",
    "CASE c_custkey % 9 WHEN 0 THEN 'N/A' WHEN 1 THEN 'both' WHEN 2 THEN NULL WHEN 3 THEN 'left' ELSE 'right' END AS strong_foot",
    "CAST(2024 + c_custkey % 5 AS {text}) AS contract_value_time",
    "CAST(CASE WHEN c_custkey % 17 <> 0 THEN c_custkey % 50 END AS FLOAT) AS appearances",
    "CAST(c_custkey % 31 AS FLOAT) AS PPG", "CAST(floor(c_acctbal / 500 + 2) AS FLOAT) AS goals",
    "CAST(c_custkey % 13 AS FLOAT) AS assists", "CAST(c_custkey % 2 AS FLOAT) AS own_goals",
    "CAST(c_custkey % 11 AS FLOAT) AS substitutions_on", "CAST(c_custkey % 7 AS FLOAT) AS substitutions_off",
    "CAST(c_custkey % 8 AS FLOAT) AS yellow_cards", "CAST(c_custkey % 3 AS FLOAT) AS second_yellow_cards",
    "CAST(c_custkey % 4 AS FLOAT) AS red_cards", "CAST(c_custkey % 5 AS FLOAT) AS penalty_goals",
    "CAST(c_custkey % 400 AS FLOAT) AS minutes_per_goal", "CAST(c_custkey % 50 * 80 AS FLOAT) AS minutes_played",
    "CAST(0 AS FLOAT) AS goals_conceded", "CAST(0 AS FLOAT) AS clean_sheet",
    "CAST(1704067200000 + c_custkey AS BIGINT) AS crawl_timestamp",
    "concat('https://site.example/profil/', c_custkey) AS source",
)
CUSTOMER_PLAYERS_SQL = "players AS (SELECT " + ", ".join(CUSTOMER_PLAYERS).format(text="VARCHAR") + " FROM customer)"


def customer_players(customer: DataFrame) -> DataFrame:
    """Fewer players than ``players``, with the same gaps: what the models are fitted to."""
    return customer.selectExpr(*[c.format(text="STRING") for c in CUSTOMER_PLAYERS])


def players_to_score(lineitem: DataFrame) -> DataFrame:
    return as_requests(players(lineitem))


def as_requests(rows: DataFrame) -> DataFrame:
    """Players as scoring requests."""
    return rows.withColumnsRenamed({
        "name": "player_name", "player_club": "club", "crawl_timestamp": "ingest_timestamp_manual",
    }).withColumn("source_type", F.lit("table")).drop("player_agent")


# --- documents with their labels, where there are any ------------------------------------


def labelled_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Left join without a hint: the engine broadcasts the labels only if they measure small."""
    return documents.select("doc_id", "lang", "source", "n_chars").join(labels, "doc_id", "left")


LABELLED_SQL = """labelled AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

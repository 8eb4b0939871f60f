"""Decode, speed, batch and serving views over the event stream."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.contracts import DEVICE, PHONE, PLAYER_CSV, PLAYER_CSV_SPEED, PLAYER_SPEED, TICK, Contract
from tidewright.functions.dates import days_before
from tidewright.operators import keyed, views
from tidewright.operators.clean import null_out_nan
from tidewright.operators.decode import decode_json, encode_json
from tidewright.operators.project import project_contract, rename_and_drop
from tidewright.plans import bindings as B
from tidewright.plans.registry import ORACLE_SQL, query
from tidewright.session import scratch_path
from tidewright.sources import tables
from tidewright.sources.topics import as_envelope
from tidewright.streaming.serving import MERGE, ServingTable

PROPS = Contract("props", T.StructType([T.StructField("k", T.IntegerType())]))

DAILY_SELECT = """
SELECT price_date, gold_type, round(avg(buy_price), 6) AS avg_buy_price, round(avg(sell_price), 6) AS avg_sell_price,
       min(buy_price) AS min_buy_price, max(buy_price) AS max_buy_price,
       min(sell_price) AS min_sell_price, max(sell_price) AS max_sell_price,
       count(*) AS record_count, 'batch' AS view_type, price_date || '_' || gold_type AS doc_id
FROM ticks {where}
GROUP BY price_date, gold_type"""

TICK_COLUMNS = "crawl_timestamp, price_date, gold_type, buy_price, sell_price, source"


def ticks(spark, sf):
    return B.ticks(B.table(spark, sf, "events"))


def rounded(df, digits=6, columns=("avg_buy_price", "avg_sell_price")):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def tick_messages(spark, sf):
    """Ticks as JSON messages with the event time as broker time."""
    events = B.table(spark, sf, "events")
    rows = events.select("*", F.col("ts").cast("timestamp").alias("_time")).selectExpr("_time", *B.TICK_EXPRESSIONS)
    body = rows.drop("_time")
    encoded = encode_json(rows.select(*body.columns, "_time"), F.col("seq"), F.col("_time"))
    return as_envelope(encoded)


@query("daily_batch_view", "WITH " + B.TICKS_SQL + DAILY_SELECT.format(where=""))
def daily_batch_view(spark, sf):
    return rounded(views.daily_view(ticks(spark, sf)))


@query("daily_batch_view_last_n", "WITH " + B.TICKS_SQL + DAILY_SELECT.format(
    where="WHERE price_date >= strftime(DATE '2024-01-31' - 10, '%Y-%m-%d')"))
def daily_batch_view_last_n(spark, sf):
    days = views.parse_days("10")
    # The bound on the stored time reaches the scan; the one on the date text is the view's own.
    events = B.table(spark, sf, "events").filter(
        F.col("ts") >= days_before(B.AS_OF, days).cast("timestamp_ntz"))
    recent = views.trailing_days(B.ticks(events), days, B.AS_OF)
    return rounded(views.daily_view(recent))


@query("decode_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def decode_props(spark, sf):
    events = B.table(spark, sf, "events").select("event_id", F.col("props").alias("value"))
    return decode_json(events, PROPS, {"event_id": "event_id"})


@query("encode_json_messages", "WITH " + B.TICKS_SQL + f" SELECT CAST(seq AS VARCHAR) AS key, {TICK_COLUMNS} FROM ticks")
def encode_json_messages(spark, sf):
    messages = encode_json(ticks(spark, sf), F.col("seq"))
    return decode_json(messages, TICK, {"key": "key"})


@query("envelope_metadata", "WITH " + B.TICKS_SQL + f"""
SELECT {TICK_COLUMNS}, epoch_us(ts) AS kafka_ingest_timestamp
FROM ticks JOIN events ON seq = event_id""")
def envelope_metadata(spark, sf):
    return decode_json(tick_messages(spark, sf), TICK, {"timestamp": "kafka_ingest_timestamp"})


@query("project_contract", "WITH " + B.TICKS_SQL + f" SELECT {TICK_COLUMNS} FROM ticks")
def contract_projection(spark, sf):
    raw = B.table(spark, sf, "events").selectExpr("*", *B.TICK_EXPRESSIONS)
    named = rename_and_drop(raw.drop("source").withColumn("origin", F.concat(F.lit("user_"), "user_id")),
                            {"origin": "source"}, drop=["props", "not_there"])
    return project_contract(named, TICK)


@query("speed_view", "WITH " + B.TICKS_SQL + """
SELECT crawl_timestamp, gold_type, buy_price, sell_price, source, crawl_timestamp * 1000 AS "@timestamp",
       price_date AS price_date_dt, 'stream' AS view_type FROM ticks""")
def speed_view(spark, sf):
    return views.tick_speed(decode_json(tick_messages(spark, sf), TICK))


@query("speed_view_devices", "WITH " + B.DEVICES_SQL + """
SELECT crawl_timestamp, product_id, name, brand, category, color,
       CAST(TRY_CAST(price AS FLOAT) AS DOUBLE) AS price, CAST(TRY_CAST(price_old AS FLOAT) AS DOUBLE) AS price_old,
       CAST(NULL AS VARCHAR) AS "RAM", CAST(NULL AS VARCHAR) AS "ROM", CAST(NULL AS INTEGER) AS percent,
       CAST(TRY_CAST(rating AS FLOAT) AS DOUBLE) AS rating,
       CASE WHEN regexp_matches(sold, '^[0-9]+$') THEN CAST(sold AS INTEGER) END AS sold,
       source, crawl_timestamp * 1000 AS "@timestamp", 'stream' AS view_type
FROM devices""")
def speed_view_devices(spark, sf):
    messages = encode_json(B.devices(B.table(spark, sf, "part")))
    return views.device_speed(decode_json(messages, DEVICE))


@query("speed_view_phones", "WITH " + B.DEVICES_SQL + """
SELECT name, brand, CAST(NULL AS VARCHAR) AS capacity, CAST(NULL AS VARCHAR) AS "RAM", CAST(NULL AS VARCHAR) AS "ROM",
       CAST(NULL AS VARCHAR) AS model, CAST(NULL AS VARCHAR) AS screen_size, CAST(NULL AS VARCHAR) AS resolution,
       CAST(NULL AS VARCHAR) AS new_price, CAST(NULL AS VARCHAR) AS old_price, CAST(NULL AS VARCHAR) AS percent,
       rating, sold, source, crawl_timestamp, crawl_timestamp * 1000 AS "@timestamp",
       strftime(epoch_ms(crawl_timestamp), '%Y-%m-%d') AS crawl_date_dt, 'stream' AS view_type
FROM devices""")
def speed_view_phones(spark, sf):
    messages = encode_json(B.devices(B.table(spark, sf, "part")))
    return views.phone_speed(decode_json(messages, PHONE))


def _sql_columns(contract):
    names = []
    for field in contract.schema.fields:
        quoted = f'"{field.name}"'
        names.append(f"CAST({quoted} AS DOUBLE) AS {quoted}" if isinstance(field.dataType, T.FloatType) else quoted)
    return ", ".join(names)


@query("speed_view_players", "WITH " + B.PLAYERS_SQL + f""",
tagged AS (SELECT * REPLACE (coalesce(player_agent, 'None') AS player_agent,
                             CASE WHEN isnan(minutes_per_goal) THEN NULL ELSE minutes_per_goal END AS minutes_per_goal),
                  crawl_timestamp * 1000 AS "@timestamp", 'stream' AS view_type FROM players)
SELECT {_sql_columns(PLAYER_SPEED)} FROM tagged
WHERE appearances IS NOT NULL AND minutes_per_goal IS NOT NULL""")
def speed_view_players(spark, sf):
    return views.player_speed(null_out_nan(B.players(B.table(spark, sf, "lineitem"))))


PLAYERS_CSV_SQL = """csv AS (SELECT CASE WHEN c_custkey % 8 <> 0 THEN CAST(c_custkey AS INTEGER) END AS player_id, * EXCLUDE (player_id),
  1704067200000 + c_custkey * 3600000 AS processing_timestamp, 'file ' || (c_custkey % 4) AS source_file
  FROM (SELECT players.*, customer.c_custkey FROM players JOIN customer ON players.player_id = CAST(c_custkey AS VARCHAR)))"""


def players_csv(spark, sf):
    """The rows of player files: a whole number as id, missing for some, and the time of processing."""
    rows = B.table(spark, sf, "customer").selectExpr("c_custkey", *[c.format(text="STRING") for c in B.CUSTOMER_PLAYERS])
    return rows.withColumns({
        "player_id": F.when(F.col("c_custkey") % 8 != 0, F.col("c_custkey").cast("int")), "contract_value_time": F.col("contract_value_time").cast("float"),
        "processing_timestamp": F.lit(1704067200000) + F.col("c_custkey") * 3600000, "source_file": F.concat(F.lit("file "), F.col("c_custkey") % 4),
    }).select(*PLAYER_CSV.columns)


@query("speed_view_players_csv", "WITH " + B.CUSTOMER_PLAYERS_SQL + ", " + PLAYERS_CSV_SQL + f""",
tagged AS (SELECT *, processing_timestamp * 1000 AS "@timestamp", 'stream' AS view_type FROM csv)
SELECT {_sql_columns(PLAYER_CSV_SPEED)} FROM tagged WHERE player_id IS NOT NULL""")
def speed_view_players_csv(spark, sf):
    return views.player_csv_speed(decode_json(encode_json(players_csv(spark, sf)), PLAYER_CSV))


@query("partition_by_event_time", """
SELECT event_id AS seq, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day FROM events""")
def partition_by_event_time(spark, sf):
    return views.by_event_time(ticks(spark, sf)).select("seq", "year", "month", "day")


DIRTY_DATE = "CASE WHEN event_id % 11 = 0 THEN 'bad' ELSE {iso} END"


@query("partition_by_business_date", f"""
WITH dated AS (SELECT event_id, {DIRTY_DATE.format(iso="strftime(ts, '%Y-%m-%d')")} AS price_date FROM events)
SELECT event_id, price_date, CAST(year(TRY_CAST(price_date AS DATE)) AS INTEGER) AS year,
       CAST(month(TRY_CAST(price_date AS DATE)) AS INTEGER) AS month,
       CAST(day(TRY_CAST(price_date AS DATE)) AS INTEGER) AS day
FROM dated""")
def partition_by_business_date(spark, sf):
    iso = "date_format(ts, 'yyyy-MM-dd')"
    dated = B.table(spark, sf, "events").selectExpr("event_id", DIRTY_DATE.format(iso=iso) + " AS price_date")
    return views.by_business_date(dated)


@query("partition_by_crawl_date", "WITH " + B.DEVICES_SQL + """
SELECT product_id, strftime(epoch_ms(crawl_timestamp), '%Y-%m-%d') AS crawl_date FROM devices""")
def partition_by_crawl_date(spark, sf):
    return views.with_crawl_date(B.devices(B.table(spark, sf, "part"))).select("product_id", "crawl_date")


# --- keyed state ---------------------------------------------------------------------

USER_ROWS = ("user_id", "ts", "event_id", "event_type", "props")


@query("latest_per_key", """
SELECT user_id, epoch_us(ts) // 1000 AS ts_ms, event_id, event_type, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events)
WHERE place = 1""")
def latest_per_key(spark, sf):
    newest = keyed.latest_per_key(B.table(spark, sf, "events").select(*USER_ROWS), ["user_id"], ["ts", "event_id"])
    return newest.select("user_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
                         "event_id", "event_type", "props")


STATE_ORDER = ["ts_ms", "event_id"]


def _user_states(spark, sf):
    return B.table(spark, sf, "events").select(
        "user_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), "event_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("last_action"), "props")


def _served(spark, sf, mode, name):
    """Second half of the span first, then the first half: older rows arrive late."""
    rows, half = _user_states(spark, sf), F.unix_millis(F.lit(B.HALF).cast("timestamp"))
    served = ServingTable(scratch_path(spark, name), ["user_id"], ["ts_ms", "event_id"], mode)
    earlier, later = rows.filter(F.col("ts_ms") < half), rows.filter(F.col("ts_ms") >= half)
    batches = [later, earlier] if mode != MERGE else [earlier, later]
    for number, batch in enumerate(batches):
        served.apply(batch, number)
    return served.read(spark)


STATES_SQL = """WITH states AS (
  SELECT user_id, epoch_us(ts) // 1000 AS ts_ms, event_id,
         CASE WHEN event_type <> 'error' THEN event_type END AS last_action, props FROM events),
placed AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, event_id) AS place FROM states)
"""


@query("serve_replace_by_key", STATES_SQL + """
SELECT user_id, ts_ms, event_id, last_action, props
FROM placed QUALIFY place = max(place) OVER (PARTITION BY user_id)""")
def serve_replace_by_key(spark, sf):
    return _served(spark, sf, "replace", "serve-replace")


@query("serve_merge_by_key", STATES_SQL + """
SELECT user_id, max(ts_ms) AS ts_ms, arg_max(event_id, place) AS event_id,
       arg_max(last_action, place) FILTER (WHERE last_action IS NOT NULL) AS last_action,
       arg_max(props, place) FILTER (WHERE props IS NOT NULL) AS props
FROM placed GROUP BY user_id""")
def serve_merge_by_key(spark, sf):
    return _served(spark, sf, MERGE, "serve-merge")


@query("serve_restarted_writer", ORACLE_SQL["serve_replace_by_key"])
def serve_restarted_writer(spark, sf):
    """A second writer numbers its batches from 0 again, and a batch is repeated after it was compacted: no row is lost or wins twice."""
    rows, served = _user_states(spark, sf), ServingTable(scratch_path(spark, "serve-restart"), ["user_id"], STATE_ORDER)
    parts = [rows.filter(F.col("event_id") % 3 == i) for i in range(3)]
    served.apply(parts[0], 0, "first")
    served.apply(parts[1], 1, "first")
    served.compact(spark)
    served.apply(parts[2], 0, "second")
    served.apply(parts[1], 1, "first")
    served.compact(spark)
    served.vacuum(spark, keep=1)
    return served.read(spark)


@query("serve_partial_columns", STATES_SQL + f"""
SELECT user_id, ts_ms, event_id, last_action, CASE WHEN ts_ms < epoch_ms(TIMESTAMP '{B.HALF}') THEN props END AS props
FROM placed QUALIFY place = max(place) OVER (PARTITION BY user_id)""")
def serve_partial_columns(spark, sf):
    """A later batch lacks a column that the base has: its rows stand whole, with NULL there, and the column stays."""
    rows, half = _user_states(spark, sf), F.unix_millis(F.lit(B.HALF).cast("timestamp"))
    served = ServingTable(scratch_path(spark, "serve-partial"), ["user_id"], STATE_ORDER)
    served.apply(rows.filter(F.col("ts_ms") < half), 0)
    served.compact(spark)
    served.apply(rows.filter(F.col("ts_ms") >= half).drop("props"), 1)
    return served.read(spark)


@query("merge_tables_by_key", STATES_SQL + f""",
cut AS (SELECT epoch_ms(TIMESTAMP '{B.HALF}') AS half),
base AS (SELECT user_id, ts_ms, event_id, last_action, props FROM placed, cut WHERE ts_ms < half
         QUALIFY place = max(place) OVER (PARTITION BY user_id)),
upd AS (SELECT user_id, max(ts_ms) AS ts_ms, arg_max(event_id, place) AS event_id,
               arg_max(last_action, place) FILTER (WHERE last_action IS NOT NULL) AS last_action,
               arg_max(props, place) FILTER (WHERE props IS NOT NULL) AS props
        FROM placed, cut WHERE ts_ms >= half GROUP BY user_id)
SELECT coalesce(u.user_id, b.user_id) AS user_id, coalesce(u.ts_ms, b.ts_ms) AS ts_ms,
       coalesce(u.event_id, b.event_id) AS event_id, coalesce(u.last_action, b.last_action) AS last_action,
       coalesce(u.props, b.props) AS props
FROM base b FULL JOIN upd u ON b.user_id = u.user_id""")
def merge_tables_by_key(spark, sf):
    return _merged_halves(spark, sf, keyed.FEW)


def _halves(spark, sf):
    """The latest states of the first half of the span, and all changes of the second half."""
    rows, half = _user_states(spark, sf), F.unix_millis(F.lit(B.HALF).cast("timestamp"))
    base = keyed.latest_per_key(rows.filter(F.col("ts_ms") < half), ["user_id"], STATE_ORDER)
    return base, rows.filter(F.col("ts_ms") >= half)


def _merged_halves(spark, sf, plan):
    base, updates = _halves(spark, sf)
    return keyed.merge_by_key(base, updates, ["user_id"], STATE_ORDER, plan)


@query("merge_many_by_key", ORACLE_SQL["merge_tables_by_key"])
def merge_many_by_key(spark, sf):
    return _merged_halves(spark, sf, keyed.MANY)


@query("replace_many_by_key", ORACLE_SQL["serve_replace_by_key"])
def replace_many_by_key(spark, sf):
    base, updates = _halves(spark, sf)
    return keyed.replace_by_key(base, updates, ["user_id"], STATE_ORDER, keyed.MANY)


@query("merge_bucketed_base", ORACLE_SQL["merge_tables_by_key"])
def merge_bucketed_base(spark, sf):
    """The base is a table bucketed by user; only the updates are shuffled."""
    base, updates = _halves(spark, sf)
    name = f"states_{uuid.uuid4().hex}"
    tables.write_bucketed(base, name, scratch_path(spark, name), ["user_id"], 8)
    return keyed.merge_by_key(spark.table(name), updates, ["user_id"], STATE_ORDER, keyed.BUCKETED)


# --- serving ---------------------------------------------------------------------------


def _serving(spark, sf):
    rows = ticks(spark, sf)
    return views.serving_union(rounded(views.daily_view(rows)), views.tick_speed(rows))


SERVING_SQL = "WITH " + B.TICKS_SQL + ", daily AS (" + DAILY_SELECT.format(where="") + """),
speed AS (SELECT crawl_timestamp, gold_type, buy_price, sell_price, source,
                 crawl_timestamp * 1000 AS "@timestamp", price_date AS price_date_dt, 'stream' AS view_type FROM ticks),
serving AS (SELECT * FROM daily UNION ALL BY NAME SELECT * FROM speed)
SELECT * FROM serving"""


@query("serving_union", SERVING_SQL)
def serving_union(spark, sf):
    return _serving(spark, sf)


@query("serving_lookup", SERVING_SQL + """
WHERE view_type = 'stream' AND price_date_dt BETWEEN '2024-01-10' AND '2024-01-12'""")
def serving_lookup(spark, sf):
    return views.serving_lookup(_serving(spark, sf), "stream", dt.date(2024, 1, 10), dt.date(2024, 1, 12))

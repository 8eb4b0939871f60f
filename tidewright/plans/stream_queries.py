"""Streaming jobs run to the end of their input; each must equal its batch twin."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewright.contracts import PLAYER, PLAYER_RAW, PLAYER_SCORED, PLAYER_TO_SCORE, TICK
from tidewright.operators import models as M
from tidewright.operators import quality, views
from tidewright.operators.decode import decode_json, encode_json
from tidewright.plans import bindings as B
from tidewright.plans.model_queries import scoring_model
from tidewright.plans.registry import ORACLE_SQL, query
from tidewright.plans.table_queries import ACCEPTED_SQL, RULES_SQL
from tidewright.plans.view_queries import TICK_COLUMNS, tick_messages
from tidewright.session import scratch_path
from tidewright.sources import tables
from tidewright.sources.topics import FolderTopic, as_envelope, table_as_stream
from tidewright.streaming import jobs, pipelines
from tidewright.streaming.counters import CounterLog, read_counters
from tidewright.streaming.serving import ServingTable

TICKS = "WITH " + B.TICKS_SQL + f" SELECT {TICK_COLUMNS} FROM ticks"


def event_stream(spark, sf):
    """The events table as a stream of envelopes."""
    rows = table_as_stream(spark, f"{sf}/events.parquet").withColumn("_time", F.col("ts").cast("timestamp"))
    body = rows.selectExpr("_time", *B.TICK_EXPRESSIONS)
    return as_envelope(encode_json(body, F.col("seq"), F.col("_time")))


@query("stream_ingest_earliest", TICKS)
def stream_ingest_earliest(spark, sf):
    root = scratch_path(spark, "ingest-earliest")
    topic = FolderTopic(f"{root}/topic")
    topic.publish(tick_messages(spark, sf))
    jobs.land(decode_json(topic.read_stream(spark, "earliest"), TICK), f"{root}/out", f"{root}/checkpoint")
    return tables.scan(spark, f"{root}/out")


@query("stream_ingest_latest", TICKS + f" WHERE price_date >= '{B.HALF}'")
def stream_ingest_latest(spark, sf):
    """Messages sent before the consumer's first start, here the middle of the span, are not delivered."""
    root = scratch_path(spark, "ingest-latest")
    topic = FolderTopic(f"{root}/topic")
    topic.publish(tick_messages(spark, sf))
    fresh = jobs.only_new(topic.read_stream(spark, "latest"), B.HALF)
    jobs.land(decode_json(fresh, TICK), f"{root}/out", f"{root}/checkpoint")
    return tables.scan(spark, f"{root}/out")


@query("stream_restart", TICKS)
def stream_restart(spark, sf):
    """A query that stopped goes on from its checkpoint: nothing lost, nothing twice."""
    root = scratch_path(spark, "restart")
    topic, messages = FolderTopic(f"{root}/topic"), tick_messages(spark, sf)
    half = F.lit(B.HALF).cast("timestamp")
    for half_of_them in (F.col("timestamp") < half, F.col("timestamp") >= half):
        topic.publish(messages.filter(half_of_them))
        jobs.land(decode_json(topic.read_stream(spark), TICK), f"{root}/out", f"{root}/checkpoint")
    return tables.scan(spark, f"{root}/out")


@query("stream_speed_view", ORACLE_SQL["speed_view"])
def stream_speed_view(spark, sf):
    root = scratch_path(spark, "speed-view")
    jobs.land(views.tick_speed(decode_json(event_stream(spark, sf), TICK)), f"{root}/out", f"{root}/checkpoint")
    return tables.scan(spark, f"{root}/out")


@query("land_partitioned", "WITH " + B.TICKS_SQL + f"""
SELECT {TICK_COLUMNS}, CAST(year(CAST(price_date AS DATE)) AS INTEGER) AS year,
       CAST(month(CAST(price_date AS DATE)) AS INTEGER) AS month, CAST(day(CAST(price_date AS DATE)) AS INTEGER) AS day
FROM ticks""")
def land_partitioned(spark, sf):
    root = scratch_path(spark, "land-partitioned")
    rows = views.by_business_date(decode_json(event_stream(spark, sf), TICK))
    jobs.land(rows, f"{root}/out", f"{root}/checkpoint", tables.DATE_PARTITIONS)
    return tables.scan(spark, f"{root}/out")


@query("land_flat", "WITH " + B.TICKS_SQL + f"""
SELECT {TICK_COLUMNS}, strftime(epoch_ms(crawl_timestamp), '%Y-%m-%d') AS crawl_date FROM ticks""")
def land_flat(spark, sf):
    root = scratch_path(spark, "land-flat")
    rows = views.with_crawl_date(decode_json(event_stream(spark, sf), TICK))
    jobs.land(rows, f"{root}/out", f"{root}/checkpoint")
    return tables.scan(spark, f"{root}/out")


@query("land_compacted", ORACLE_SQL["land_partitioned"])
def land_compacted(spark, sf):
    root = scratch_path(spark, "land-compacted")
    rows = views.by_business_date(decode_json(event_stream(spark, sf), TICK))
    jobs.land(rows, f"{root}/out", f"{root}/checkpoint", tables.DATE_PARTITIONS)
    tables.compact(spark, f"{root}/out", f"{root}/compacted")
    return tables.scan(spark, f"{root}/compacted")


@query("stream_relay", "WITH " + B.TICKS_SQL + """
SELECT crawl_timestamp, price_date, gold_type, buy_price, sell_price, source FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY crawl_timestamp DESC, buy_price DESC) AS place FROM ticks)
WHERE place = 1""")
def stream_relay(spark, sf):
    """One query publishes decoded rows to a topic, a second one upserts them into serving."""
    root = scratch_path(spark, "relay")
    middle = FolderTopic(f"{root}/topic")
    decoded = decode_json(event_stream(spark, sf), TICK)
    jobs.publish(encode_json(decoded, F.col("source")), middle, f"{root}/checkpoint-out")
    served = ServingTable(f"{root}/serving", ["source"], ["crawl_timestamp", "buy_price"])
    served.follow(decode_json(middle.read_stream(spark), TICK), f"{root}/checkpoint-in")
    served.compact(spark)
    return served.read(spark).select(*TICK.columns)


_RAW_COLUMNS = ", ".join(f'CAST("{f.name}" AS DOUBLE) AS "{f.name}"' if f.dataType.simpleString() == "float" else f'"{f.name}"' for f in PLAYER_RAW.schema.fields)


@query("land_players_raw", "WITH " + B.CUSTOMER_PLAYERS_SQL + f""", dated AS (
  SELECT *, CAST(year(epoch_ms(crawl_timestamp)) AS INTEGER) AS year, CAST(month(epoch_ms(crawl_timestamp)) AS INTEGER) AS month,
         CAST(day(epoch_ms(crawl_timestamp)) AS INTEGER) AS day FROM players)
SELECT {_RAW_COLUMNS} FROM dated WHERE appearances IS NOT NULL""")
def land_players_raw(spark, sf):
    root = scratch_path(spark, "players-raw")
    messages = as_envelope(encode_json(B.customer_players(table_as_stream(spark, f"{sf}/customer.parquet"))))
    jobs.land(views.player_raw(decode_json(messages, PLAYER)), f"{root}/out", f"{root}/checkpoint", tables.DATE_PARTITIONS)
    return tables.scan(spark, f"{root}/out")


@query("publish_validated", "WITH " + B.CUSTOMER_PLAYERS_SQL + f"""
SELECT 'sent' AS outcome, player_id, '' AS reasons FROM players WHERE {ACCEPTED_SQL}
UNION ALL SELECT 'rejected', player_id, concat_ws(',', {", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in RULES_SQL.items())})
FROM players WHERE NOT ({ACCEPTED_SQL})""")
def publish_validated(spark, sf):
    """Valid players go out as messages, the others to a folder with the reasons; all are accounted for."""
    root = scratch_path(spark, "validated")
    topic = FolderTopic(f"{root}/topic")
    rows = B.customer_players(B.table(spark, sf, "customer"))
    pipelines.publish_validated(spark, rows, PLAYER, topic, "player_id", quality.player_rules(), f"{root}/rejects")
    sent = decode_json(spark.read.parquet(topic.path), PLAYER).select(F.lit("sent").alias("outcome"), "player_id", F.lit("").alias("reasons"))
    refused = spark.read.parquet(f"{root}/rejects/rows").select(F.lit("rejected").alias("outcome"), "player_id", F.array_join("reject_reasons", ",").alias("reasons"))
    return sent.unionByName(refused)


@query("stream_relay_once", "WITH " + B.TICKS_SQL + f" SELECT CAST(seq AS VARCHAR) AS message_id, {TICK_COLUMNS} FROM ticks")
def stream_relay_once(spark, sf):
    """Every message is on the topic twice, as after a producer lost its checkpoint; each is landed once, before any fold."""
    root = scratch_path(spark, "relay-once")
    for sending in ("first", "again"):
        jobs.publish(event_stream(spark, sf), FolderTopic(f"{root}/topic/{sending}"), f"{root}/checkpoint-{sending}")
    messages = FolderTopic(f"{root}/topic").read_stream(spark, max_per_trigger=2)
    decoded = decode_json(messages, TICK, {"key": "message_id", "timestamp": "sent"})
    # The sending time is the event's own here, so the span of the table is the longest delay.
    arrived = jobs.once(decoded.withColumn("message_id", F.col("message_id").cast("string")), ["message_id"], "sent", "60 days")
    with jobs.state_on_cores(spark):
        jobs.land(arrived.drop("sent"), f"{root}/out", f"{root}/checkpoint")
    return tables.scan(spark, f"{root}/out")


@query("stream_latest", ORACLE_SQL["stream_relay"])
def stream_latest(spark, sf):
    """The newest row per source and day is kept as state and sent on whenever it changes; serving keeps the newest of all."""
    root = scratch_path(spark, "latest")
    rows = decode_json(event_stream(spark, sf), TICK).withColumn("_time", F.timestamp_millis("crawl_timestamp"))
    newest = jobs.latest_rows(rows, ["source"], ["crawl_timestamp", "buy_price"], "_time", "60 days")
    served = ServingTable(f"{root}/serving", ["source"], ["crawl_timestamp", "buy_price"])
    served.follow(newest, f"{root}/checkpoint", output="update")
    return served.read(spark).select(*TICK.columns)


@query("stream_reject_counters", "WITH " + B.PLAYERS_SQL + f"""
SELECT 'players' AS name, 'row_count' AS counter, count(*) AS amount FROM players
UNION ALL SELECT 'players', 'rejected_count', count(*) FROM players WHERE NOT ({ACCEPTED_SQL})""")
def stream_reject_counters(spark, sf):
    """Player messages are validated as they land; a listener stores the counters of each batch."""
    root = scratch_path(spark, "reject-counters")
    messages = as_envelope(encode_json(B.players(table_as_stream(spark, f"{sf}/lineitem.parquet"))))
    rules = quality.player_rules()
    checked = quality.observed(decode_json(messages, PLAYER), "players", rules)
    log = CounterLog(spark, f"{root}/counters")
    spark.streams.addListener(log)
    try:
        landed = jobs.land(quality.accepted(checked, rules), f"{root}/out", f"{root}/checkpoint")
        log.wait_for(landed.runId)
    finally:
        spark.streams.removeListener(log)
    return read_counters(spark, f"{root}/counters")


@query("compact_days", "WITH " + B.TICKS_SQL + f""", landed AS (
  SELECT {TICK_COLUMNS}, CAST(year(CAST(price_date AS DATE)) AS INTEGER) AS year, CAST(month(CAST(price_date AS DATE)) AS INTEGER) AS month,
         CAST(day(CAST(price_date AS DATE)) AS INTEGER) AS day FROM ticks)
SELECT *, day IN (1, 2, 3) AS rewritten FROM landed WHERE day < 8""")
def compact_days(spark, sf):
    """A week is compacted, then three of its days again: only their files are new."""
    root = scratch_path(spark, "compact-days")
    rows = views.by_business_date(decode_json(event_stream(spark, sf), TICK))
    jobs.land(rows, f"{root}/out", f"{root}/checkpoint", tables.DATE_PARTITIONS)
    week = [dt.date(2024, 1, d) for d in range(1, 8)]
    tables.compact_days(spark, f"{root}/out", f"{root}/compacted", week)
    before = {r[0] for r in tables.scan(spark, f"{root}/compacted").select(F.input_file_name()).distinct().collect()}
    tables.compact_days(spark, f"{root}/out", f"{root}/compacted", week[:3])
    return tables.scan(spark, f"{root}/compacted").withColumn("rewritten", ~F.input_file_name().isin(*before))


@query("stream_score")
def stream_score(spark, sf):
    """Requests scored as they arrive, relayed as messages and served by player."""
    root = scratch_path(spark, "score")
    model_path = f"{root}/model"
    M.save(scoring_model(spark, sf), model_path)
    rows = table_as_stream(spark, f"{sf}/customer.parquet")
    requests = as_envelope(encode_json(B.as_requests(B.customer_players(rows))))
    decoded = decode_json(requests, PLAYER_TO_SCORE, {"timestamp": "kafka_ingest_timestamp"})
    scored_topic = FolderTopic(f"{root}/scored")
    model = M.load(model_path)
    jobs.publish(decoded, scored_topic, f"{root}/checkpoint-score",
                 prepare=lambda batch: encode_json(M.score_players(batch, model), F.col("player_id")))
    served = ServingTable(f"{root}/serving", PLAYER_SCORED.key, PLAYER_SCORED.order)
    served.follow(decode_json(scored_topic.read_stream(spark), PLAYER_SCORED), f"{root}/checkpoint-serve")
    return served.read(spark)

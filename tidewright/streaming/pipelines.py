"""The jobs of each message domain: raw landing, speed layer, batch view, scoring, relay."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewright import contracts as C
from tidewright.operators import quality, views
from tidewright.operators.clean import null_out_nan, typed_devices
from tidewright.operators.decode import decode_json, encode_json
from tidewright.operators.models import score_players
from tidewright.sources import tables
from tidewright.sources.topics import FolderTopic, KafkaTopic
from tidewright.streaming import jobs
from tidewright.streaming.serving import MERGE, ServingTable

Topic = KafkaTopic | FolderTopic


@dataclass(frozen=True)
class Domain:
    """One kind of message: its contract, both layers, and the key of its served rows.

    Where every message is a document of its own, the key is the crawl time plus
    the fields that tell messages of one millisecond apart.
    """

    contract: C.Contract
    raw: Callable[[DataFrame], DataFrame]
    speed: Callable[[DataFrame], DataFrame]
    key: Sequence[str]
    order: Sequence[str]
    partitions: Sequence[str] = tables.DATE_PARTITIONS


DOMAINS = {
    "tick": Domain(C.TICK, views.by_business_date, views.tick_speed,
                   ["crawl_timestamp", "gold_type", "price_date_dt", "source"], ["crawl_timestamp"]),
    "device": Domain(C.DEVICE, lambda df: views.by_event_time(typed_devices(df)), views.device_speed,
                     ["crawl_timestamp", "product_id", "source"], ["crawl_timestamp"]),
    "phone": Domain(C.PHONE, views.with_crawl_date, views.phone_speed, ["name"], ["crawl_timestamp"], []),
    "player": Domain(C.PLAYER, views.player_raw, views.player_speed,
                     ["crawl_timestamp", "player_id"], ["crawl_timestamp"]),
    "player_csv": Domain(C.PLAYER_CSV, lambda df: views.by_event_time(df, "processing_timestamp"),
                         views.player_csv_speed, ["player_id"], ["processing_timestamp"]),
}


def serving(domain: Domain, path: str) -> ServingTable:
    return ServingTable(path, list(domain.key), list(domain.order))


def run_raw(spark: SparkSession, domain: Domain, topic: Topic, path: str, checkpoint: str,
            every: str | None = jobs.LAND_EVERY, max_per_trigger: int | None = None) -> StreamingQuery:
    """Topic to the raw table, in date partitions where the domain has them."""
    rows = domain.raw(decode_json(topic.read_stream(spark, "earliest", max_per_trigger), domain.contract))
    return jobs.land(rows, path, checkpoint, domain.partitions, every)


def run_speed(spark: SparkSession, domain: Domain, topic: Topic, path: str, checkpoint: str,
              every: str | None = jobs.SPEED_EVERY, max_per_trigger: int | None = None) -> StreamingQuery:
    """Topic to served rows."""
    rows = domain.speed(decode_json(topic.read_stream(spark, "earliest", max_per_trigger), domain.contract))
    return serving(domain, path).follow(rows, checkpoint, every)


def run_daily_view(spark: SparkSession, raw: str, path: str, days: int | None, as_of: dt.date,
                   version: int) -> DataFrame:
    """Raw ticks of the window to the served daily view: one scan, one aggregate, one write.

    ``version`` numbers the run; running one again overwrites only what it wrote.
    """
    recent = views.trailing_days(tables.scan(spark, raw), days, as_of, partitioned=True)
    view = views.daily_view(recent)
    served = ServingTable(path, ["doc_id"], ["price_date"], MERGE)
    served.apply(view, version)
    return served.read(spark)


def run_scoring(spark: SparkSession, model: PipelineModel, topic: Topic, path: str, checkpoint: str,
                every: str | None = jobs.SCORE_EVERY) -> StreamingQuery:
    """New requests scored and served by player; the model is loaded once, before the stream."""
    requests = decode_json(jobs.new_messages(spark, topic, checkpoint), C.PLAYER_TO_SCORE, {"timestamp": "kafka_ingest_timestamp"})
    served = ServingTable(path, C.PLAYER_SCORED.key, C.PLAYER_SCORED.order)
    return served.follow(requests, checkpoint, every, prepare=lambda batch: score_players(batch, model))


def run_scoring_to_topic(spark: SparkSession, model: PipelineModel, topic: Topic, target: Topic, checkpoint: str,
                         every: str | None = jobs.SCORE_EVERY) -> StreamingQuery:
    """As ``run_scoring``, but the scored rows go on as messages."""
    requests = decode_json(jobs.new_messages(spark, topic, checkpoint), C.PLAYER_TO_SCORE, {"timestamp": "kafka_ingest_timestamp"})
    return jobs.publish(requests, target, checkpoint, every,
                        prepare=lambda batch: encode_json(score_players(batch, model), F.col("player_id")))


def messages_once(messages: DataFrame, within: str) -> DataFrame:
    """Messages of a producer that may send a batch again: equal key and value within that time are one message."""
    digest = F.md5(F.concat_ws("|", F.hex("key"), F.hex("value")))
    return jobs.once(messages.withColumn("_digest", digest), ["_digest"], "timestamp", within).drop("_digest")


def run_relay(spark: SparkSession, topic: Topic, path: str, checkpoint: str, contract: C.Contract = C.PLAYER_SCORED,
              every: str | None = jobs.RELAY_EVERY, starting: str = "latest", within: str = "10 minutes") -> StreamingQuery:
    """Rows of one contract from a topic into serving; a message sent again ``within`` that time is left out."""
    messages = jobs.new_messages(spark, topic, checkpoint) if starting == "latest" else topic.read_stream(spark, starting)
    served = ServingTable(path, contract.key, contract.order)
    with jobs.state_on_cores(spark):
        return served.follow(decode_json(messages_once(messages, within), contract), checkpoint, every)


def publish_csv(spark: SparkSession, csv: str, contract: C.Contract, topic: Topic, key: str,
                stamp: str | None = None) -> None:
    """CSV rows as messages; rows without the key are left out, ``stamp`` gets the time of sending."""
    missing = [f for f in contract.schema.fields if f.name == stamp]
    schema = T.StructType([f for f in contract.schema.fields if f not in missing])
    rows = tables.scan_csv(spark, csv, schema).filter(F.col(key).isNotNull())
    if stamp:
        rows = rows.withColumn(stamp, F.unix_millis(F.current_timestamp()))
    topic.publish(encode_json(null_out_nan(rows).select(*contract.columns), F.col(key)))


def publish_validated(spark: SparkSession, rows: DataFrame, contract: C.Contract, topic: Topic, key: str,
                      rules: Mapping[str, Column], rejects: str, stamp: str | None = None) -> DataFrame:
    """Rows to which no rule applies as messages; the others, with their reasons, to the ``rejects`` folder.

    Rows are judged once and written to the rejects folder's side table first, so both outputs and the returned
    counts (reason, row_count) come from the same judgement. ``stamp`` gets the time of sending.
    """
    judged = f"{rejects}/judged"
    quality.with_reasons(null_out_nan(rows), {**rules, f"no_{key}": F.col(key).isNull()}).write.mode("overwrite").parquet(judged)
    checked = spark.read.parquet(judged)
    good = checked.filter(F.size("reject_reasons") == 0)
    if stamp:
        good = good.withColumn(stamp, F.unix_millis(F.current_timestamp()))
    topic.publish(encode_json(good.select(*contract.columns), F.col(key)))
    checked.filter(F.size("reject_reasons") > 0).write.mode("overwrite").parquet(f"{rejects}/rows")
    return quality.reason_counts(checked)


def publish_csv_validated(spark: SparkSession, csv: str, contract: C.Contract, topic: Topic, key: str,
                          rules: Mapping[str, Column], rejects: str, stamp: str | None = None) -> DataFrame:
    """``publish_validated`` over CSV files with the contract's header, but for ``stamp``."""
    schema = T.StructType([f for f in contract.schema.fields if f.name != stamp])
    return publish_validated(spark, tables.scan_csv(spark, csv, schema), contract, topic, key, rules, rejects, stamp)

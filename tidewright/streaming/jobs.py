"""Streaming jobs: landing, publishing, scoring. One checkpoint per query.

``every`` is the micro-batch interval of a long-running job. Without it the
query drains what is on the topic and stops, which is how tests and backfills run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewright.sources.topics import FolderTopic, KafkaTopic, as_envelope

# --- fixed values: micro-batch intervals ----------------------------------------
LAND_EVERY = "1 minute"
SPEED_EVERY = "1 minute"
SCORE_EVERY = "30 seconds"
RELAY_EVERY = "10 seconds"
# state parts of a query per core, and at least
STATE_PARTS_PER_CORE, LEAST_STATE_PARTS = 4, 32
# ----------------------------------------------------------------------------------


def _start(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    timed = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    query = timed.option("checkpointLocation", checkpoint).start()
    if not every:
        query.awaitTermination()
    return query


def land(rows: DataFrame, path: str, checkpoint: str, partitions: Sequence[str] = (),
         every: str | None = None) -> StreamingQuery:
    """Append to Parquet, exactly once: readers follow the sink's own commit log.

    No shuffle before the write, so a busy day never gathers in one task; the
    small files this leaves are folded by ``sources.tables.compact``.
    """
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    return _start(writer.partitionBy(*partitions) if partitions else writer, checkpoint, every)


def each_batch(rows: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
               every: str | None = None, mode: str = "append") -> StreamingQuery:
    return _start(rows.writeStream.foreachBatch(handle).outputMode(mode), checkpoint, every)


def land_batches(rows: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append where each micro-batch owns a folder; a repeated batch overwrites its own."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return each_batch(rows, write, checkpoint, every)


def first_start(spark: SparkSession, checkpoint: str) -> dt.datetime:
    """When a consumer started for the first time (UTC); recorded beside its checkpoint, so a restart finds it."""
    path = f"{checkpoint}-start"
    try:
        return spark.read.schema("started timestamp").parquet(path).first()["started"]
    except AnalysisException:  # no such path yet
        spark.range(1).select(F.current_timestamp().alias("started")).coalesce(1).write.parquet(path)
        return first_start(spark, checkpoint)


def only_new(messages: DataFrame, since: dt.datetime | str, time: str = "timestamp") -> DataFrame:
    """Messages that were sent at ``since`` or later."""
    return messages.filter(F.col(time) >= F.lit(since).cast("timestamp"))


def new_messages(spark: SparkSession, topic: KafkaTopic | FolderTopic, checkpoint: str,
                 max_per_trigger: int | None = None) -> DataFrame:
    """A topic from the consumer's first start on; what arrives while it is down is not lost.

    Kafka keeps the offsets of the first start itself, a folder is filtered by message time.
    """
    messages = topic.read_stream(spark, "latest", max_per_trigger)
    return messages if isinstance(topic, KafkaTopic) else only_new(messages, first_start(spark, checkpoint))


def once(messages: DataFrame, ids: Sequence[str], time: str, within: str) -> DataFrame:
    """Each message once, however often it was sent within that time; state is kept that long per id.

    A message later than ``within`` behind the newest one is dropped. State is spread by a
    hash of the ids.
    """
    return messages.withWatermark(time, within).dropDuplicatesWithinWatermark(list(ids))


@contextmanager
def state_on_cores(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep state in a few parts per core, or as many as shuffles have if that is less.

    Each micro-batch opens and commits every part, whatever it holds. A checkpoint keeps the number it began with.
    """
    name = "spark.sql.shuffle.partitions"
    usual = spark.conf.get(name)
    spark.conf.set(name, str(min(int(usual), max(LEAST_STATE_PARTS, STATE_PARTS_PER_CORE * spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def latest_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str], time: str, late: str,
                window: str = "1 day") -> DataFrame:
    """The newest row per key and window of event time, for streams in update mode.

    State is one row per key and window and is dropped when the watermark passes the window.
    Rows of a key are folded before the shuffle. Whoever stores the result keeps the newest per key.
    """
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*[F.col(f"`{c}`") for c in order])).alias("_newest")
    folded = rows.withWatermark(time, late).groupBy(F.window(time, window).alias("_window"), *keys).agg(newest)
    return folded.select(*keys, "_newest.*").select(*[F.col(f"`{c}`") for c in rows.columns])


def publish(messages: DataFrame, topic: KafkaTopic | FolderTopic, checkpoint: str,
            every: str | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Key/value rows of a stream onto a topic; ``prepare`` makes them of each batch, for steps that a stream cannot take itself."""
    if isinstance(topic, FolderTopic):
        def write(batch: DataFrame, batch_id: int) -> None:
            batch = as_envelope(prepare(batch)) if prepare else batch
            topic.write(batch, f"{topic.path}/batch-{batch_id}", "overwrite")

        return each_batch(messages if prepare else as_envelope(messages), write, checkpoint, every)
    if prepare:
        return each_batch(messages, lambda batch, batch_id: topic.publish(prepare(batch)), checkpoint, every)
    writer = (
        messages.select("key", "value").writeStream.format("kafka")
        .option("kafka.bootstrap.servers", topic.servers).option("topic", topic.topic)
        .options(**topic.options).outputMode("append")
    )
    return _start(writer, checkpoint, every)

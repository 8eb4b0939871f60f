"""Message topics: Kafka in production, a folder of envelope rows elsewhere.

Both kinds deliver the same envelope (key, value, topic, partition, offset,
timestamp), so every job downstream is the same for either.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.contracts import ENVELOPE

# Bytes of a row group, the least of a folder's file that one task reads; a batch of few files is read by many tasks.
ROW_GROUP = 8 << 20


@dataclass(frozen=True)
class KafkaTopic:
    """A Kafka topic; needs the public spark-sql-kafka connector on the class path."""

    servers: str
    topic: str
    min_partitions: int | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def read_stream(self, spark: SparkSession, starting: str = "earliest",
                    max_per_trigger: int | None = None) -> DataFrame:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", self.servers)
            .option("subscribe", self.topic)
            .option("startingOffsets", starting)
            .option("failOnDataLoss", "false")
        )
        # One task per topic partition is the default; this splits large partitions.
        if self.min_partitions:
            reader = reader.option("minPartitions", str(self.min_partitions))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger))
        return reader.options(**self.options).load()

    def publish(self, messages: DataFrame) -> None:
        (messages.select("key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", self.servers).option("topic", self.topic)
         .options(**self.options).save())


@dataclass(frozen=True)
class FolderTopic:
    """A folder (or glob) of Parquet files whose rows are message envelopes."""

    path: str

    def read_stream(self, spark: SparkSession, starting: str = "earliest",
                    max_per_trigger: int | None = None) -> DataFrame:
        """``starting`` matters only to Kafka; here see ``streaming.jobs.new_messages``."""
        reader = spark.readStream.schema(ENVELOPE).option("recursiveFileLookup", "true")
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
        return reader.parquet(self.path)

    def publish(self, messages: DataFrame) -> None:
        self.write(as_envelope(messages), self.path, "append")

    def write(self, envelopes: DataFrame, path: str, mode: str) -> None:
        envelopes.write.mode(mode).option("parquet.block.size", str(ROW_GROUP)).parquet(path)


def as_envelope(messages: DataFrame, topic: str = "local") -> DataFrame:
    """Key/value rows (and ``timestamp``, when present) in full envelope form."""
    has_time = "timestamp" in messages.columns
    return messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(None).cast("long").alias("offset"),
        (F.col("timestamp") if has_time else F.current_timestamp()).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def table_as_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A Parquet table read as a stream of its files, with the schema it is stored with.

    The name goes in as a pattern, so one file and a folder of files both work.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(f"{folder}/{{{name}}}")

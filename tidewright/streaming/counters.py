"""Counters of running streams as rows, batch by batch.

Rows are counted as they flow by (``operators.quality.observed``); Spark reports the counters
with the progress of each batch, and a listener appends them to a Parquet table. The listener
gets a handful of numbers per batch, never rows of the stream.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql import functions as F

SCHEMA = "run_id string, batch_id long, name string, counter string, amount long"


class CounterLog(StreamingQueryListener):
    """Stores the observed counters of each batch of the session's streams at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        rows = [Row(str(progress.runId), progress.batchId, name, counter, int(amount))
                for name, counters in progress.observedMetrics.items() for counter, amount in counters.asDict().items()]
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._news:
            self.ended.add(str(event.runId))
            self._news.notify_all()

    def wait_for(self, run_id: str, seconds: float = 60) -> None:
        """Until everything a query reported before it ended is stored."""
        with self._news:
            if not self._news.wait_for(lambda: str(run_id) in self.ended, seconds):
                raise TimeoutError(f"no end reported for {run_id}")


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """name, counter, amount over all batches; a batch that was run again counts once, as last reported."""
    last = spark.read.schema(SCHEMA).parquet(path).groupBy("run_id", "batch_id", "name", "counter").agg(F.max("amount").alias("amount"))
    return last.groupBy("name", "counter").agg(F.sum("amount").alias("amount"))

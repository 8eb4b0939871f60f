"""A keyed table kept on plain Parquet, fed by micro-batches.

A batch is folded to one row per key and stored in its own folder, so a write
costs what the batch costs, whatever the size of the table. Reading applies the
batches after the last compacted base to it; while they are small the base is
not shuffled for that. ``compact`` writes a new base.

A folder counts once Spark has put its ``_SUCCESS`` file there. Each writer has folders of
its own (a stream is named after its checkpoint), so a writer that starts numbering again
from 0 on a new checkpoint overwrites nothing. A batch that is repeated overwrites its own
folder; if a base holds that folder already, the repetition is stored beside it and applies
as the newest arrival. A base lists the folders folded into it, and each row carries the
time at which it was stored, which is the order of arrival.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewright.operators.keyed import FEW, last_values_per_key, latest_per_key, merge_by_key, replace_by_key
from tidewright.streaming.jobs import each_batch

ARRIVAL = "_arrival"
REPLACE, MERGE = "replace", "merge"


@dataclass(frozen=True)
class ServingTable:
    """``mode`` says what a newer row does to an older one of the same key.

    ``replace``: the row with the later event time stands, whole, whichever came first.
    ``merge``: batches apply in arrival order, each value that is not NULL overwrites.
    """

    path: str
    keys: Sequence[str]
    order: Sequence[str]
    mode: str = REPLACE
    partition_by: Sequence[str] = ()
    changes: str = FEW  # MANY: the changes since the last base are about as large as the base

    # --- writing ---

    def apply(self, batch: DataFrame, batch_id: int, writer: str = "batch") -> None:
        """Store one batch; rows without a full key are left out, as they cannot be addressed.

        The same writer and number again stand for the same batch: it replaces what it wrote.
        """
        spark = batch.sparkSession
        folded, name, again = self._folded_names(spark), f"{writer}.{batch_id}", 0
        while name in folded:
            again += 1
            name = f"{writer}.{batch_id}.{again}"
        stamp = F.lit(time.time_ns() // 1000).cast("long")
        keyed = batch.dropna(subset=list(self.keys)).withColumn(ARRIVAL, stamp)
        fold = latest_per_key if self.mode == REPLACE else last_values_per_key
        fold(keyed, self.keys, self.order).write.mode("overwrite").parquet(self._folder("changes", name))

    def follow(self, rows: DataFrame, checkpoint: str, every: str | None = None,
               compact_every: int | None = None, output: str = "append",
               prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
        """Feed from a stream; ``compact_every`` batches the changes are folded into a new base.

        ``output`` is ``update`` for aggregates that send a row again whenever it changes. ``prepare`` makes the
        rows to store of each batch, for steps that a stream cannot take itself.
        """
        def store(batch: DataFrame, batch_id: int) -> None:
            # The id that the checkpoint gives the stream; a new checkpoint is a new writer.
            stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            self.apply(prepare(batch) if prepare else batch, batch_id, f"stream-{stream}")
            if compact_every and (batch_id + 1) % compact_every == 0:
                self.compact(batch.sparkSession)

        return each_batch(rows, store, checkpoint, every, output)

    def compact(self, spark: SparkSession) -> None:
        """Fold everything stored so far into a new base, which lists what it holds."""
        changes, held = self._committed(spark, "changes"), self._folded_names(spark)
        if not set(changes) - held:
            return  # nothing new since the last base
        table = self._folded(spark)
        if self.partition_by:
            # AQE splits a partition value that holds most rows and merges small ones.
            table = table.hint("rebalance", *self.partition_by)
        number = max(self._bases(spark), default=-1) + 1
        names = spark.createDataFrame([(name,) for name in changes], "name string")
        names.coalesce(1).write.mode("overwrite").parquet(self._folder("folded", number))
        writer = table.write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(self._folder("base", number))

    def vacuum(self, spark: SparkSession, keep: int = 2) -> None:
        """Remove bases older than the last ``keep`` and the changes they all contain.

        Readers that started on a base that is kept are not disturbed.
        """
        bases = self._bases(spark)
        if len(bases) <= keep:
            return
        oldest, present = bases[-keep], set(self._committed(spark, "changes"))
        expired = [self._folder(kind, b) for b in bases if b < oldest for kind in ("base", "folded")]
        expired += [self._folder("changes", name) for name in self._names_in(spark, oldest) & present]
        for folder in expired:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    # --- reading ---

    def read(self, spark: SparkSession) -> DataFrame:
        return self._folded(spark).drop(ARRIVAL)

    def _folded(self, spark: SparkSession) -> DataFrame:
        bases = self._bases(spark)
        held = self._folded_names(spark)
        later = [self._folder("changes", name) for name in self._committed(spark, "changes") if name not in held]
        stored = spark.read.parquet(self._folder("base", bases[-1])) if bases else None
        if not later:
            if stored is None:
                raise ValueError(f"nothing stored at {self.path}")
            return stored
        # All columns of all folders: a batch may hold a part of them, the rest is NULL there.
        changes = spark.read.option("mergeSchema", "true").parquet(*later)
        if self.mode == REPLACE:
            order = [*self.order, ARRIVAL]
            return latest_per_key(changes, self.keys, order) if stored is None else \
                replace_by_key(stored, changes, self.keys, order, self.changes)
        return last_values_per_key(changes, self.keys, [ARRIVAL]) if stored is None else \
            merge_by_key(stored, changes, self.keys, [ARRIVAL], self.changes)

    # --- folders ---

    def _folder(self, kind: str, name: str | int) -> str:
        return f"{self.path}/{kind}/{name}"

    def _bases(self, spark: SparkSession) -> list[int]:
        return sorted(int(name) for name in self._committed(spark, "base"))

    def _names_in(self, spark: SparkSession, base: int) -> set[str]:
        return {row["name"] for row in spark.read.parquet(self._folder("folded", base)).collect()}

    def _folded_names(self, spark: SparkSession) -> set[str]:
        """Change folders that the last base holds; one name per batch that is still stored."""
        bases = self._bases(spark)
        return self._names_in(spark, bases[-1]) if bases else set()

    def _committed(self, spark: SparkSession, kind: str) -> list[str]:
        path_of = spark._jvm.org.apache.hadoop.fs.Path
        root = path_of(f"{self.path}/{kind}")
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        folders = [status.getPath() for status in fs.listStatus(root)]
        return sorted(f.getName() for f in folders if fs.exists(path_of(f, "_SUCCESS")))

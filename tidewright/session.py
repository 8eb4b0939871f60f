"""Session set-up and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Zone-less timestamps are taken as UTC throughout.
    "spark.sql.session.timeZone": "UTC",
    # The JVM leaves methods above 8000 bytes of bytecode uncompiled. Wide messages
    # (30 columns and more) pass that in one fused method and then run ten times
    # slower; below the limit Spark splits the projection into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "tidewright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on: UTC, ANSI on, AQE on.

    Cluster sizing (executors, shuffle partitions, split size) is left to
    spark-defaults / spark-submit, so nothing tuned for one machine is baked in.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **RUNTIME_SETTINGS,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_settings(spark: SparkSession) -> SparkSession:
    """The settings a session made elsewhere can still take."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return os.path.join(tempfile.gettempdir(), f"tidewright-{os.getpid()}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/tidewright/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives executor loss and is computed once."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)

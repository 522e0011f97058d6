"""Session set-up and the one place that knows where checkpoints go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A session with the settings every job here relies on (UTC days, AQE, Arrow)."""
    builder = (
        SparkSession.builder.master(master)
        .appName("airgrid")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_checkpoints(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from the session whenever the cluster names one.

    A private folder is made only for a local master; elsewhere a missing setting is an error,
    because a checkpoint on one machine's disk is lost with that machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="airgrid-checkpoint-")
    context.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write the rows once to a table in the shared checkpoint folder and continue from there.

    Unlike a checkpoint this computes the rows a single time, and the next step reads columns. With
    ``by`` the table has a folder per value of that column, and a filter on it opens no other.
    """
    path = f"{use_checkpoints(df.sparkSession)}/step-{uuid.uuid4().hex}"
    df.write.partitionBy(*([by] if by else [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Reading the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airgrid.session import cut_lineage, use_checkpoints

__all__ = ["cut_lineage", "read", "use_checkpoints"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")

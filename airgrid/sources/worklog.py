"""What is finished, what is left, and what can be used."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.joins import pending
from ..operators.regions import region_cells


MANIFEST = "_finished"


def finished(spark: SparkSession, path: str, keys: list[str], schema: str) -> DataFrame:
    """Key combinations recorded as finished under ``path``; none when nothing is.

    Reads the manifest beside the output and never the output itself, so the cost is one row per
    combination. Output without an entry counts as unfinished: its job did not come to its end.
    """
    try:
        return spark.read.schema(schema).parquet(f"{path}/{MANIFEST}").select(*keys).distinct()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema).select(*keys)


def record_finished(done: DataFrame, path: str, keys: list[str]) -> None:
    """Add key combinations to the manifest; call it after their output has been written.

    Combinations may be recorded again. The folder's name begins with an underscore, so readers of
    the output do not see it.
    """
    done.select(*keys).distinct().coalesce(1).write.mode("append").parquet(f"{path}/{MANIFEST}")


def unfinished(wanted: DataFrame, done: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """Wanted keys without output; ``force`` asks for everything again."""
    return pending(wanted, done, keys, force)


def availability(regions: DataFrame, done: DataFrame, region: str = "region") -> DataFrame:
    """One row per original cell with a flag whether its region is finished."""
    flags = done.select(region).distinct().withColumn("avail", F.lit(True))
    flagged = regions.join(flags, region, "left").fillna(False, subset=["avail"])
    return region_cells(flagged, region)

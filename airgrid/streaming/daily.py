"""Daily cell means kept up to date while readings arrive (D2 as a stream, X1)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalars import nan_to_null


def daily_means(
    readings: DataFrame, cell: str, time: str, value: str, late: str = "30 days"
) -> DataFrame:
    """D2 on a stream: ``(cell, date, value, n)``, missing values (also NaN) skipped.

    State is one sum and count per cell and day; days are closed and forgotten when the latest
    reading is ``late`` past their end, and readings that come later still are dropped. Days are
    UTC days in any session. Readings without a time belong to no day.
    """
    timed = readings.where(F.col(time).isNotNull()).withWatermark(time, late)
    present = nan_to_null(F.col(value))
    days = timed.groupBy(F.col(cell), F.window(time, "1 day").alias("_day")).agg(
        F.avg(present).alias(value), F.count(present).alias("n")
    )
    date = F.date_from_unix_date(F.floor(F.unix_seconds(F.col("_day.start")) / 86400).cast("int"))
    return days.select(cell, date.alias("date"), value, "n")


def keep_updated(means: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start writing changed days to ``path``, one folder per batch; see :func:`latest`.

    A batch that is repeated after a failure replaces its own folder, so every change counts once.
    ``trigger`` is passed on (``availableNow=True`` ends when all present input has been read).
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = means.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(write).trigger(**(trigger or {"processingTime": "1 minute"})).start()


def latest(spark: SparkSession, path: str, schema: str, keys: list[str]) -> DataFrame:
    """The newest row per key of what :func:`keep_updated` wrote; none when there is no batch yet.

    One aggregation that combines before its shuffle. ``schema`` is that of the means.
    """
    try:
        rows = spark.read.schema(f"{schema}, batch long").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_row"))
    return newest.select(*keys, "_row.*")

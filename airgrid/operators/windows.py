"""Day-ordered windows per cell."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalars import nan_to_null


def _by_day(by: list[str], date: str):
    return Window.partitionBy(*by).orderBy(F.col(date))


def neighbor_days(df: DataFrame, by: list[str], date: str, value: str) -> DataFrame:
    """Previous and next row's value."""
    days = _by_day(by, date)
    return df.withColumns(
        {
            f"{value}_ytd": F.lag(value, 1).over(days),
            f"{value}_tmw": F.lead(value, 1).over(days),
        }
    )


def moving_mean(
    df: DataFrame,
    by: list[str],
    date: str,
    value: str,
    out: str,
    direction: str = "centred",
    days: int = 1,
    gapless: bool = True,
) -> DataFrame:
    """Mean over neighbouring days, missing values (also NaN) skipped.

    ``centred`` uses ``days`` on both sides (it looks into the future); ``trailing`` uses only the
    past. With ``gapless=False`` the frame is counted in days, so absent rows are not bridged.
    A partition is one cell, whose length is bounded by the calendar.
    """
    ahead = days if direction == "centred" else 0
    if gapless:
        frame = _by_day(by, date).rowsBetween(-days, ahead)
    else:
        number = F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
        frame = Window.partitionBy(*by).orderBy(number).rangeBetween(-days, ahead)
    return df.withColumn(out, F.avg(nan_to_null(F.col(value))).over(frame))


def share_of_total(df: DataFrame, count: str, out: str = "percent") -> DataFrame:
    """Percent of the grand total; the input is a small table of class counts."""
    total = df.agg(F.sum(count).alias("_total"))
    share = F.try_divide(F.col(count) * F.lit(100.0), F.col("_total"))
    return df.crossJoin(F.broadcast(total)).withColumn(out, share).drop("_total")

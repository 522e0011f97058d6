"""Grouped summaries of observations, cells and classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.aggregates import strict_mean, strict_sum
from . import grid
from .quantiles import profile
from .windows import share_of_total


def station_days(readings: DataFrame, by: list[str], value: str = "pm25") -> DataFrame:
    """Mean of co-located monitors per station and day; missing if one reading is missing."""
    return readings.groupBy(*by).agg(strict_mean(F.col(value)).alias(value))


def sector_totals(emissions: DataFrame, by: list[str], value: str = "total") -> DataFrame:
    """D3: emission sums for all years and sectors in one pass; missing if a part is missing."""
    return emissions.groupBy(*by).agg(strict_sum(F.col(value)).alias(value))


def count_share(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows and percent of all rows per class."""
    return share_of_total(df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")), "n")


def lowest_row(df: DataFrame, value: str, seq: str, by: list[str] | None = None) -> DataFrame:
    """The row with the lowest value; of equal ones the first in ``seq``."""
    order = F.struct(F.col(value), F.col(seq))
    present = df.where(F.col(value).isNotNull())
    best = present.groupBy(*(by or [])).agg(F.min_by(F.struct(*df.columns), order).alias("_row"))
    return best.where("_row IS NOT NULL").select("_row.*")


def distinct_counts(df: DataFrame, cell: str, year: str) -> DataFrame:
    """Distinct cells, and distinct (cell, year) pairs, in one distinct pass."""
    pairs = df.groupBy(cell, year).agg(F.count(F.lit(1)).alias("_n"))
    per_cell = pairs.groupBy(cell).agg(F.count(F.lit(1)).alias("_pairs"))
    return per_cell.agg(
        F.count(F.lit(1)).alias("n_cells"), F.sum("_pairs").alias("n_cell_years")
    )


def resolution_share(cells: DataFrame, cell: str) -> DataFrame:
    """Cells per resolution and their percentage."""
    return count_share(cells.select(grid.resolution(F.col(cell)).alias("res")), ["res"])


def density(population: Column, area: Column) -> Column:
    """Population per square metre."""
    return F.try_divide(population, area)


def rows_per_day(obs: DataFrame, days: DataFrame, date: str = "date") -> DataFrame:
    """Rows per calendar day, zero included; every day of ``days`` has exactly one row."""
    counted = obs.groupBy(date).agg(F.count(F.lit(1)).alias("n"))
    return days.join(counted, date, "left").fillna(0, subset=["n"])


def rows_per_cell(obs: DataFrame, cell: str = "cell") -> DataFrame:
    """Rows per cell."""
    return obs.groupBy(cell).agg(F.count(F.lit(1)).alias("n"))


def class_of(value: Column, breaks: list[float]) -> Column:
    """Index of the right-open class a value falls in; the last class is closed."""
    last = len(breaks) - 2
    pick = F.when(value == breaks[-1], F.lit(last))
    for i in range(last + 1):
        pick = pick.when((value >= breaks[i]) & (value < breaks[i + 1]), F.lit(i))
    return pick


def class_counts(df: DataFrame, value: str, breaks: list[float]) -> DataFrame:
    """Rows per fixed class of a rounded value; values outside all classes are NULL."""
    return (
        df.groupBy(class_of(F.round(value), breaks).alias("class"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def ratio_profile(df: DataFrame, by: list[str], top: str, bottom: str) -> DataFrame:
    """Profile of a ratio of two measures."""
    return profile(df.withColumn("ratio", F.try_divide(top, bottom)), by, "ratio")


def below_threshold(df: DataFrame, value: str, threshold: float) -> DataFrame:
    """Rows at or under a size threshold."""
    return df.where(F.col(value) <= threshold)


def ranked(df: DataFrame, value: str) -> DataFrame:
    """T5: a report table, largest first; equal values in the order of the other columns."""
    return df.orderBy(F.desc(value), *[c for c in df.columns if c != value])

"""Accuracy report and de-identified regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.aggregates import strict_mean
from ..operators import grid
from ..operators.metrics import (
    accuracy_metrics,
    across_cells,
    add_interval,
    cell_errors,
    stack_predictions,
    temporal_rollup,
)
from ..operators.polygons import areal_interpolate, cells_touching
from ..operators.regions import merge_to_threshold


def evaluation_rows(predicted: DataFrame, obs: DataFrame, match: str = "fanout") -> DataFrame:
    """One row per prediction kind and observation of the same cell and day, with intervals.

    ``fanout`` keeps every observation of a cell-day; ``cell_mean`` averages them first.
    """
    long = stack_predictions(predicted, ["year", "cell", "date"])
    if match == "cell_mean":
        obs = obs.groupBy("cell", "date").agg(F.avg("pm25").alias("pm25"))
    return add_interval(long.join(obs.select("cell", "date", "pm25"), ["cell", "date"], "left"))


def accuracy_report(rows: DataFrame, digits: int = 2) -> dict[str, DataFrame]:
    """The report tables, rounded."""
    overall = accuracy_metrics(rows, ["oob"])
    yearly = yearly_accuracy(rows)
    by_time = across_cells(cell_errors(temporal_rollup(rows)))
    return {
        "overall": rounded(overall, digits),
        "by_year": rounded(yearly, digits),
        "by_time": rounded(by_time, digits),
    }


def yearly_accuracy(rows: DataFrame) -> DataFrame:
    """Out-of-bag accuracy and mean measured value per year."""
    oob = rows.where("oob = 'oob'")
    measured = oob.groupBy("year").agg(strict_mean(F.col("pm25")).alias("mean_measured_pm"))
    return accuracy_metrics(oob, ["year"]).join(measured, "year", "left")


def rounded(df: DataFrame, digits: int = 2) -> DataFrame:
    """All floating-point columns rounded for a report."""
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def safe_regions(
    cells: DataFrame,
    boundary: DataFrame,
    tracts: DataFrame,
    res: int = 3,
    threshold: float = 20000.0,
) -> DataFrame:
    """Cells touching the boundary, their population, merged to the threshold. Starts jobs."""
    inside = cells_touching(cells.select("cell"), boundary, "cell", res)
    targets = inside.withColumn("ring", grid.boundary(F.col("cell"), res))
    people = areal_interpolate(tracts, targets, "population", "cell").fillna(
        0.0, subset=["population"]
    )
    named = people.select(F.col("cell").cast("string").alias("region"), "cell", "population")
    edges = grid.region_edges(named, "cell", "region", res)
    return merge_to_threshold(named.drop("cell"), edges, threshold=threshold)

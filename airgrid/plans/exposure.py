"""Daily neighbour exposure per coarse cell."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.joins import cell_days
from ..operators.neighbors import cell_day_mean, idw_neighbors
from ..operators.windows import moving_mean


def neighbor_exposure(
    obs: DataFrame,
    cells: DataFrame,
    days: DataFrame,
    res: int,
    k: int = 5,
    direction: str = "centred",
) -> DataFrame:
    """Three-day mean of the inverse-distance neighbour mean, for every cell and day.

    ``obs`` is ``(cell, date, pm25)`` with cells at ``res``; ``cells`` and ``days`` span the output.
    Shuffles: by cell-day, by (day, block), by target cell-day, and by cell for the day window. The
    third also carries targets outside the output, at most one ring of ``k`` steps; the last one
    carries rows of the output grid only, whose size is cells times calendar days.
    """
    today = idw_neighbors(cell_day_mean(obs, "cell", "date", "pm25"), res, k=k, out="today")
    full = cell_days(cells.select("cell"), days.select("date")).join(
        today, ["cell", "date"], "left"
    )
    return moving_mean(full, ["cell"], "date", "today", "nearby_pm", direction)


def missing_days(exposure: DataFrame) -> DataFrame:
    """Days without a value, per cell."""
    return exposure.groupBy("cell").agg(
        F.count_if(F.col("nearby_pm").isNull()).alias("n_missing")
    )

"""Inverse-distance-squared neighbour means."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import inverse_square_weight, nan_to_null
from . import grid


def cell_day_mean(obs: DataFrame, cell: str, date: str, value: str) -> DataFrame:
    """Mean per cell and day, missing values (also NaN) skipped."""
    return obs.groupBy(cell, date).agg(F.avg(nan_to_null(F.col(value))).alias(value))


def idw_neighbors(
    cell_day: DataFrame,
    res: int,
    cell: str = "cell",
    date: str = "date",
    value: str = "pm25",
    k: int = 5,
    center_weight: float = 100.0,
    block_levels: int = 2,
    out: str = "nearby",
) -> DataFrame:
    """Weighted mean of the cells within ``k`` steps, for every cell that has a neighbour value.

    Values are scattered from the cells that have one; days without a value carry no weight, so the
    result equals the mean over a full cell x day x neighbour table, which is never built.

    Scattering multiplies rows by ``3k(k+1)+1``. Rows are first brought together by (day, block of
    nearby cells), so neighbours of one block meet in one task and the partial sums shrink again
    before the final shuffle; only block rims travel twice. A hot day is spread over its blocks.
    """
    clean = cell_day.withColumn(value, nan_to_null(F.col(value)))
    present = clean.where(F.col(value).isNotNull()).select(cell, date, value)
    blocked = grid.add_parent(present, cell, res, max(res - block_levels, 0), "_block")
    together = blocked.repartition(F.col(date), F.col("_block")).drop("_block")
    scattered = grid.explode_disk(together, cell, res, k, "_target", "_distance").withColumn(
        "_weight", inverse_square_weight(F.col("_distance"), center_weight)
    )
    return (
        scattered.groupBy(F.col("_target").alias(cell), date)
        .agg(
            F.sum(F.col(value) * F.col("_weight")).alias("_top"),
            F.sum("_weight").alias("_bottom"),
        )
        .select(cell, date, F.try_divide("_top", "_bottom").alias(out))
    )

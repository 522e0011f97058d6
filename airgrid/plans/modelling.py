"""Fitting, predicting and scoring by year."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalars import significant
from ..operators.forest import YearForests, cluster_forest
from ..session import cut_lineage
from ..sources.files import write_partitioned
from ..sources.worklog import finished, record_finished, unfinished

# What one folder of predictions holds.
PAIR = ["region", "year"]

# The folders' own key: the id of a merged region names all of its cells and may be longer than a
# file system lets a name be, so the folder has a digest of fixed length and the id is in the rows.
FOLDER = "region_key"


def folder_key(region: str = "region") -> Column:
    """``region_key`` of a region id, to read the folder of one region only."""
    return F.sha2(F.col(region).cast("string"), 256)

# The predictors kept after elimination.
PREDICTORS = ["nearby_pm", "x", "doy", "air_2m", "nei_event", "hpbl", "y", "vwnd_10m"]


def fit_and_predict(
    train: DataFrame,
    features: list[str],
    label: str = "pm25",
    cluster: str = "cell",
    digits: int = 4,
    **settings,
) -> tuple[YearForests, DataFrame]:
    """P10: forests per year, and in-bag and out-of-bag predictions of the training rows.

    The label is rounded to ``digits`` significant digits before fitting, and so are the predictions.
    Fitting starts jobs; the returned predictions are lazy.
    """
    rounded = train.withColumn(label, significant(F.col(label).cast("double"), digits))
    forests = cluster_forest(rounded, features, label, cluster, **settings)
    scored = forests.score(rounded, oob=True)
    return forests, scored.select(
        cluster,
        "date",
        forests.by,
        label,
        significant(F.col("pred_oob"), digits).alias("pred_oob"),
        significant(F.col("se_oob"), digits).alias("se_oob"),
        significant(F.col("pred"), digits).alias("pred_inbag"),
        significant(F.col("se"), digits).alias("se_inbag"),
    )


def predictions(grid_rows: DataFrame, forests: YearForests, digits: int = 8) -> DataFrame:
    """K6: ``(region, year, cell, date, pm_pred, pm_se)``; a narrow plan, so any region size works."""
    scored = forests.score(grid_rows)
    return scored.select(
        "region",
        "year",
        "cell",
        "date",
        significant(F.col("pred"), digits).alias("pm_pred"),
        significant(F.col("se"), digits).alias("pm_se"),
    )


def score_regions(
    spark: SparkSession,
    wanted: DataFrame,
    grid_of: Callable[[DataFrame], DataFrame],
    forests: YearForests,
    path: str,
    force: bool = False,
) -> DataFrame:
    """Score the unfinished ones of the ``wanted`` (region, year) pairs, one folder per pair.

    Folders are ``region_key=<sha-256 of the region's id>/year=<year>``; ``region`` is a column of
    the rows, so ids of any length can be written and are read back as they are.

    What is finished is read from the manifest beside the output. ``grid_of`` gets the pairs that
    are left and returns their grid rows, so the grid of finished pairs is never built; the manifest
    grows only after the pairs' folders are complete. Returns the pairs scored by this call.

    Output is spread by month as well, so that one very large region is written by many tasks.
    Folders of other pairs are not touched. Years without a model are an error before any grid is
    built, as their folders would otherwise look finished or stay missing without a word.
    """
    done = finished(spark, path, PAIR, "region string, year int")
    pairs = wanted.select(F.col("region").cast("string"), F.col("year").cast("int")).distinct()
    left = cut_lineage(unfinished(pairs, done, PAIR, force))
    if missing := forests.missing_years(left):
        raise ValueError(f"no model for {missing}")
    if left.isEmpty():
        return left
    rows = predictions(grid_of(left), forests)
    rows = rows.withColumns({"month": F.month("date"), FOLDER: folder_key()})
    write_partitioned(rows, path, [FOLDER, "year"], spread=["month"])
    record_finished(left, path, PAIR)
    return left

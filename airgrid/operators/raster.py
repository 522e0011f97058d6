"""Raster operations on long pixel tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.quality import quality_keep
from ..functions.scalars import nan_to_null


@dataclass(frozen=True)
class RasterFrame:
    """Extent and shape of a regular raster; defaults are those of the weather grid."""

    nrows: int = 277
    ncols: int = 349
    xmin: float = -16231.49
    xmax: float = 11313351.0
    ymin: float = -16231.5
    ymax: float = 8976020.0

    @property
    def xres(self) -> float:
        return (self.xmax - self.xmin) / self.ncols

    @property
    def yres(self) -> float:
        return (self.ymax - self.ymin) / self.nrows


WEATHER_FRAME = RasterFrame()


def raster_cell(x: Column, y: Column, frame: RasterFrame = WEATHER_FRAME) -> Column:
    """C14: 1-based cell number, row by row from the top left; outside the extent NULL.

    Points on the right or bottom edge belong to the last column or row.
    """
    column = F.when(x == frame.xmax, frame.ncols - 1).otherwise(
        F.floor((x - frame.xmin) / frame.xres)
    )
    row = F.when(y == frame.ymin, frame.nrows - 1).otherwise(
        F.floor((F.lit(frame.ymax) - y) / frame.yres)
    )
    inside = x.between(frame.xmin, frame.xmax) & y.between(frame.ymin, frame.ymax)
    return F.when(inside, row * frame.ncols + column + 1)


def raster_points(
    pixels: DataFrame, value: str, x0: float, y0: float, xres: float, yres: float
) -> DataFrame:
    """Pixel centres as points; missing pixels are dropped."""
    return pixels.where(F.col(value).isNotNull()).withColumns(
        {
            "x": F.lit(x0) + (F.col("col") + 0.5) * xres,
            "y": F.lit(y0) - (F.col("row") + 0.5) * yres,
        }
    )


def composite(
    pixels: DataFrame, bit_order: str = "documented", by: tuple[str, ...] = ("date", "tile", "row", "col")
) -> DataFrame:
    """Mean over layers of the pixels whose quality flag allows them; none left gives NULL."""
    kept = F.when(quality_keep(F.col("qa"), bit_order), nan_to_null(F.col("value")))
    return pixels.groupBy(*by).agg(F.avg(kept).alias("value"))


def mosaic(
    tiles: DataFrame, rank: str, by: tuple[str, ...] = ("date", "row", "col")
) -> DataFrame:
    """Where tiles overlap, the first tile (lowest rank) with a value wins."""
    present = F.when(F.col("value").isNotNull(), F.col(rank))
    return tiles.groupBy(*by).agg(F.min_by("value", present).alias("value"))


def completion_log(days: DataFrame, pixels: DataFrame, date: str = "date") -> DataFrame:
    """For every wanted day whether it has valid pixels, only missing ones, or no input."""
    seen = pixels.groupBy(date).agg(F.count("value").alias("_valid"))
    status = (
        F.when(F.col("_valid").isNull(), "no_input")
        .when(F.col("_valid") == 0, "no_valid")
        .otherwise("ok")
    )
    return days.join(seen, date, "left").select(date, status.alias("status"))


def zonal_summary(
    pixels: DataFrame, by: list[str], measures: list[str], class_col: str, classes: dict[str, object]
) -> DataFrame:
    """Mean of each measure and percent of pixels in each named class, per zone.

    A mean skips missing pixels; a share counts them in the whole.
    """
    means = [F.avg(m).alias(m) for m in measures]
    shares = [
        (F.count_if(F.col(class_col) == code) * 100.0 / F.count(F.lit(1))).alias(name)
        for name, code in classes.items()
    ]
    return pixels.groupBy(*by).agg(*means, *shares)

"""Satellite, land-cover, weather and population surfaces on the grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.projection import albers, albers_inverse, lambert, sinusoidal_inverse
from ..operators import grid
from ..operators.joins import expand_interval, nearest_vintage, update_join
from ..operators.polygons import areal_interpolate, cells_touching
from ..operators.raster import (
    WEATHER_FRAME,
    RasterFrame,
    composite,
    mosaic,
    raster_cell,
    raster_points,
)
from ..operators.rollup import density

WEATHER = ["hpbl", "vis", "uwnd_10m", "vwnd_10m", "air_2m", "rhum_2m", "prate", "pres_sfc"]


def clean_aerosol(
    pixels: DataFrame,
    affine: tuple[float, float, float, float],
    res: int = 8,
    bit_order: str = "documented",
    sinusoidal: bool = True,
) -> DataFrame:
    """P5: masked, layer-averaged, mosaicked pixels as ``(date, cell, aod, seq)``.

    ``pixels`` is ``(date, tile_rank, layer, row, col, value, qa)``; ``affine`` is the left and top
    edge and the pixel size. Several pixels may share a cell; ``seq`` gives their raster order.
    """
    tiles = composite(pixels, bit_order, by=("date", "tile_rank", "row", "col"))
    points = raster_points(mosaic(tiles, "tile_rank"), "value", *affine)
    if sinusoidal:
        lon, lat = sinusoidal_inverse(F.col("x"), F.col("y"))
        x, y = albers(lon, lat)
        points = points.withColumns({"x": x, "y": y})
    order = F.col("row").cast("bigint") * F.lit(1 << 31) + F.col("col")
    return grid.add_cell(points, "x", "y", res).select(
        "date", "cell", F.col("value").alias("aod"), order.alias("seq")
    )


def land_cover_years(
    obs: DataFrame, land_cover: DataFrame, vintages: list[int], measures: list[str]
) -> DataFrame:
    """Land cover of the closest vintage for every observed (cell, year)."""
    wanted = obs.select("cell", F.year("date").alias("year")).distinct()
    tagged = wanted.withColumn("nlcd_year", nearest_vintage(F.col("year"), vintages))
    return tagged.join(land_cover, ["cell", "nlcd_year"], "left").select("cell", "year", *measures)


def add_weather_cell(
    df: DataFrame,
    x: str = "x",
    y: str = "y",
    frame: RasterFrame = WEATHER_FRAME,
    out: str = "weather_cell",
) -> DataFrame:
    """The weather raster's cell under each point of the equal-area plane.

    The raster lies in its own conic plane, so points go to degrees and from there into that plane.
    Points outside the raster get NULL.
    """
    lon, lat = albers_inverse(F.col(x), F.col(y))
    degrees = grid.pin(df, "_deg", F.struct(lon.alias("lon"), lat.alias("lat")))
    wx, wy = lambert(F.col("_deg.lon"), F.col("_deg.lat"))
    there = grid.pin(degrees, "_cone", F.struct(wx.alias("x"), wy.alias("y")))
    at = raster_cell(F.col("_cone.x"), F.col("_cone.y"), frame)
    return grid.pin(there, out, at).drop("_deg", "_cone")


def weather_days(
    obs: DataFrame,
    weather: DataFrame,
    measures: list[str],
    res: int = 8,
    frame: RasterFrame = WEATHER_FRAME,
) -> DataFrame:
    """Weather on every day of each observation, from the raster cell under its cell's centre.

    ``obs`` is ``(cell, start_date, end_date)``.
    """
    x, y = grid.center(F.col("cell"), res)
    placed = add_weather_cell(obs.withColumns({"_x": x, "_y": y}), "_x", "_y", frame)
    daily = expand_interval(placed.drop("_x", "_y"), "start_date", "end_date", "date")
    return update_join(daily, weather, ["weather_cell", "date"], measures).drop(
        "start_date", "end_date"
    )


def population_density(
    cells: DataFrame, tracts: DataFrame, res: int = 5, cell: str = "cell"
) -> DataFrame:
    """Population of each cell by shared area, and people per square metre."""
    targets = cells.select(cell).withColumn("ring", grid.boundary(F.col(cell), res))
    people = areal_interpolate(tracts, targets, "population", cell)
    area = F.lit(grid.cell_area(res))
    return people.withColumns(
        {"area": area, "population_density": density(F.col("population"), area)}
    )


def grid_cover(boundary: DataFrame, coarse: int = 2, fine: int = 8) -> DataFrame:
    """Compact set of ``fine`` cells under every coarse cell that touches the boundary.

    ``boundary`` is a polygon table; the scan covers its bounding box at an even resolution.
    """
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    box = boundary.agg(
        F.min(F.array_min(xs)).alias("xmin"),
        F.max(F.array_max(xs)).alias("xmax"),
        F.min(F.array_min(ys)).alias("ymin"),
        F.max(F.array_max(ys)).alias("ymax"),
    )
    scan = grid.cells_over_box(box, "xmin", "xmax", "ymin", "ymax", coarse).select("cell")
    # Few rows here become very many, so they are spread first.
    parts = int(boundary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    covering = cells_touching(scan, boundary, "cell", coarse).repartition(parts, "cell")
    return grid.compact(grid.explode_children(covering, "cell", coarse, fine, "fine"), "fine", fine)

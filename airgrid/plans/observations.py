"""From monitor readings in degrees to station-day observations on the grid (script of the inputs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.aggregates import strict_mean
from ..functions.projection import albers
from ..functions.scalars import paste
from ..operators import grid
from ..operators.polygons import within_boundary


def place(df: DataFrame, lon: Column | None = None, lat: Column | None = None) -> DataFrame:
    """Add the equal-area ``x`` and ``y`` of points in degrees (columns ``lon``, ``lat``)."""
    x, y = albers(F.col("lon") if lon is None else lon, F.col("lat") if lat is None else lat)
    # One projection at a time: y must not be computed from a replaced x.
    at = grid.pin(df, "_xy", F.struct(x.alias("x"), y.alias("y")))
    return at.withColumns({"x": F.col("_xy.x"), "y": F.col("_xy.y")}).drop("_xy")


def station_days(readings: DataFrame, duration: str = "24 HOUR") -> DataFrame:
    """Readings of the wanted duration, averaged per station, place and day.

    ``readings`` is ``(duration, state, county, site, lat, lon, pm25, date)``. A station's id is its
    three codes; a day with a missing reading has a missing mean.
    """
    wanted = readings.where(F.col("duration") == duration)
    station = paste("-", F.col("state"), F.col("county"), F.col("site"))
    return (
        wanted.withColumn("id", station)
        .groupBy("id", "lat", "lon", "date")
        .agg(strict_mean(F.col("pm25")).alias("pm25"))
    )


def observations(readings: DataFrame, boundary: DataFrame, res: int = 8) -> DataFrame:
    """``(cell, date, pm25)`` of all station days inside the boundary.

    ``boundary`` is a polygon table in equal-area metres; :func:`ring_albers` projects one given in
    degrees. Each distinct place is projected and tested once, whatever its number of days.
    """
    days = station_days(readings)
    places = place(days.select("lon", "lat").distinct())
    inside = grid.add_cell(within_boundary(places, boundary), "x", "y", res)
    return days.join(inside.select("lon", "lat", "cell"), ["lon", "lat"]).select(
        "cell", "date", "pm25"
    )

"""Assembling the training and prediction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.calendar import is_major_holiday, weekday_text
from ..functions.scalars import set_missing
from ..operators import grid
from ..operators.joins import update_join
from ..operators.nearest import nearest_join
from ..operators.polygons import spatial_join_pip
from ..operators.raster import WEATHER_FRAME, RasterFrame
from ..sources.lookups import EMISSION_VINTAGES, vintage_of
from .surfaces import add_weather_cell

SECTORS = ["nonroad", "onroad", "nonpoint", "event"]


def locations(
    obs: DataFrame, counties: DataFrame, res: int = 8, cell: str = "cell"
) -> DataFrame:
    """P2, spatial part: each distinct cell once, with its centre and county.

    Cells whose centre lies in no county are dropped (B6).
    """
    x, y = grid.center(F.col(cell), res)
    spots = obs.select(cell).distinct().withColumns({"x": x, "y": y})
    return spatial_join_pip(spots, counties, poly_id="county_fips", how="inner")


def road_distances(spots: DataFrame, roads: DataFrame) -> DataFrame:
    """C11: distance of each location to the nearest road."""
    found = nearest_join(spots, roads, feature_id="road_id", distance="s1100_dist")
    return found.drop("road_id")


def facility_distances(spots: DataFrame, facilities: DataFrame) -> DataFrame:
    """C11 by inventory year, kept long: ``(cell, nei_year, nei_dist)``.

    Inventory years are a handful, so they are the broadcast side.
    """
    years = facilities.select("nei_year").distinct()
    asked = spots.select("cell", "x", "y").crossJoin(F.broadcast(years))
    found = nearest_join(
        asked, facilities, ["nei_year"], feature_id="site_id", distance="nei_dist"
    )
    return found.select("cell", "nei_year", "nei_dist")


def training_table(
    obs: DataFrame,
    spots: DataFrame,
    distances: DataFrame,
    nearby: DataFrame,
    population: DataFrame,
    facilities: DataFrame,
    county_emissions: DataFrame,
    weather: DataFrame,
    land_cover: DataFrame,
    aerosol: DataFrame,
    fires: DataFrame,
    weather_cols: list[str],
    land_cols: list[str],
    res: int = 8,
    pop_res: int = 5,
    near_res: int = 3,
    vintages: dict[int, tuple[int, int]] = EMISSION_VINTAGES,
) -> DataFrame:
    """One row per observation with all predictors; never more rows than observations.

    Each source is reduced to one row per key and joined once, whatever the number of its columns.
    What depends on the cell, or on cell and year, is put together on those keys first; the
    observations themselves are dealt three times: by (cell, year), by (region cell, date) and by
    (cell, date), where weather, aerosol and fires meet them without another shuffle.
    Neighbour exposure is a LEFT join: a row without it stays.
    """
    d = obs.withColumns(
        {
            "year": F.year("date"),
            "doy": F.dayofyear("date"),
            "dow": weekday_text(F.col("date")),
            "holiday": is_major_holiday(F.col("date")),
        }
    ).withColumn("nei_year", vintage_of(F.col("year"), vintages))
    by_year = _cell_years(
        d.select("cell", "year", "nei_year").distinct(),
        spots,
        distances,
        population,
        facilities,
        county_emissions,
        land_cover,
        land_cols,
        (res, pop_res),
    )
    d = d.join(by_year.drop("nei_year"), ["cell", "year"], "inner")
    d = grid.add_parent(d, "cell", res, near_res, "cell3")
    d = d.join(nearby.select(F.col("cell").alias("cell3"), "date", "nearby_pm"), ["cell3", "date"], "left")
    d = update_join(d, weather, ["cell", "date"], weather_cols)
    d = update_join(d, aerosol, ["cell", "date"], ["aod"])
    d = update_join(
        d,
        fires.select("cell", "date", "fire_pm25", F.col("area").alias("fire_area"), "seq"),
        ["cell", "date"],
        ["fire_pm25", "fire_area"],
    )
    d = d.withColumn("aod", set_missing(F.col("aod"), F.col("aod") > 2))
    return d.drop("cell3").fillna(0, subset=["nei_point", "fire_pm25", "fire_area"])


def _cell_years(
    wanted: DataFrame,
    spots: DataFrame,
    distances: DataFrame,
    population: DataFrame,
    facilities: DataFrame,
    county_emissions: DataFrame,
    land_cover: DataFrame,
    land_cols: list[str],
    levels: tuple[int, int],
) -> DataFrame:
    """All predictors of the wanted ``(cell, year, nei_year)`` that do not depend on the day.

    Cells without a place in ``spots`` are dropped.
    """
    places = grid.add_parent(spots, "cell", *levels, "cell5")
    places = update_join(
        places,
        population.select(
            F.col("cell").alias("cell5"),
            "population_density",
            F.xxhash64("population_density").alias("seq"),
        ),
        ["cell5"],
        ["population_density"],
        unique=True,
    ).drop("cell5")
    sectors = [f"nei_{s}" for s in SECTORS]
    county = county_emissions.select(
        F.col("fips").alias("county_fips"),
        "nei_year",
        *[F.col(s).alias(f"nei_{s}") for s in SECTORS],
        # Of repeated keys, whole rows are chosen by their content and not by chance.
        F.xxhash64(*SECTORS).alias("seq"),
    )
    d = wanted.join(places, "cell", "inner")
    d = update_join(d, county, ["county_fips", "nei_year"], sectors, unique=True)
    d = d.join(distances, ["cell", "nei_year"], "left")
    d = update_join(
        d,
        facilities.select("cell", "nei_year", F.col("total_emissions").alias("nei_point"), "seq"),
        ["cell", "nei_year"],
        ["nei_point"],
    )
    return update_join(d, land_cover, ["cell", "year"], land_cols)


def prediction_cells(
    regions: DataFrame,
    counties: DataFrame,
    region_res: int = 3,
    res: int = 8,
    frame: RasterFrame = WEATHER_FRAME,
) -> DataFrame:
    """P3, spatial part: every fine cell of the regions once, with centre, county and weather cell.

    ``regions`` is ``(region, cell)`` from ``region_cells``. Cells without a county are kept.
    """
    fine = grid.explode_children(
        regions.withColumnRenamed("cell", "cell3"), "cell3", region_res, res, "cell"
    )
    x, y = grid.center(F.col("cell"), res)
    spots = spatial_join_pip(fine.withColumns({"x": x, "y": y}), counties, poly_id="county_fips")
    return add_weather_cell(spots, "x", "y", frame)


def prediction_table(
    spots: DataFrame,
    nearby: DataFrame,
    county_emissions: DataFrame,
    weather: DataFrame,
    weather_cols: list[str],
    vintages: dict[int, tuple[int, int]] = EMISSION_VINTAGES,
) -> DataFrame:
    """Every fine cell of ``prediction_cells`` on every day, with the chosen predictors.

    The days of a cell are those of its neighbour exposure: cells and days outside the neighbour
    grid are dropped. Everything that varies by day is joined per (region cell, weather cell), of
    which there are thousands of times fewer than fine cells, and everything that varies by county
    per cell. The fan-out to cells and days is the last join, and its rows are not shuffled again.
    """
    # NULL (outside the raster) would not meet itself in a join.
    no_cell = F.lit(-1).cast("bigint")
    spots = spots.withColumn("_wx", F.coalesce("weather_cell", no_cell))
    daily = spots.select("cell3", "_wx", "weather_cell").distinct().join(
        nearby.select(F.col("cell").alias("cell3"), "date", "nearby_pm"), "cell3"
    )
    daily = update_join(daily, weather, ["weather_cell", "date"], weather_cols)
    daily = daily.withColumns({"year": F.year("date"), "doy": F.dayofyear("date")}).withColumn(
        "_vintage", vintage_of(F.col("year"), vintages)
    )
    # A county's few inventory years side by side.
    events = county_emissions.where(F.col("nei_year").isNotNull()).groupBy(
        F.col("fips").alias("county_fips")
    ).agg(
        *[
            F.max(F.when(F.col("nei_year") == v, F.col("event"))).alias(f"_event_{v}")
            for v in vintages
        ]
    )
    placed = spots.join(events, "county_fips", "left")
    out = placed.join(daily.drop("weather_cell"), ["cell3", "_wx"])
    event = F.coalesce(*[F.when(F.col("_vintage") == v, F.col(f"_event_{v}")) for v in vintages])
    return out.withColumn("nei_event", event).drop(
        "cell3", "_wx", "_vintage", *[f"_event_{v}" for v in vintages]
    )


def pending_grid(
    left: DataFrame,
    regions: DataFrame,
    counties: DataFrame,
    nearby: DataFrame,
    county_emissions: DataFrame,
    weather: DataFrame,
    weather_cols: list[str],
    region_res: int = 3,
    res: int = 8,
    frame: RasterFrame = WEATHER_FRAME,
    vintages: dict[int, tuple[int, int]] = EMISSION_VINTAGES,
) -> DataFrame:
    """``prediction_table`` of the (region, year) pairs in ``left`` only.

    ``regions`` is ``(region, cell)``. Regions are reduced before their cells are made, and the days
    of each region cell to the years that are left, so rows of other pairs never come to be.
    """
    cells = regions.join(left.select("region").distinct(), "region", "left_semi")
    years = regions.join(left.select("region", "year").distinct(), "region").select("cell", "year")
    days = nearby.withColumn("year", F.year("date")).join(years, ["cell", "year"], "left_semi")
    spots = prediction_cells(cells, counties, region_res, res, frame)
    return prediction_table(
        spots, days.drop("year"), county_emissions, weather, weather_cols, vintages
    )

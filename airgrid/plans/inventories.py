"""Emission and fire inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.calendar import date_of_year_day
from ..functions.scalars import pad_left, set_missing, within_box
from ..operators import grid
from ..operators.reshape import wide_by
from ..operators.rollup import sector_totals
from .observations import place

# Sectors, and the inventory years whose sector was never published.
SECTORS = ["nonroad", "onroad", "nonpoint", "event"]
NEVER_PUBLISHED = {2008: ["event"], 2017: ["onroad", "nonpoint"]}


def county_inventory(
    emissions: DataFrame,
    counties: DataFrame,
    complete: bool = False,
    missing: dict[int, list[str]] | None = None,
) -> DataFrame:
    """One row per county and inventory year, one column per sector.

    ``emissions`` is ``(fips, nei_year, eis, total)`` with any width of ``fips``. A sector without
    emissions is zero unless it was never published. Counties without emissions get one row with a
    missing year; ``complete=True`` gives every county every year instead.
    """
    padded = emissions.withColumn("fips", pad_left(F.col("fips").cast("string"), 5))
    totals = sector_totals(padded, ["nei_year", "eis", "fips"], "total")
    wide = wide_by(totals, ["fips", "nei_year"], "eis", "total", SECTORS)
    base = counties.select("fips").distinct()
    if complete:
        # Inventory years are a handful; the scaffold grows with the counties only.
        base = base.crossJoin(F.broadcast(wide.select("nei_year").distinct()))
        out = base.join(wide, ["fips", "nei_year"], "left")
    else:
        out = base.join(wide, "fips", "left")
    out = out.fillna(0, subset=SECTORS)
    for year, sectors in (NEVER_PUBLISHED if missing is None else missing).items():
        out = out.withColumns({s: set_missing(F.col(s), F.col("nei_year") == year) for s in sectors})
    return out.select("fips", "nei_year", *SECTORS)


def facility_inventory(sites: DataFrame, res: int = 8) -> DataFrame:
    """Facilities with complete records, with their cell.

    ``sites`` has either ``x`` and ``y`` or ``lon`` and ``lat`` in degrees.
    """
    if "x" not in sites.columns:
        sites = place(sites.dropna("any"))
    return grid.add_cell(sites.dropna("any"), "x", "y", res).withColumn("eis", F.lit("point"))


def fire_inventory(
    fires: DataFrame, box: tuple[float, float, float, float], res: int = 8
) -> DataFrame:
    """Fire detections with date and cell, inside the bounding box (xmin, xmax, ymin, ymax).

    ``fires`` has either ``x`` and ``y`` or ``lon`` and ``lat`` in degrees; the box is in the
    equal-area plane either way.
    """
    if "x" not in fires.columns:
        fires = place(fires)
    dated = fires.withColumn("date", date_of_year_day(F.col("yr"), F.col("doy")))
    inside = dated.where(within_box(F.col("x"), F.col("y"), *box))
    return grid.add_cell(inside, "x", "y", res).drop("yr", "doy")

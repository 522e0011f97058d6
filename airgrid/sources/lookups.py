"""Small tables given by rule: vintage maps and calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Inventory and land-cover vintages, and the years each one stands for.
EMISSION_VINTAGES = {2008: (2000, 2009), 2011: (2010, 2012), 2014: (2013, 2015), 2017: (2016, 2020)}
LAND_COVER_VINTAGES = {2001: (2000, 2003), 2006: (2004, 2008), 2011: (2009, 2013), 2016: (2014, 2020)}

# Tiles of the satellite product that cover the study area, in merging order.
SATELLITE_TILES = (
    "h08v04", "h09v04", "h10v04", "h11v04", "h12v04", "h13v04",
    "h08v05", "h09v05", "h10v05", "h11v05", "h12v05",
    "h08v06", "h09v06", "h10v06",
)


def vintage_years(spark: SparkSession, vintages: dict[int, tuple[int, int]]) -> DataFrame:
    """One row per year with its vintage."""
    rows = ", ".join(f"({v}, {a}, {b})" for v, (a, b) in vintages.items())
    return spark.sql(
        f"SELECT vintage, explode(sequence(a, b)) AS year FROM VALUES {rows} AS t(vintage, a, b)"
    )


def vintage_of(year: Column, vintages: dict[int, tuple[int, int]]) -> Column:
    """A12 as an expression: the vintage whose range holds the year, else NULL."""
    pick = F.lit(None).cast("int")
    for vintage, (low, high) in vintages.items():
        pick = F.when(year.between(low, high), F.lit(vintage)).otherwise(pick)
    return pick


def calendar(spark: SparkSession, start: str, end: str, out: str = "date") -> DataFrame:
    """Every day from ``start`` to ``end`` inclusive."""
    return spark.sql(f"SELECT explode(sequence(DATE '{start}', DATE '{end}')) AS `{out}`")


def calendar_of(df: DataFrame, date: str, out: str = "date") -> DataFrame:
    """Every day from the first to the last date of a table."""
    ends = df.agg(F.min(date).alias("a"), F.max(date).alias("b"))
    return ends.where("a IS NOT NULL").select(F.explode(F.sequence("a", "b")).alias(out))


def tile_rank(tile: Column) -> Column:
    """Merging order of a tile name; NULL for a tile outside the study area."""
    position = F.array_position(F.array(*[F.lit(t) for t in SATELLITE_TILES]), tile)
    return F.when(position > 0, position)

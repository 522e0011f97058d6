"""Polygon joins built from square tiles and Column arithmetic.

A polygon table has one row per ring: ``(poly_id, ring ARRAY<STRUCT<x, y>>)``, rings not closed.
Several rings may share a ``poly_id``: parts, or holes (for areas, holes run clockwise).

Tiles turn every spatial question into an equi-join on ``(tx, ty)``. A tile knows whether its lower
left corner lies inside and carries only the edges that reach into it. A point is inside if that
differs an odd number of times along the way from the corner up the left border and across to the
point, which never leaves the tile. Points are therefore never compared with whole polygons, and a
tile without edges needs no geometry at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from . import grid, rings
from .joins import keyed_join

TILE = 50_000.0

_EDGES = """transform(ring, (p, k) -> struct(
    p.x as x1, p.y as y1,
    ring[(k + 1) % size(ring)].x as x2, ring[(k + 1) % size(ring)].y as y2))"""


def edges_of(polygons: DataFrame, poly_id: str = "poly_id") -> DataFrame:
    """One row per polygon edge."""
    return polygons.select(poly_id, F.explode(F.expr(_EDGES)).alias("e")).select(poly_id, "e.*")


def _span(low: Column, high: Column, tile: float) -> Column:
    return F.sequence(F.floor(low / tile), F.floor(high / tile))


# One sign decides on which side of an edge a point lies, both for lines across and for lines
# upward. Points count as moved a little to the right and far less upward, so that a vertex or an
# edge on a line lies on exactly one side of it and rounding can never make two answers disagree.


def _spans_y(e: Column, y: Column) -> Column:
    return (e["y1"] <= y) != (e["y2"] <= y)


def _spans_x(e: Column, x: Column) -> Column:
    return (e["x1"] <= x) != (e["x2"] <= x)


def _turn(e: Column, x: Column, y: Column) -> Column:
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])


def _is_left(e: Column, x: Column, y: Column) -> Column:
    """Does an edge that spans ``y`` cross that line at or left of ``x``?"""
    by_sign = F.when(e["y2"] > e["y1"], _turn(e, x, y) <= 0).otherwise(_turn(e, x, y) >= 0)
    return (
        F.when((e["x1"] <= x) & (e["x2"] <= x), True)
        .when((e["x1"] > x) & (e["x2"] > x), False)
        .otherwise(by_sign)
    )


def _is_below(e: Column, x: Column, y: Column) -> Column:
    """Does an edge that spans ``x`` cross that line at or below ``y``?"""
    rising = (e["x2"] > e["x1"]) == (e["y2"] > e["y1"])
    left = F.when(e["y2"] > e["y1"], _turn(e, x, y) <= 0).otherwise(_turn(e, x, y) >= 0)
    return (
        F.when((e["y1"] <= y) & (e["y2"] <= y), True)
        .when((e["y1"] > y) & (e["y2"] > y), False)
        .otherwise(rising != left)
    )


def _tiled_edges(edges: DataFrame, tile: float) -> DataFrame:
    """One row per edge and tile that it reaches into; a long slanted edge meets few tiles."""
    rows = edges.withColumn(
        "ty", F.explode(_span(F.least("y1", "y2"), F.greatest("y1", "y2"), tile))
    )
    slope = F.try_divide(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    low = F.greatest(F.col("ty") * tile, F.least("y1", "y2"))
    high = F.least((F.col("ty") + 1) * tile, F.greatest("y1", "y2"))
    at_low, at_high = (F.col("x1") + slope * (y - F.col("y1")) for y in (low, high))
    flat = F.col("y1") == F.col("y2")
    left = F.when(flat, F.least("x1", "x2")).otherwise(F.least(at_low, at_high))
    right = F.when(flat, F.greatest("x1", "x2")).otherwise(F.greatest(at_low, at_high))
    # A tile too many does no harm, one too few would.
    spare = tile * 1e-6
    return rows.withColumn("tx", F.explode(_span(left - spare, right + spare, tile)))


def inside_corners(edges: DataFrame, tile: float, poly_id: str = "poly_id") -> DataFrame:
    """``(poly_id, tx, ty)`` of the tiles whose lower left corner lies in the polygon.

    On each line of corners, the places where edges cross it come in pairs of entering and leaving.
    """
    lines = edges.withColumn(
        "ty", F.explode(_span(F.least("y1", "y2"), F.greatest("y1", "y2"), tile))
    )
    e = F.struct("x1", "y1", "x2", "y2")
    y = F.col("ty") * tile
    lines = lines.where(_spans_y(e, y))
    at = F.col("x1") + (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1"))
    near = F.ceil(at / tile)
    # The first corner right of the crossing, by the same sign that points are judged by.
    first = (
        F.when(_is_left(e, (near - 1) * tile, y), near - 1)
        .when(_is_left(e, near * tile, y), near)
        .otherwise(near + 1)
    )
    crossings = lines.select(poly_id, "ty", first.alias("first")).groupBy(poly_id, "ty", "first").count()
    along = Window.partitionBy(poly_id, "ty").orderBy("first")
    odd = F.sum("count").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)) % 2 == 1
    runs = crossings.select(poly_id, "ty", "first", F.lead("first").over(along).alias("after"), odd.alias("odd"))
    # The last of a line's crossings always leaves.
    runs = runs.where("odd AND after IS NOT NULL")
    return runs.select(poly_id, "ty", F.explode(F.sequence("first", F.col("after") - 1)).alias("tx"))


def polygon_tiles(polygons: DataFrame, tile: float = TILE, poly_id: str = "poly_id") -> DataFrame:
    """``(poly_id, tx, ty, corner, edges)``: is the lower left corner inside, and the tile's own
    edges; NULL where there are none and the whole tile lies inside."""
    edges = edges_of(polygons, poly_id)
    own = _tiled_edges(edges, tile).groupBy(poly_id, "tx", "ty").agg(
        F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges")
    )
    corners = inside_corners(edges, tile, poly_id).withColumn("corner", F.lit(True))
    return own.join(corners, [poly_id, "tx", "ty"], "full").withColumn(
        "corner", F.coalesce("corner", F.lit(False))
    )


def _inside_tile(corner: Column, edges: Column, x: Column, y: Column, tile: float) -> Column:
    """From the lower left corner up to the height of the point, then across to it."""
    left, bottom = F.floor(x / tile) * tile, F.floor(y / tile) * tile

    def passed(e: Column) -> Column:
        up = _spans_x(e, left) & (_is_below(e, left, bottom) != _is_below(e, left, y))
        across = _spans_y(e, y) & (_is_left(e, left, y) != _is_left(e, x, y))
        return up != across

    return corner != (F.size(F.filter(edges, passed)) % 2 == 1)


def polygon_hits(
    points: DataFrame,
    polygons: DataFrame,
    x: str = "x",
    y: str = "y",
    poly_id: str = "poly_id",
    tile: float = TILE,
) -> DataFrame:
    """Distinct coordinates that lie in a polygon, with the lowest polygon id."""
    tiles = polygon_tiles(polygons, tile, poly_id)
    spots = points.select(x, y).distinct().withColumns(
        {"tx": F.floor(F.col(x) / tile), "ty": F.floor(F.col(y) / tile)}
    )
    return (
        spots.join(tiles, ["tx", "ty"])
        .where(
            F.col("edges").isNull()
            | _inside_tile(F.col("corner"), F.col("edges"), F.col(x), F.col(y), tile)
        )
        .groupBy(x, y)
        .agg(F.min(poly_id).alias(poly_id))
    )


def spatial_join_pip(
    points: DataFrame,
    polygons: DataFrame,
    x: str = "x",
    y: str = "y",
    poly_id: str = "poly_id",
    how: str = "left",
    tile: float = TILE,
) -> DataFrame:
    """The polygon each point lies in. Every point keeps exactly one row (``left``)."""
    return points.join(polygon_hits(points, polygons, x, y, poly_id, tile), [x, y], how)


def within_boundary(
    points: DataFrame, polygons: DataFrame, x: str = "x", y: str = "y", tile: float = TILE
) -> DataFrame:
    """The points inside any polygon; no dissolved outline is needed."""
    return spatial_join_pip(points, polygons, x, y, how="left_semi", tile=tile)


def cells_touching(
    cells: DataFrame, polygons: DataFrame, cell: str, res: int, tile: float = TILE
) -> DataFrame:
    """Cells whose hexagon shares at least a point with any polygon.

    True when a corner lies in a polygon, a polygon vertex lies in the hexagon, or edges cross.
    Edges meet in tiles about as large as a hexagon, so that few of them share one.
    """
    small = min(tile, 2 * grid.side(res))
    hexes = cells.select(cell).distinct().withColumn("ring", grid.boundary(F.col(cell), res))
    corners = hexes.select(cell, F.explode("ring").alias("p")).select(cell, "p.x", "p.y")
    by_corner = within_boundary(corners, polygons, tile=tile).select(cell)
    vertices = polygons.select(F.explode("ring").alias("p")).select("p.x", "p.y")
    by_vertex = grid.add_cell(vertices, "x", "y", res, cell).select(cell)
    ours = _tiled_edges(edges_of(hexes, cell), small)
    theirs = _tiled_edges(edges_of(polygons), small).select(
        "tx", "ty", *[F.col(c).alias(f"o{c}") for c in ("x1", "y1", "x2", "y2")]
    )
    by_crossing = ours.join(theirs, ["tx", "ty"]).where(_segments_meet()).select(cell)
    touching = by_corner.unionByName(by_vertex).unionByName(by_crossing).distinct()
    return cells.join(touching, cell, "left_semi")


def _segments_meet() -> Column:
    def side(ax, ay, bx, by, px, py):
        a = [F.col(c) for c in (ax, ay, bx, by, px, py)]
        return (a[2] - a[0]) * (a[5] - a[1]) - (a[3] - a[1]) * (a[4] - a[0])

    one = side("x1", "y1", "x2", "y2", "ox1", "oy1") * side("x1", "y1", "x2", "y2", "ox2", "oy2")
    two = side("ox1", "oy1", "ox2", "oy2", "x1", "y1") * side("ox1", "oy1", "ox2", "oy2", "x2", "y2")
    boxes = (
        (F.least("x1", "x2") <= F.greatest("ox1", "ox2"))
        & (F.least("ox1", "ox2") <= F.greatest("x1", "x2"))
        & (F.least("y1", "y2") <= F.greatest("oy1", "oy2"))
        & (F.least("oy1", "oy2") <= F.greatest("y1", "y2"))
    )
    return boxes & (one <= 0) & (two <= 0)


def ring_area(ring: Column) -> Column:
    """Signed area, positive for counter-clockwise rings; measured from the first corner."""

    def slice_area(p: Column, k: Column) -> Column:
        q = F.get(ring, (k + 1) % F.size(ring))
        zero = F.get(ring, F.lit(0))
        return (p["x"] - zero["x"]) * (q["y"] - zero["y"]) - (q["x"] - zero["x"]) * (
            p["y"] - zero["y"]
        )

    parts = F.transform(ring, slice_area)
    return F.aggregate(parts, F.lit(0.0), lambda total, v: total + v) / 2


def polygon_area(ring: Column) -> Column:
    """Unsigned area of one ring."""
    return F.abs(ring_area(ring))


def _boxes(df: DataFrame, prefix: str, ring: str) -> DataFrame:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return df.withColumns(
        {
            f"{prefix}x1": F.array_min(xs),
            f"{prefix}x2": F.array_max(xs),
            f"{prefix}y1": F.array_min(ys),
            f"{prefix}y2": F.array_max(ys),
        }
    )


def _parts(
    df: DataFrame, ring: str, tile: float, extent: float, corners: int, max_corners: int
) -> DataFrame:
    """``cut_to_tiles`` with each part's ``_area``, box and whether it is its ``_whole`` tile."""
    others = [f for f in df.schema.fields if f.name != ring]
    corner = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
    made = T.StructType([*others, T.StructField(ring, T.ArrayType(corner))])
    made.add("tx", T.LongType()).add("ty", T.LongType())
    for name in ("_area", "_left", "_right", "_low", "_high"):
        made.add(name, T.DoubleType())
    made.add("_whole", T.BooleanType())
    names = [f.name for f in others]
    typed = df.withColumn(ring, F.col(ring).cast(T.ArrayType(corner)))
    return typed.mapInArrow(
        rings.tile_cutter(ring, names, tile, extent, corners, max_corners), made
    )


def cut_to_tiles(
    df: DataFrame,
    ring: str,
    tile: float,
    extent: float = 0.0,
    corners: int = 0,
    max_corners: int = 64,
) -> DataFrame:
    """Rings cut at tile borders: every row has its part of the ring and that part's ``tx``, ``ty``.

    Areas add up to the ring's signed area. Halving starts at the power of two of ``tile`` that
    covers the widest ring of a batch, so a ring is handed on in parts and never copied whole to
    its tiles. Parts with more than ``max_corners`` corners are quartered further, as often as the
    batch's largest number of corners asks for. ``extent`` and ``corners`` are least values for both.
    No shuffle. Parts without an area may occur; rows without a ring, or with a corner that is
    missing or not finite, go.
    """
    kept = [c for c in df.columns if c != ring]
    return _parts(df, ring, tile, extent, corners, max_corners).select(*kept, ring, "tx", "ty")


def _dealt(df: DataFrame) -> DataFrame:
    """The rows dealt out evenly over tasks: a small file of rings has work for all of them.

    A number of its own keeps AQE from putting the rings together again by their few bytes."""
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(tasks, 4 * spark.sparkContext.defaultParallelism))


def _reach(df: DataFrame, ring: str) -> tuple[float, int]:
    """The widest extent and the largest number of corners of the rings: one row."""
    row = (
        _boxes(df.select(ring), "", ring)
        .agg(F.max(F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))), F.max(F.size(ring)))
        .head()
    )
    return float(row[0] or 0.0), int(row[1] or 0)


def areal_interpolate(
    src: DataFrame,
    dst: DataFrame,
    value: str,
    dst_key: str,
    src_key: str = "poly_id",
    tile: float = TILE,
    max_corners: int = 64,
) -> DataFrame:
    """Spread each source polygon's total over convex targets by shared area.

    ``src`` is ``(src_key, ring, value)``, ``dst`` is ``(dst_key, ring)``. Every target keeps a row;
    one that no source reaches gets NULL. Both sides are cut at tile borders first, so a part meets
    only parts of its own tile, and the shared areas of all tiles add up without a pair counted twice.
    """
    src, targets = _dealt(src.select(src_key, value, "ring")), _dealt(dst.select(dst_key, "ring"))
    shapes = src.withColumn("_area", ring_area(F.col("ring")))
    whole = shapes.groupBy(src_key).agg(F.abs(F.sum("_area")).alias("_total"))
    ours = _parts(shapes.drop("_area"), "ring", tile, 0.0, 0, max_corners)
    theirs = _parts(targets.withColumnRenamed("ring", "_hex"), "_hex", tile, 0.0, 0, max_corners)
    # A part that is its whole tile needs no ring.
    ours = ours.withColumn("ring", F.when(~F.col("_whole"), F.col("ring"))).drop("_whole")
    theirs = theirs.where("_area > 0").select(
        dst_key,
        "tx",
        "ty",
        F.when(~F.col("_whole"), F.col("_hex")).alias("_hex"),
        F.col("_area").alias("_convex_area"),
        *[F.col(c).alias(f"_convex{c}") for c in ("_left", "_right", "_low", "_high")],
    )
    pairs = ours.join(theirs, ["tx", "ty"]).where(
        (F.col("_left") <= F.col("_convex_right"))
        & (F.col("_convex_left") <= F.col("_right"))
        & (F.col("_low") <= F.col("_convex_high"))
        & (F.col("_convex_low") <= F.col("_high"))
    )
    keys = [dst_key, src_key, value]
    fields = [{f.name: f for f in pairs.schema.fields}[k] for k in keys]
    shared = pairs.select(*keys, "ring", "_hex", "_area", "_convex_area").mapInArrow(
        rings.shared_areas("ring", "_hex", keys, "_part"),
        T.StructType([*fields, T.StructField("_part", T.DoubleType())]),
    )
    per_pair = shared.groupBy(dst_key, src_key).agg(
        F.abs(F.sum("_part")).alias("_part"), F.max(value).alias(value)
    )
    given = per_pair.join(whole, src_key).groupBy(dst_key).agg(
        F.sum(F.try_divide("_part", "_total") * F.col(value)).alias(value)
    )
    return keyed_join(dst.select(dst_key), given, [dst_key], "left")

"""Grid algebra, rollups, accuracy, raster and geometry (sections C9-C13, D, E3, F, J)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from airgrid.functions import aggregates as agg, projection
from airgrid.operators import (
    grid,
    metrics,
    nearest,
    neighbors,
    polygons,
    quantiles,
    raster,
    rollup,
    windows,
)
from airgrid.plans import exposure, reports
from airgrid.session import use_checkpoints
from airgrid.sources import lookups
from airgrid.streaming import daily

from . import sqltext as q
from .bindings import bind, ctes, rectangle, table
from .registry import query

for _res in (8, 5):

    @query(
        f"cell_of_point_res{_res}",
        f"WITH {ctes('site')} SELECT site_id, cell FROM (SELECT *, {q.cell_items('x', 'y', _res, 'cell')} FROM site)",
    )
    def _cell(spark, sf, res=_res):
        """Point to cell."""
        return grid.add_cell(bind(spark, sf, "site"), "x", "y", res).select("site_id", "cell")


for _to in (5, 3, 0):

    @query(
        f"cell_parent_res{_to}",
        f"""WITH {ctes('site')}, c AS (SELECT site_id, {q.cell_items('x', 'y', 8, 'cell')} FROM site)
            SELECT site_id, up FROM (SELECT site_id, {q.parent_items('cell', 8, _to, 'up')} FROM c)""",
    )
    def _parent(spark, sf, to=_to):
        """Cell to ancestor."""
        cells = grid.add_cell(bind(spark, sf, "site"), "x", "y", 8)
        return grid.add_parent(cells, "cell", 8, to, "up").select("site_id", "up")


@query(
    "cell_children",
    f"""WITH {ctes('site')}, c AS (SELECT DISTINCT cell FROM (SELECT {q.cell_items('x', 'y', 3, 'cell')} FROM site)),
        near AS (SELECT cell, 7 * (({q.q_of('cell')})) AS bq, 7 * (({q.r_of('cell')})) AS br FROM c),
        fine AS (SELECT cell AS up, {q.pack('2 * (bq / 7) - (br / 7) + dq', '(bq / 7) + 3 * (br / 7) + dr', 4)} AS kid
          FROM near, ({q.disk(1)}))
        SELECT up, kid FROM fine""",
)
def cell_children(spark, sf):
    """The seven children of every occupied cell."""
    cells = grid.add_cell(bind(spark, sf, "site"), "x", "y", 3).select("cell").distinct()
    return grid.explode_children(cells, "cell", 3, 4, "kid").select(F.col("cell").alias("up"), "kid")


_cx, _cy = q.center_exprs("cell", 7)


@query(
    "cell_center",
    f"""WITH {ctes('site')}, c AS (SELECT site_id, {q.cell_items('x', 'y', 7, 'cell')} FROM site)
        SELECT site_id, round({_cx}, 2) AS cx, round({_cy}, 2) AS cy FROM c""",
)
def cell_center(spark, sf):
    """Cell to centre coordinates."""
    cx, cy = grid.center(F.col("cell"), 7)
    cells = grid.add_cell(bind(spark, sf, "site"), "x", "y", 7)
    return cells.select("site_id", F.round(cx, 2).alias("cx"), F.round(cy, 2).alias("cy"))


_bx, _by = q.center_exprs("cell", 6)
_s6 = q.num(q.side(6))


@query(
    "cell_boundary",
    f"""WITH {ctes('site')}, c AS (SELECT site_id, {q.cell_items('x', 'y', 6, 'cell')} FROM site)
        SELECT site_id, k, round({_bx} + {_s6} * cos(radians(60 * k - 30)), 2) AS bx,
        round({_by} + {_s6} * sin(radians(60 * k - 30)), 2) AS bry FROM c, range(0, 6) t(k)""",
)
def cell_boundary(spark, sf):
    """The six corners."""
    cells = grid.add_cell(bind(spark, sf, "site"), "x", "y", 6)
    corners = cells.select("site_id", F.posexplode(grid.boundary(F.col("cell"), 6)).alias("k", "p"))
    return corners.select(
        "site_id", F.col("k").cast("bigint").alias("k"), F.round("p.x", 2).alias("bx"), F.round("p.y", 2).alias("bry")
    )


@query(
    "cell_id_parts",
    f"""WITH {ctes('site')}, c AS (SELECT site_id, {q.cell_items('x', 'y', 8, 'cell')} FROM site)
        SELECT site_id, CAST(cell >> 58 AS INT) AS res, {q.q_of('cell')} AS q, {q.r_of('cell')} AS r,
        CAST(((({q.q_of('cell')}) + 5 * ({q.r_of('cell')})) % 7 + 7) % 7 AS INT) AS digit FROM c""",
)
def cell_id_parts(spark, sf):
    """Resolution, axial coordinates and child digit of an id."""
    c = F.col("cell")
    return grid.add_cell(bind(spark, sf, "site"), "x", "y", 8).select(
        "site_id", grid.resolution(c).alias("res"), grid.axial_q(c).alias("q"),
        grid.axial_r(c).alias("r"), grid.child_digit(c, 8).alias("digit"),
    )


@query(
    "cell_disk",
    f"""WITH {ctes('stn')}, c AS (SELECT DISTINCT cell FROM (SELECT {q.cell_items('x', 'y', 3, 'cell')} FROM stn))
        SELECT cell, {q.pack(f"{q.q_of('cell')} + dq", f"{q.r_of('cell')} + dr", 3)} AS neighbor, CAST(d AS INT) AS distance
        FROM c, ({q.disk(5)})""",
)
def cell_disk(spark, sf):
    """All cells within five steps, with distance."""
    cells = grid.add_cell(bind(spark, sf, "stn"), "x", "y", 3).select("cell").distinct()
    return grid.explode_disk(cells, "cell", 3, 5)


def _wide_cover(spark, sf):
    """Fine cells under every occupied coarse cell, plus some stray fine cells."""
    site = bind(spark, sf, "site")
    coarse = grid.add_cell(site, "x", "y", 3).select("cell").distinct()
    full = grid.explode_children(coarse, "cell", 3, 5, "fine").select("fine")
    shifted = site.selectExpr("x + 150000 AS x", "y - 400000 AS y")
    stray = grid.add_cell(shifted, "x", "y", 5, "fine").select("fine")
    return full.unionByName(stray)


@query(
    "compact_then_expand",
    f"""WITH {ctes('site')}, c AS (SELECT DISTINCT cell FROM (SELECT {q.cell_items('x', 'y', 3, 'cell')} FROM site)),
        f1 AS (SELECT {q.pack(f"2 * ({q.q_of('cell')}) - ({q.r_of('cell')}) + dq", f"({q.q_of('cell')}) + 3 * ({q.r_of('cell')}) + dr", 4)} AS cell FROM c, ({q.disk(1)})),
        f2 AS (SELECT {q.pack(f"3 * ({q.q_of('cell')}) + ({q.r_of('cell')}) + dq", f"2 * ({q.r_of('cell')}) - ({q.q_of('cell')}) + dr", 5)} AS cell FROM f1, ({q.disk(1)}))
        SELECT cell AS fine FROM f2 UNION SELECT fine FROM (SELECT {q.cell_items('(x + 150000)', '(y - 400000)', 5, 'fine')} FROM site)""",
)
def compact_then_expand(spark, sf):
    """Compacting and expanding again gives the distinct input."""
    return grid.uncompact(grid.compact(_wide_cover(spark, sf), "fine", 5), "fine", 5)


@query(
    "compact_counts",
    f"""WITH {ctes('site')}, c AS (SELECT DISTINCT cell FROM (SELECT {q.cell_items('x', 'y', 3, 'cell')} FROM site)),
        f1 AS (SELECT {q.pack(f"2 * ({q.q_of('cell')}) - ({q.r_of('cell')}) + dq", f"({q.q_of('cell')}) + 3 * ({q.r_of('cell')}) + dr", 4)} AS cell FROM c, ({q.disk(1)})),
        f2 AS (SELECT {q.pack(f"3 * ({q.q_of('cell')}) + ({q.r_of('cell')}) + dq", f"2 * ({q.r_of('cell')}) - ({q.q_of('cell')}) + dr", 5)} AS cell FROM f1, ({q.disk(1)})),
        c5 AS (SELECT cell FROM f2 UNION SELECT fine FROM (SELECT {q.cell_items('(x + 150000)', '(y - 400000)', 5, 'fine')} FROM site)),
        p5 AS (SELECT {q.parent_items('cell', 5, 4, 'up')} FROM c5), g5 AS (SELECT up, count(*) n FROM p5 GROUP BY 1),
        c4 AS (SELECT up AS cell FROM g5 WHERE n = 7),
        p4 AS (SELECT {q.parent_items('cell', 4, 3, 'up')} FROM c4), g4 AS (SELECT up, count(*) n FROM p4 GROUP BY 1),
        c3 AS (SELECT up AS cell FROM g4 WHERE n = 7),
        p3 AS (SELECT {q.parent_items('cell', 3, 2, 'up')} FROM c3), g3 AS (SELECT up, count(*) n FROM p3 GROUP BY 1),
        c2 AS (SELECT up AS cell FROM g3 WHERE n = 7),
        p2 AS (SELECT {q.parent_items('cell', 2, 1, 'up')} FROM c2), g2 AS (SELECT up, count(*) n FROM p2 GROUP BY 1),
        c1 AS (SELECT up AS cell FROM g2 WHERE n = 7),
        p1 AS (SELECT {q.parent_items('cell', 1, 0, 'up')} FROM c1), g1 AS (SELECT up, count(*) n FROM p1 GROUP BY 1),
        t AS (SELECT 5 AS res, (SELECT count(*) FROM c5) - 7 * (SELECT count(*) FROM c4) AS n
          UNION ALL SELECT 4, (SELECT count(*) FROM c4) - 7 * (SELECT count(*) FROM c3)
          UNION ALL SELECT 3, (SELECT count(*) FROM c3) - 7 * (SELECT count(*) FROM c2)
          UNION ALL SELECT 2, (SELECT count(*) FROM c2) - 7 * (SELECT count(*) FROM c1)
          UNION ALL SELECT 1, (SELECT count(*) FROM c1) - 7 * (SELECT count(*) FROM g1 WHERE n = 7)
          UNION ALL SELECT 0, (SELECT count(*) FROM g1 WHERE n = 7))
        SELECT res, n, round(n * 100.0e0 / sum(n) OVER (), 4) AS percent FROM t WHERE n > 0""",
)
def compact_counts(spark, sf):
    """Cells per resolution of a compact set, with share."""
    out = rollup.resolution_share(grid.compact(_wide_cover(spark, sf), "fine", 5), "fine")
    return out.select("res", "n", F.round("percent", 4).alias("percent"))


@query(
    "touching_regions",
    f"""WITH {ctes('site')}, c AS (SELECT DISTINCT cell, a FROM (SELECT {q.cell_items('x', 'y', 3, 'cell')}, {q.cell_items('x', 'y', 1, 'a')} FROM site)),
        o AS (SELECT cell, min(a) AS a FROM c GROUP BY 1),
        e AS (SELECT a, {q.pack(f"{q.q_of('cell')} + dq", f"{q.r_of('cell')} + dr", 3)} AS cell FROM o, ({q.disk(1)}) WHERE d = 1)
        SELECT DISTINCT e.a, o.a AS b FROM e JOIN o USING (cell) WHERE e.a <> o.a""",
)
def touching_regions(spark, sf):
    """Pairs of regions with touching cells."""
    site = bind(spark, sf, "site")
    cells = grid.add_cell(grid.add_cell(site, "x", "y", 3, "cell"), "x", "y", 1, "a")
    owners = cells.groupBy("cell").agg(F.min("a").alias("region"))
    return grid.region_edges(owners, "cell", "region", 3)


@query(
    "box_scan",
    f"""WITH b AS (SELECT n_nationkey AS k, (n_nationkey % 5) * 920000e0 - 2300000 AS xmin, (n_nationkey // 5) * 580000e0 + 300000 AS ymin FROM nation),
        r AS (SELECT *, unnest(generate_series(CAST(floor(ymin / (1.5e0 * {q.num(q.side(2))}) - 1) AS BIGINT),
          CAST(ceil((ymin + 580000) / (1.5e0 * {q.num(q.side(2))}) + 1) AS BIGINT))) AS rr FROM b),
        s AS (SELECT *, unnest(generate_series(CAST(floor(xmin / ({q.num(q.ROOT3)} * {q.num(q.side(2))}) - rr / 2 - 1) AS BIGINT),
          CAST(ceil((xmin + 920000) / ({q.num(q.ROOT3)} * {q.num(q.side(2))}) - rr / 2 + 1) AS BIGINT))) AS qq FROM r)
        SELECT k, {q.pack('qq', 'rr', 2)} AS cell FROM s""",
)
def box_scan(spark, sf):
    """Every cell that can reach a bounding box."""
    boxes = table(spark, sf, "nation").selectExpr(
        "n_nationkey AS k",
        "(n_nationkey % 5) * 920000D - 2300000 AS xmin", "(n_nationkey % 5) * 920000D - 1380000 AS xmax",
        "floor(n_nationkey / 5) * 580000D + 300000 AS ymin", "floor(n_nationkey / 5) * 580000D + 880000 AS ymax",
    )
    return grid.cells_over_box(boxes, "xmin", "xmax", "ymin", "ymax", 2).select("k", "cell")


_H3 = "((CAST(1 AS BIGINT) << 59) + (CAST(8 AS BIGINT) << 52) + (CAST({k} % 122 AS BIGINT) << 45) + ((CAST({k} AS BIGINT) * 7919 % 16777216) * 2097152) + 2097151)"


@query(
    "public_id_bits",
    f"""WITH i AS (SELECT o_orderkey, CAST({_H3.format(k='o_orderkey')} AS BIGINT) AS id FROM orders)
        SELECT o_orderkey, CAST(id // 4503599627370496 % 16 AS INT) AS res, CAST(id // 35184372088832 % 128 AS INT) AS base,
        CAST(id // 2097152 % 8 AS INT) AS last_digit,
        CAST(id // 576460752303423488 * 576460752303423488 + CAST(3 AS BIGINT) * 4503599627370496
         + id // 68719476736 % 65536 * 68719476736 + 68719476735 AS BIGINT) AS up,
        lower(hex(id)) AS text FROM i""",
)
def public_id_bits(spark, sf):
    """J2, J8 for ids of the public system: bit work only."""
    k = F.col("o_orderkey")
    one = lambda bits: F.lit(1 << bits).cast("bigint")
    ids = table(spark, sf, "orders").select(
        "o_orderkey",
        (
            one(59) + one(52) * 8 + k % 122 * one(45) + k * 7919 % 16777216 * one(21) + 2097151
        ).alias("id"),
    )
    c = F.col("id")
    return ids.select(
        "o_orderkey", grid.h3_resolution(c).alias("res"), grid.h3_base_cell(c).alias("base"),
        grid.h3_digit(c, 8).alias("last_digit"), grid.h3_parent(c, 3).alias("up"),
        grid.h3_to_text(c).alias("text"),
    )


_LL = "(-120 + o_custkey % 500 / 10.0e0) AS lon, (25 + o_orderkey % 240 / 10.0e0) AS lat"


def _lonlat(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS k", "-120 + o_custkey % 500 / 10.0D AS lon", "25 + o_orderkey % 240 / 10.0D AS lat"
    )


@query(
    "albers_projection",
    f"""WITH p AS (SELECT o_orderkey AS k_, {_LL} FROM orders)
        SELECT k_ AS k, round(x, 2) AS x, round(y, 2) AS y FROM {q.with_albers('p')}""",
)
def albers_projection(spark, sf):
    """Equal-area metres."""
    x, y = projection.albers(F.col("lon"), F.col("lat"))
    return _lonlat(spark, sf).select("k", F.round(x, 2).alias("x"), F.round(y, 2).alias("y"))


@query(
    "lambert_projection",
    f"""WITH p AS (SELECT * FROM (SELECT o_orderkey AS key, {_LL} FROM orders), {q.CONES})
        SELECT key AS k, round(x, 2) AS x, round(y, 2) AS y FROM {q.with_lambert('p', 'radians(lat)', 'radians(lon + 107)', ('x', 'y'))}""",
)
def lambert_projection(spark, sf):
    """Metres of the weather grid."""
    x, y = projection.lambert(F.col("lon"), F.col("lat"))
    return _lonlat(spark, sf).select("k", F.round(x, 2).alias("x"), F.round(y, 2).alias("y"))


@query(
    "sinusoidal_to_degrees",
    f"""WITH {ctes('site')} SELECT site_id, round(degrees(x / (cos(y / {q.num(6371007.181)}) * {q.num(6371007.181)})), 6) AS lon,
        round(degrees(y / {q.num(6371007.181)}), 6) AS lat FROM site""",
)
def sinusoidal_to_degrees(spark, sf):
    """Inverse projection of the satellite tiles."""
    lon, lat = projection.sinusoidal_inverse(F.col("x"), F.col("y"))
    return bind(spark, sf, "site").select("site_id", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query(
    "polygon_areas",
    f"WITH {ctes('county')} SELECT poly_id, (xmax - xmin) * (ymax - ymin) AS area FROM county",
)
def polygon_areas(spark, sf):
    """Area of polygons."""
    shapes = rectangle(bind(spark, sf, "county"))
    return shapes.select("poly_id", polygons.polygon_area(F.col("ring")).alias("area"))


@query(
    "point_in_polygon",
    f"""WITH {ctes('site', 'county')} SELECT site_id, poly_id FROM (SELECT site_id, x - 100000 AS x, y + 77000 AS y FROM site) s
        LEFT JOIN county ON x >= xmin AND x < xmax AND y >= ymin AND y < ymax""",
)
def point_in_polygon(spark, sf):
    """The polygon each point lies in, or none."""
    points = bind(spark, sf, "site").selectExpr("site_id", "x - 100000 AS x", "y + 77000 AS y")
    return polygons.spatial_join_pip(points, rectangle(bind(spark, sf, "county"))).select("site_id", "poly_id")


# Five corners per county, one of them a notch; no edge is parallel to an axis.
_NOTCHED = [
    ("xmin + 100000", "ymin"), ("xmax", "ymin + 200000"), ("xmax - 150000", "ymax"),
    ("xmin", "ymax - 120000"), ("xmin + 300000", "ymin + 250000"),
]


def _crossings(x: str, y: str) -> str:
    """SQL: how many edges of the notched county lie to the right of a point."""
    terms = []
    for (ax, ay), (bx, by) in zip(_NOTCHED, _NOTCHED[1:] + _NOTCHED[:1], strict=True):
        at = f"(({bx}) - ({ax})) * ({y} - ({ay})) / (({by}) - ({ay})) + ({ax})"
        terms.append(f"CASE WHEN (({ay}) <= {y}) <> (({by}) <= {y}) AND {x} < {at} THEN 1 ELSE 0 END")
    return " + ".join(terms)


def notched(df):
    ring = F.array(*[F.struct(F.expr(a).alias("x"), F.expr(b).alias("y")) for a, b in _NOTCHED])
    return df.withColumn("ring", ring)


@query(
    "point_in_slanted_polygon",
    f"""WITH {ctes('site', 'county')}, s AS (SELECT site_id, x + 777 AS x, y - 333 AS y FROM site)
        SELECT site_id, poly_id FROM s LEFT JOIN county ON x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax
          AND ({_crossings('x', 'y')}) % 2 = 1""",
)
def point_in_slanted_polygon(spark, sf):
    """Polygons with slanted edges and a notch."""
    points = bind(spark, sf, "site").selectExpr("site_id", "x + 777 AS x", "y - 333 AS y")
    return polygons.spatial_join_pip(points, notched(bind(spark, sf, "county"))).select("site_id", "poly_id")


@query(
    "points_within_boundary",
    f"""WITH {ctes('site', 'county')} SELECT site_id FROM (SELECT site_id, x - 700000 AS x, y + 900000 AS y FROM site) s
        WHERE EXISTS (SELECT 1 FROM county WHERE x >= xmin AND x < xmax AND y >= ymin AND y < ymax)""",
)
def points_within_boundary(spark, sf):
    """Points inside any part of a boundary."""
    points = bind(spark, sf, "site").selectExpr("site_id", "x - 700000 AS x", "y + 900000 AS y")
    return polygons.within_boundary(points, rectangle(bind(spark, sf, "county"))).select("site_id")


_X4, _Y4 = q.center_exprs("cell", 4)


@query(
    "cells_touching_boundary",
    f"""WITH {ctes('site', 'county')}, c AS (SELECT DISTINCT cell FROM (SELECT {q.cell_items('x', 'y', 4, 'cell')} FROM site)),
        n AS (SELECT DISTINCT {q.pack(f"{q.q_of('cell')} + dq", f"{q.r_of('cell')} + dr", 4)} AS cell FROM c, ({q.disk(1)})),
        p AS (SELECT cell, {_X4} AS hx, {_Y4} AS hy FROM n)
        SELECT DISTINCT cell FROM p, county WHERE {q.hexagon_meets_rectangle('hx', 'hy', 4)}""",
)
def cells_touching_boundary(spark, sf):
    """Hexagons that touch a boundary."""
    cells = grid.explode_disk(
        grid.add_cell(bind(spark, sf, "site"), "x", "y", 4).select("cell").distinct(), "cell", 4, 1
    ).select(F.col("neighbor").alias("cell")).distinct()
    return polygons.cells_touching(cells, rectangle(bind(spark, sf, "county")), "cell", 4, tile=100_000.0)


@query(
    "nearest_road",
    f"WITH {ctes('site', 'road')} SELECT site_id, round(min(abs(x - x1)), 4) AS distance FROM site, road GROUP BY 1",
)
def nearest_road(spark, sf):
    """C11: distance to the nearest line."""
    roads = nearest.split_segments(bind(spark, sf, "road"), 50_000.0)
    out = nearest.nearest_join(bind(spark, sf, "site"), roads, feature_id="road_id")
    return out.select("site_id", F.round("distance", 4).alias("distance"))


@query(
    "nearest_slanted_road",
    f"""WITH {ctes('site', 'stn')}, r AS (SELECT station, x AS x1, y AS y1, (station * 7919 % 601 - 300) * 1e3 AS dx, (station * 104729 % 401 - 200) * 1e3 AS dy FROM stn),
        t AS (SELECT site_id, s.x - x1 AS px, s.y - y1 AS py, dx, dy, greatest(0e0, least(1e0, ((s.x - x1) * dx + (s.y - y1) * dy) / (dx * dx + dy * dy))) AS t
          FROM site s, r WHERE dx <> 0 OR dy <> 0)
        SELECT site_id, round(min(sqrt((px - dx * t) * (px - dx * t) + (py - dy * t) * (py - dy * t))), 3) AS distance FROM t GROUP BY 1""",
)
def nearest_slanted_road(spark, sf):
    """C11: distance to the nearest of many lines in all directions, cut into pieces for the search."""
    dx, dy = (F.col("station") * 7919 % 601 - 300) * 1e3, (F.col("station") * 104729 % 401 - 200) * 1e3
    roads = bind(spark, sf, "stn").select(
        F.col("station").alias("road_id"), F.col("x").alias("x1"), F.col("y").alias("y1"), (F.col("x") + dx).alias("x2"), (F.col("y") + dy).alias("y2")
    ).where("x1 <> x2 OR y1 <> y2")
    out = nearest.nearest_join(bind(spark, sf, "site"), nearest.split_segments(roads, 50_000.0), feature_id="road_id")
    return out.select("site_id", F.round("distance", 3).alias("distance"))


@query(
    "nearest_site_by_year",
    f"""WITH {ctes('stn', 'site')} SELECT station, nei_year, round(min(sqrt((t.x - s.x) * (t.x - s.x) + (t.y - s.y) * (t.y - s.y))), 4) AS distance
        FROM stn s, site t GROUP BY 1, 2""",
)
def nearest_site_by_year(spark, sf):
    """Distance to the nearest facility of each inventory year."""
    site = bind(spark, sf, "site").selectExpr("site_id", "nei_year", "x AS x1", "y AS y1", "x AS x2", "y AS y2")
    years = site.select("nei_year").distinct()
    asked = bind(spark, sf, "stn").join(F.broadcast(years))
    out = nearest.nearest_join(asked, site, ["nei_year"], feature_id="site_id")
    return out.select("station", "nei_year", F.round("distance", 4).alias("distance"))


_SHARED_AREA_SQL = f"""WITH {ctes('county')}, t AS (SELECT site_id, x - 200000 AS x1, x + 200000 AS x2, y - 150000 AS y1, y + 150000 AS y2
        FROM ({ctes('site').split('AS (', 1)[1][:-1]}))
        SELECT site_id, round(sum((least(x2, xmax) - greatest(x1, xmin)) * (least(y2, ymax) - greatest(y1, ymin))
        / (920000e0 * 580000e0) * (CAST(poly_id AS INT) + 1) * 1000), 4) AS value
        FROM t LEFT JOIN county ON x1 < xmax AND x2 > xmin AND y1 < ymax AND y2 > ymin GROUP BY 1"""


def _interpolation_sides(spark, sf):
    src = rectangle(bind(spark, sf, "county")).withColumn("value", (F.col("poly_id").cast("int") + 1) * 1000.0)
    dst = rectangle(
        bind(spark, sf, "site").selectExpr(
            "site_id", "x - 200000 AS xmin", "x + 200000 AS xmax", "y - 150000 AS ymin", "y + 150000 AS ymax"
        )
    )
    return src, dst


@query("areal_interpolation", _SHARED_AREA_SQL)
def areal_interpolation(spark, sf):
    """Totals spread by shared area."""
    src, dst = _interpolation_sides(spark, sf)
    out = polygons.areal_interpolate(src, dst, "value", "site_id", tile=250_000.0)
    return out.select("site_id", F.round("value", 4).alias("value"))


@query("areal_interpolation_slanted", _SHARED_AREA_SQL)
def areal_interpolation_slanted(spark, sf):
    """D24 on parallelograms: a map of determinant one slants all sides and leaves every shared area as it is."""

    def slant(df):
        corner = lambda p: F.struct((p["x"] + p["y"] * 0.5).alias("x"), (p["x"] * 0.25 + p["y"] * 1.125).alias("y"))
        return df.withColumn("ring", F.transform("ring", corner))

    src, dst = (slant(df) for df in _interpolation_sides(spark, sf))
    out = polygons.areal_interpolate(src, dst, "value", "site_id", tile=100_000.0)
    return out.select("site_id", F.round("value", 4).alias("value"))


@query(
    "cell_population",
    f"""WITH {ctes('site')}, c AS (SELECT {q.cell_items('x', 'y', 5, 'cell')}, population FROM site)
        SELECT cell, sum(population) AS population, round(sum(population) / {q.num(1.5 * q.ROOT3 * q.side(5) ** 2)} * 1e6, 8) AS per_km2 FROM c GROUP BY 1""",
)
def cell_population(spark, sf):
    """Population per area."""
    cells = grid.add_cell(bind(spark, sf, "site"), "x", "y", 5).groupBy("cell").agg(F.sum("population").alias("population"))
    per = rollup.density(F.col("population"), F.lit(grid.cell_area(5))) * 1e6
    return cells.select("cell", "population", F.round(per, 8).alias("per_km2"))


@query(
    "station_day_mean",
    f"""WITH {ctes('obs')} SELECT station, date, round(CASE WHEN count(pm25) = count(*) THEN avg(pm25) END, 4) AS pm25
        FROM obs GROUP BY 1, 2""",
)
def station_day_mean(spark, sf):
    """Strict mean per station and day."""
    out = rollup.station_days(bind(spark, sf, "obs"), ["station", "date"])
    return out.select("station", "date", F.round("pm25", 4).alias("pm25"))


_OBS3 = f"{ctes('obs')}, o3 AS (SELECT {q.cell_items('x', 'y', 3, 'cell')}, date, pm25 FROM obs)"


def _obs3(spark, sf):
    return grid.add_cell(bind(spark, sf, "obs"), "x", "y", 3).select("cell", "date", "pm25")


@query(
    "cell_day_mean",
    f"WITH {_OBS3} SELECT cell, date, round(avg(pm25), 4) AS pm25 FROM o3 GROUP BY 1, 2",
)
def cell_day_mean(spark, sf):
    """Mean per coarse cell and day, missing skipped."""
    out = neighbors.cell_day_mean(_obs3(spark, sf), "cell", "date", "pm25")
    return out.select("cell", "date", F.round("pm25", 4).alias("pm25"))


@query(
    "streamed_cell_days",
    """SELECT user_id % 500 AS cell, CAST(ts AS DATE) AS date, round(avg(CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END), 4) AS value,
       count(CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1, 2""",
)
def streamed_cell_days(spark, sf):
    """D2 as a stream: events arrive in several files, and daily means are kept up to date."""
    at = f"{use_checkpoints(spark)}/stream-{uuid.uuid4().hex}"
    # The clock times of the table are UTC, whatever the session's zone.
    ts = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
    readings = table(spark, sf, "events").select(
        (F.col("user_id") % 500).alias("cell"), ts.alias("ts"), F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("value")
    )
    # Several files, so that days are opened, changed and closed over several batches.
    readings.repartitionByRange(12, "ts").write.parquet(f"{at}/in")
    arriving = spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", 4).parquet(f"{at}/in")
    # Files of one folder come in any order, so nothing may count as late here.
    means = daily.daily_means(arriving, "cell", "ts", "value", late="36500 days")
    running = daily.keep_updated(means, f"{at}/out", f"{at}/state", availableNow=True)
    running.awaitTermination()
    out = daily.latest(spark, f"{at}/out", "cell long, date date, value double, n long", ["cell", "date"])
    return out.select("cell", "date", F.round("value", 4).alias("value"), "n")


_IDW = f"""{_OBS3}, m AS (SELECT cell, date, avg(pm25) AS v FROM o3 GROUP BY 1, 2 HAVING count(pm25) > 0),
    w AS (SELECT {q.pack(f"{q.q_of('cell')} + dq", f"{q.r_of('cell')} + dr", 3)} AS cell, date, v,
      CASE WHEN d = 0 THEN 100e0 ELSE 1.0e0 / (d * d) END AS w FROM m, ({q.disk(5)})),
    idw AS (SELECT cell, date, sum(v * w) / sum(w) AS nearby FROM w GROUP BY 1, 2)"""


@query(
    "neighbor_mean",
    f"""WITH {_IDW} SELECT cell, count(*) AS days, round(min(nearby), 4) AS low, round(avg(nearby), 4) AS mean, round(max(nearby), 4) AS high
        FROM idw GROUP BY 1""",
)
def neighbor_mean(spark, sf):
    """Inverse-distance-squared mean of neighbours, summed up per cell."""
    means = neighbors.cell_day_mean(_obs3(spark, sf), "cell", "date", "pm25")
    out = neighbors.idw_neighbors(means, 3).groupBy("cell").agg(
        F.count(F.lit(1)).alias("days"), F.min("nearby").alias("low"), F.avg("nearby").alias("mean"), F.max("nearby").alias("high")
    )
    return out.select("cell", "days", *[F.round(c, 4).alias(c) for c in ("low", "mean", "high")])


_EXPOSURE = f"""{_IDW}, c AS (SELECT DISTINCT cell FROM o3), e AS (SELECT CAST(min(date) AS TIMESTAMP) a, CAST(max(date) AS TIMESTAMP) b FROM obs),
    d AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM e),
    x AS (SELECT cell, date, nearby, avg(nearby) OVER (PARTITION BY cell ORDER BY date ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS nearby_pm
      FROM (SELECT * FROM c, d) LEFT JOIN idw USING (cell, date))"""


def neighbor_exposure_rows(spark, sf):
    """P1 with its inputs; also the flagship query."""
    obs = _obs3(spark, sf)
    days = lookups.calendar_of(obs, "date")
    return exposure.neighbor_exposure(obs, obs.select("cell").distinct(), days, 3)


@query(
    "neighbor_exposure",
    f"WITH {_EXPOSURE} SELECT cell, date, round(nearby, 4) AS today, round(nearby_pm, 4) AS nearby_pm FROM x",
)
def neighbor_exposure(spark, sf):
    """D2, D5, C4, E2 end to end."""
    out = neighbor_exposure_rows(spark, sf)
    return out.select("cell", "date", F.round("today", 4).alias("today"), F.round("nearby_pm", 4).alias("nearby_pm"))


@query(
    "exposure_gaps",
    f"WITH {_EXPOSURE} SELECT cell, count(*) FILTER (WHERE nearby_pm IS NULL) AS n_missing FROM x GROUP BY 1",
)
def exposure_gaps(spark, sf):
    """Missing days per cell."""
    return exposure.missing_days(neighbor_exposure_rows(spark, sf))


@query(
    "weighted_mean",
    """SELECT l_suppkey, round(sum(CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END * l_tax)
       / nullif(sum(CASE WHEN l_linenumber = 7 THEN NULL ELSE l_tax END), 0), 4) AS m FROM lineitem GROUP BY 1""",
)
def weighted_mean(spark, sf):
    """Weighted mean, missing skipped."""
    v = F.when(F.col("l_linenumber") != 7, F.col("l_quantity"))
    out = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(agg.weighted_mean(v, F.col("l_tax")).alias("m"))
    return out.select("l_suppkey", F.round("m", 4).alias("m"))


@query(
    "class_share",
    """SELECT c_mktsegment, count(*) AS n, round(count(*) * 100.0e0 / sum(count(*)) OVER (), 4) AS percent
       FROM customer GROUP BY 1""",
)
def class_share(spark, sf):
    """Counts and percent of all."""
    out = rollup.count_share(table(spark, sf, "customer"), ["c_mktsegment"])
    return out.select("c_mktsegment", "n", F.round("percent", 4).alias("percent"))


@query(
    "value_profile",
    """SELECT l_returnflag, count(*) AS n, min(l_extendedprice) AS min, round(avg(l_extendedprice), 2) AS mean, max(l_extendedprice) AS max,
       round(var_samp(l_extendedprice), 0) AS variance, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25,
       round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(quantile_cont(l_extendedprice, 0.75), 4) AS q75
       FROM lineitem GROUP BY 1""",
)
def value_profile(spark, sf):
    """Exact quartiles and moments of groups of any size."""
    out = quantiles.profile(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice")
    return out.select(
        "l_returnflag", "n", "min", F.round("mean", 2).alias("mean"), "max", F.round("variance", 0).alias("variance"),
        *[F.round(c, 4).alias(c) for c in ("q25", "median", "q75")],
    )


@query(
    "ratio_profile",
    """SELECT r AS l_linestatus, count(*) AS n, round(min(v), 4) AS min, round(quantile_cont(v, 0.5), 4) AS median, round(max(v), 4) AS max
       FROM (SELECT l_linestatus AS r, l_quantity / nullif(l_tax, 0) AS v FROM lineitem) GROUP BY 1""",
)
def ratio_profile(spark, sf):
    """Profile of a ratio."""
    out = rollup.ratio_profile(table(spark, sf, "lineitem"), ["l_linestatus"], "l_quantity", "l_tax")
    return out.select("l_linestatus", "n", *[F.round(c, 4).alias(c) for c in ("min", "median", "max")])


_Z = "1.959963984540054e0"
_EV = f"""{ctes('cv')}, c3 AS (SELECT *, {q.cell_items('x', 'y', 3, 'cell')} FROM cv),
    l AS (SELECT seq, cell, date, pm25, 'oob' AS oob, pred_oob AS pred, se_oob AS se FROM c3
      UNION ALL SELECT seq, cell, date, pm25, 'inbag', pred_inbag, se_inbag FROM c3),
    ev AS (SELECT *, pred - {_Z} * se AS lci, pred + {_Z} * se AS uci FROM l)"""


def off_tie(name, out=None):
    """Four decimals, after a tiny shift: means of five-decimal prices often end in an exact half,
    where the last bit of a sum (its order differs between engines) would decide the digit."""
    return F.round(F.col(name) + 3.1416e-6, 4).alias(out or name)


def evaluation(spark, sf):
    cv = grid.add_cell(bind(spark, sf, "cv"), "x", "y", 3)
    return metrics.add_interval(metrics.stack_predictions(cv, ["seq", "cell", "date", "pm25"]))


@query(
    "prediction_intervals",
    f"""WITH {_EV} SELECT seq, oob, round(lci, 4) AS lci, round(uci, 4) AS uci, round(uci - lci, 4) AS ci_length,
        pm25 < uci AND pm25 > lci AS ci_covered FROM ev""",
)
def prediction_intervals(spark, sf):
    """Interval, length and coverage."""
    ev = evaluation(spark, sf)
    return ev.select("seq", "oob", *[F.round(c, 4).alias(c) for c in ("lci", "uci", "ci_length")], "ci_covered")


def _acc(by: str, source: str, slope: str) -> str:
    return f"""SELECT {by}, count(*) AS n, round(median(abs(pm25 - pred)), 4) AS median_ae,
        round(sqrt(avg((pm25 - pred) * (pm25 - pred))), 4) AS rmse,
        round(pow(covar_pop(pm25, pred) / nullif(stddev_pop(pm25) * stddev_pop(pred), 0), 2), 6) AS rsq,
        round({slope}, 6) AS slope, round(100 * avg(CASE WHEN pm25 < uci AND pm25 > lci THEN 1e0 ELSE 0e0 END), 4) AS ci_coverage
        FROM {source} GROUP BY {by}"""


def _acc_cols(df, *keys):
    return df.select(
        *keys, "n", F.round("median_ae", 4).alias("median_ae"), F.round("rmse", 4).alias("rmse"),
        F.round("rsq", 6).alias("rsq"), F.round("slope", 6).alias("slope"), F.round("ci_coverage", 4).alias("ci_coverage"),
    )


@query("accuracy_overall", f"WITH {_EV} {_acc('oob', 'ev', 'sum(pm25 * pred) / sum(pm25 * pm25)')}")
def accuracy_overall(spark, sf):
    """Accuracy per prediction kind."""
    return _acc_cols(metrics.accuracy_metrics(evaluation(spark, sf), ["oob"]), "oob")


@query(
    "accuracy_one_slope",
    f"WITH {_EV}, g AS (SELECT sum(pm25 * pred) / sum(pm25 * pm25) AS s FROM ev) {_acc('oob', 'ev, g', 'min(s)')}",
)
def accuracy_one_slope(spark, sf):
    """D9 with the slope of the whole table in every group."""
    return _acc_cols(metrics.accuracy_metrics(evaluation(spark, sf), ["oob"], slope_scope="global"), "oob")


@query(
    "accuracy_by_year",
    f"""WITH {_EV}, y AS (SELECT *, CAST(year(date) AS INT) AS year FROM ev WHERE oob = 'oob'),
        g AS (SELECT year, round(avg(pm25) + 3.1416e-6, 4) AS mean_measured_pm FROM y GROUP BY 1),
        a AS ({_acc('year', 'y', 'sum(pm25 * pred) / sum(pm25 * pm25)')}) SELECT * FROM a JOIN g USING (year)""",
)
def accuracy_by_year(spark, sf):
    """Out-of-bag accuracy and mean measured value per year."""
    rows = evaluation(spark, sf).withColumn("year", F.year("date"))
    out = reports.yearly_accuracy(rows)
    return _acc_cols(out, "year").join(out.select("year", off_tie("mean_measured_pm")), "year")


_LEVELS = (
    ("all", "NULL", "NULL", "NULL"),
    ("annual", "year(date)", "NULL", "NULL"),
    ("monthly", "year(date)", "month(date)", "NULL"),
    ("weekly", "year(date)", "(dayofyear(date) - 1) // 7 + 1", "NULL"),
    ("daily", "year(date)", "NULL", "date"),
)
_ROLL = " UNION ALL ".join(
    f"""SELECT cell, oob, '{name}' AS time, CAST({i} AS INT) AS time_rank, CAST({a} AS INT) AS year, CAST({b} AS INT) AS unit, CAST({c} AS DATE) AS day,
        count(*) AS n, avg(pm25) AS mean_pm25, avg(pred) AS mean_pred, sqrt(sum(se * se)) AS mean_se FROM ev GROUP BY ALL"""
    for i, (name, a, b, c) in enumerate(_LEVELS)
)


@query(
    "time_levels",
    f"""WITH {_EV}, r AS ({_ROLL}) SELECT cell, oob, time, time_rank, year, unit, day, n, round(mean_pm25 + 3.1416e-6, 4) AS mean_pm25,
        round(mean_pred + 3.1416e-6, 4) AS mean_pred, round(mean_se + 3.1416e-6, 4) AS mean_se FROM r""",
)
def time_levels(spark, sf):
    """Five time levels."""
    out = metrics.temporal_rollup(evaluation(spark, sf))
    return out.select(
        "cell", "oob", "time", "time_rank", "year", "unit", "day", "n",
        *[off_tie(c) for c in ("mean_pm25", "mean_pred", "mean_se")],
    )


def _cell_sql(se: str) -> str:
    return f"""{_EV}, r AS ({_ROLL}), ce AS (SELECT time, time_rank, cell, oob, count(*) AS n_time_units, CAST(sum(n) AS BIGINT) AS n_observations,
    median(abs(mean_pm25 - mean_pred)) AS median_ae, sqrt(avg((mean_pm25 - mean_pred) * (mean_pm25 - mean_pred))) AS rmse,
    pow(covar_pop(mean_pm25, mean_pred) / nullif(stddev_pop(mean_pm25) * stddev_pop(mean_pred), 0), 2) AS rsq,
    sum(mean_pm25 * mean_pred) / sum(mean_pm25 * mean_pm25) AS slope,
    100 * avg(CASE WHEN mean_pm25 <= mean_pred + {_Z} * ({se}) AND mean_pm25 >= mean_pred - {_Z} * ({se}) THEN 1e0 ELSE 0e0 END) AS ci_coverage
    FROM r GROUP BY ALL)"""


_MEASURES = ("median_ae", "rmse", "slope", "ci_coverage")

for _name, _se, _flag in (("cell_errors", "mean_se", False), ("cell_errors_se_of_mean", "mean_se / n", True)):

    @query(
        _name,
        f"""WITH {_cell_sql(_se)} SELECT time, time_rank, cell, oob, n_time_units, n_observations,
            {', '.join(f'round({m} + 3.1416e-6, 4) AS {m}' for m in _MEASURES)} FROM ce""",
    )
    def _cells(spark, sf, flag=_flag):
        """Accuracy per cell and time level."""
        out = metrics.cell_errors(metrics.temporal_rollup(evaluation(spark, sf)), se_of_mean=flag)
        return out.select(
            "time", "time_rank", "cell", "oob", "n_time_units", "n_observations",
            *[off_tie(m) for m in _MEASURES],
        )


_MEDIANS = ("n_time_units", "n_observations", "median_ae", "rmse", "slope", "ci_coverage")


@query(
    "errors_across_cells",
    f"""WITH {_cell_sql('mean_se')} SELECT time, time_rank, oob, {', '.join(f'round(median({m}) + 3.1416e-6, 4) AS {m}' for m in _MEDIANS)}
        FROM ce GROUP BY ALL""",
)
def errors_across_cells(spark, sf):
    """Median over cells."""
    out = metrics.across_cells(metrics.cell_errors(metrics.temporal_rollup(evaluation(spark, sf))))
    return out.select("time", "time_rank", "oob", *[off_tie(f"median_{m}", m) for m in _MEDIANS])


@query(
    "errors_by_coarse_cell",
    f"""WITH {_cell_sql('mean_se')}, cc AS (SELECT time, time_rank, oob, {', '.join(_MEDIANS)}, coarse FROM (SELECT *, {q.parent_items('cell', 3, 2, 'coarse')} FROM ce))
        SELECT time, time_rank, coarse, oob, {', '.join(f'round(median({m}) + 3.1416e-6, 4) AS {m}' for m in _MEDIANS)} FROM cc GROUP BY ALL""",
)
def errors_by_coarse_cell(spark, sf):
    """Median per coarse cell."""
    errors = metrics.cell_errors(metrics.temporal_rollup(evaluation(spark, sf)))
    out = metrics.coarse_cell_errors(errors, "cell", 3, 2)
    return out.select("time", "time_rank", "coarse", "oob", *[off_tie(m) for m in _MEDIANS])


@query(
    "report_table",
    f"""WITH {_EV} SELECT oob, count(*) AS n, round(avg(pm25), 2) AS mean, round(max(ci), 2) AS longest
        FROM (SELECT *, uci - lci AS ci FROM ev) GROUP BY 1""",
)
def report_table(spark, sf):
    """Report rounding."""
    from airgrid.plans.reports import rounded

    out = evaluation(spark, sf).groupBy("oob").agg(
        F.count(F.lit(1)).alias("n"), F.avg("pm25").alias("mean"), F.max("ci_length").alias("longest")
    )
    return rounded(out)


@query(
    "error_boxes",
    f"""WITH {_cell_sql('mean_se')}, qs AS (SELECT time, oob, count(*) AS n, quantile_cont(median_ae, 0.25) AS a, quantile_cont(median_ae, 0.5) AS b,
        quantile_cont(median_ae, 0.75) AS c FROM ce GROUP BY ALL)
        SELECT time, oob, n, round(a, 4) AS q25, round(b, 4) AS median, round(c, 4) AS q75,
        (SELECT round(min(median_ae), 4) FROM ce WHERE ce.time = qs.time AND ce.oob = qs.oob AND median_ae BETWEEN a - 1.5e0 * (c - a) AND c + 1.5e0 * (c - a)) AS low_whisker,
        (SELECT round(max(median_ae), 4) FROM ce WHERE ce.time = qs.time AND ce.oob = qs.oob AND median_ae BETWEEN a - 1.5e0 * (c - a) AND c + 1.5e0 * (c - a)) AS high_whisker,
        (SELECT count(*) FROM ce WHERE ce.time = qs.time AND ce.oob = qs.oob AND median_ae NOT BETWEEN a - 1.5e0 * (c - a) AND c + 1.5e0 * (c - a)) AS outliers
        FROM qs""",
)
def error_boxes(spark, sf):
    """Box-plot numbers per time level."""
    errors = metrics.cell_errors(metrics.temporal_rollup(evaluation(spark, sf)))
    out = quantiles.box_stats(errors, ["time", "oob"], "median_ae")
    cols = ("q25", "median", "q75", "low_whisker", "high_whisker")
    return out.select("time", "oob", "n", *[F.round(c, 4).alias(c) for c in cols], "outliers")


_hb = 4.0 / q.ROOT3


@query(
    "hexagon_bins",
    f"""WITH {_EV}, h AS (SELECT *, (pm25 * {q.num(q.ROOT3 / 3)} - pred / 3) / {q.num(_hb)} AS qf, pred * {q.num(2 / 3)} / {q.num(_hb)} AS rf,
        floor(qf + 0.5) AS q0, floor(rf + 0.5) AS r0, floor(0.5 - qf - rf) AS s0, abs(q0 - qf) AS dq, abs(r0 - rf) AS dr, abs(s0 + qf + rf) AS ds,
        CAST(CASE WHEN dq > dr AND dq > ds THEN -r0 - s0 ELSE q0 END AS BIGINT) AS bin_q,
        CAST(CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -q0 - s0 ELSE r0 END AS BIGINT) AS bin_r
        FROM ev WHERE pm25 BETWEEN 0 AND 400 AND pred BETWEEN 0 AND 400)
        SELECT oob, CAST(year(date) AS INT) AS year, bin_q, bin_r, count(*) AS n FROM h GROUP BY ALL""",
)
def hexagon_bins(spark, sf):
    """Two-variable hexagonal counts per facet."""
    rows = evaluation(spark, sf).withColumn("year", F.year("date"))
    out = metrics.hexbin(rows, "pm25", "pred", 4.0, (0.0, 400.0), ["oob", "year"])
    return out.select("oob", "year", "bin_q", "bin_r", "n")


@query("sampled_rows")
def sampled_rows(spark, sf):
    """A repeatable sample of 1000 rows (the limit is the operator)."""
    return metrics.sample_rows(evaluation(spark, sf).where("oob = 'oob'"), ["seq"], 1000).select("seq", "pm25", "pred")


for _order, _shift in (("documented", (0, 5)), ("as_written", (13, 8))):

    @query(
        f"layer_composite_{_order}",
        f"""WITH {ctes('pix')} SELECT date, tile_rank, row, col, round(avg(CASE WHEN ((qa >> {_shift[0]}) & 7) IN (1, 2)
            AND ((qa >> {_shift[1]}) & 7) IN (0, 3) THEN value END), 6) AS value FROM pix GROUP BY 1, 2, 3, 4""",
    )
    def _composite(spark, sf, order=_order):
        """Mean of allowed layers."""
        out = raster.composite(bind(spark, sf, "pix"), order, ("date", "tile_rank", "row", "col"))
        return out.select("date", "tile_rank", "row", "col", F.round("value", 6).alias("value"))


@query(
    "tile_mosaic",
    f"""WITH {ctes('pix')}, t AS (SELECT date, tile_rank, row, col, avg(CASE WHEN (qa & 7) IN (1, 2) AND ((qa >> 5) & 7) IN (0, 3) THEN value END) AS v
        FROM pix GROUP BY 1, 2, 3, 4)
        SELECT date, row, col, round(arg_min(v, tile_rank) FILTER (WHERE v IS NOT NULL), 6) AS value FROM t GROUP BY 1, 2, 3""",
)
def tile_mosaic(spark, sf):
    """First tile with a value wins."""
    tiles = raster.composite(bind(spark, sf, "pix"), "documented", ("date", "tile_rank", "row", "col"))
    out = raster.mosaic(tiles, "tile_rank")
    return out.select("date", "row", "col", F.round("value", 6).alias("value"))


@query(
    "zonal_summary",
    f"""WITH {ctes('site')}, p AS (SELECT {q.cell_items('x', 'y', 4, 'cell')}, nei_year AS year, total_emissions AS impervious, site_id % 3 AS class FROM site)
        SELECT cell, year, round(avg(impervious), 4) AS impervious, round(count(*) FILTER (WHERE class = 0) * 100.0e0 / count(*), 4) AS green,
        round(count(*) FILTER (WHERE class = 1) * 100.0e0 / count(*), 4) AS primary_urban FROM p GROUP BY 1, 2""",
)
def zonal_summary(spark, sf):
    """Mean and class shares per cell and year."""
    site = bind(spark, sf, "site").selectExpr("x", "y", "nei_year AS year", "total_emissions AS impervious", "site_id % 3 AS class")
    pixels = grid.add_cell(site, "x", "y", 4)
    out = raster.zonal_summary(pixels, ["cell", "year"], ["impervious"], "class", {"green": 0, "primary_urban": 1})
    return out.select("cell", "year", *[F.round(c, 4).alias(c) for c in ("impervious", "green", "primary_urban")])


@query(
    "lowest_rows",
    "SELECT c_nationkey, c_custkey, c_acctbal FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) = 1",
)
def lowest_rows(spark, sf):
    """The row with the lowest value per group."""
    rows = table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return rollup.lowest_row(rows, "c_acctbal", "c_custkey", ["c_nationkey"])


@query(
    "distinct_cells",
    f"""WITH {_OBS3}, p AS (SELECT DISTINCT cell, year(date) AS y FROM o3)
        SELECT count(DISTINCT cell) AS n_cells, count(*) AS n_cell_years FROM p""",
)
def distinct_cells(spark, sf):
    """Distinct cells and cell-years."""
    rows = _obs3(spark, sf).withColumn("year", F.year("date"))
    return rollup.distinct_counts(rows, "cell", "year")


@query(
    "rows_per_day",
    """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS date FROM orders), e AS (SELECT CAST(min(date) AS TIMESTAMP) a, CAST(max(date) AS TIMESTAMP) + INTERVAL 9 DAY b FROM o),
       d AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM e)
       SELECT d.date, count(o.date) AS n FROM d LEFT JOIN o USING (date) GROUP BY 1""",
)
def rows_per_day(spark, sf):
    """Rows per calendar day, zero included."""
    obs = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"))
    days = obs.agg(F.min("date").alias("a"), F.date_add(F.max("date"), 9).alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("date")
    )
    return rollup.rows_per_day(obs, days)


@query("rows_per_cell", f"WITH {_OBS3} SELECT cell, count(*) AS n FROM o3 GROUP BY 1")
def rows_per_cell(spark, sf):
    """Rows per cell."""
    return rollup.rows_per_cell(_obs3(spark, sf))


@query(
    "value_classes",
    """SELECT CAST(CASE WHEN v = 200000 THEN 2 WHEN v >= 0 AND v < 20000 THEN 0 WHEN v >= 20000 AND v < 100000 THEN 1
       WHEN v >= 100000 AND v < 200000 THEN 2 END AS INT) AS class, count(*) AS n
       FROM (SELECT round(o_totalprice) AS v FROM orders) GROUP BY 1""",
)
def value_classes(spark, sf):
    """Counts per fixed class."""
    return rollup.class_counts(table(spark, sf, "orders"), "o_totalprice", [0, 20000, 100000, 200000])


@query(
    "ranked_by_value",
    "SELECT p_type AS variable, round(avg(p_retailprice), 4) AS var_imp FROM part GROUP BY 1 ORDER BY 2 DESC",
)
def ranked_by_value(spark, sf):
    """T5: a small report table in descending order."""
    out = table(spark, sf, "part").groupBy(F.col("p_type").alias("variable")).agg(F.avg("p_retailprice").alias("v"))
    return rollup.ranked(out.select("variable", F.round("v", 4).alias("var_imp")), "var_imp")

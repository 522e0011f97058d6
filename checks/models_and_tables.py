"""Inventories, surfaces, assembled tables, forests, scoring and regions (sections K, L, O)."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from airgrid.operators import forest, grid, quantiles, regions
from airgrid.operators.nearest import split_segments
from airgrid.plans import inventories, modelling, observations, reports, surfaces, tables
from airgrid.session import cut_lineage, use_checkpoints
from airgrid.sources import files

from . import sqltext as q
from .bindings import bind, ctes, rectangle, table
from .grid_and_rollups import _EXPOSURE, neighbor_exposure_rows
from .registry import query

# The given tables cover 1995-2001, so the vintages stand for these years here.
VINTAGES = {2008: (1995, 1996), 2011: (1997, 1998), 2014: (1999, 1999), 2017: (2000, 2001)}
_VINTAGE_SQL = """CAST(CASE WHEN year(date) IN (1995, 1996) THEN 2008 WHEN year(date) IN (1997, 1998) THEN 2011
    WHEN year(date) = 1999 THEN 2014 WHEN year(date) IN (2000, 2001) THEN 2017 END AS INT)"""


def _inventory_sql(complete: bool) -> str:
    wide = f"""{ctes('emis', 'county')}, g AS (SELECT fips, nei_year, eis, sum(total) AS t FROM emis GROUP BY ALL),
        wd AS (SELECT fips, nei_year, sum(CASE WHEN eis = 'nonroad' THEN t END) AS a, sum(CASE WHEN eis = 'onroad' THEN t END) AS b,
        sum(CASE WHEN eis = 'nonpoint' THEN t END) AS c, sum(CASE WHEN eis = 'event' THEN t END) AS d FROM g GROUP BY ALL)"""
    base = (
        ", k AS (SELECT poly_id AS fips, nei_year FROM county, (SELECT DISTINCT nei_year FROM wd)), j AS (SELECT * FROM k LEFT JOIN wd USING (fips, nei_year))"
        if complete
        else ", k AS (SELECT poly_id AS fips FROM county), j AS (SELECT * FROM k LEFT JOIN wd USING (fips))"
    )
    return f"""{wide}{base}, inv AS (SELECT fips, nei_year, coalesce(a, 0) AS nonroad,
        CASE WHEN nei_year = 2017 THEN NULL ELSE coalesce(b, 0) END AS onroad,
        CASE WHEN nei_year = 2017 THEN NULL ELSE coalesce(c, 0) END AS nonpoint,
        CASE WHEN nei_year = 2008 THEN NULL ELSE coalesce(d, 0) END AS event FROM j)"""


def _inventory(spark, sf, complete=False):
    counties = bind(spark, sf, "county").select(F.col("poly_id").alias("fips"))
    return inventories.county_inventory(bind(spark, sf, "emis"), counties, complete)


for _name, _complete in (("county_inventory", False), ("county_inventory_complete", True)):

    @query(
        _name,
        f"""WITH {_inventory_sql(_complete)} SELECT fips, nei_year, round(nonroad, 2) AS nonroad, round(onroad, 2) AS onroad,
            round(nonpoint, 2) AS nonpoint, round(event, 2) AS event FROM inv""",
    )
    def _county(spark, sf, complete=_complete):
        """Sectors wide, zero-filled, never-published sectors missing."""
        out = _inventory(spark, sf, complete)
        return out.select("fips", "nei_year", *[F.round(s, 2).alias(s) for s in inventories.SECTORS])


@query(
    "facility_inventory",
    f"""WITH {ctes('site')} SELECT site_id, eis, cell FROM (SELECT site_id, 'point' AS eis, {q.cell_items('x', 'y', 8, 'cell')}
        FROM site WHERE total_emissions > 0)""",
)
def facility_inventory(spark, sf):
    """Complete facility records with their cell."""
    site = bind(spark, sf, "site").withColumn(
        "total_emissions", F.expr("if(total_emissions > 0, total_emissions, null)")
    )
    return inventories.facility_inventory(site).select("site_id", "eis", "cell")


@query(
    "fire_inventory",
    f"""WITH {ctes('fire')} SELECT seq, date, area, fire_pm25, cell FROM (SELECT seq, date, area, fire_pm25, {q.cell_items('x', 'y', 8, 'cell')}
        FROM fire WHERE x BETWEEN -1800000 AND 1800000 AND y BETWEEN 400000 AND 3000000)""",
)
def fire_inventory(spark, sf):
    """Dated, cropped fires with their cell."""
    fires = bind(spark, sf, "fire").drop("date")
    out = inventories.fire_inventory(fires, (-1.8e6, 1.8e6, 4e5, 3e6))
    return out.select("seq", "date", "area", "fire_pm25", "cell")


# Places in degrees for the plans that start from them; the duration and missing readings vary.
_DEGREES = "-125 + ({k} * 3319 % 4600) / 80.0e0 AS lon, 25 + ({k} * 329 % 2900) / 120.0e0 AS lat"


def _degrees(key):
    return _DEGREES.format(k=key).replace("e0", "D")


@query(
    "station_observations",
    f"""WITH {ctes('county')}, r AS (SELECT s_suppkey, CAST(l_shipdate AS DATE) AS date, {_DEGREES.format(k='s_suppkey')},
        CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS pm25 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_linenumber <> 3),
        d AS (SELECT s_suppkey, lon, lat, date, CASE WHEN count(pm25) = count(*) THEN avg(pm25) END AS pm25 FROM r GROUP BY ALL),
        p AS (SELECT * FROM {q.with_albers('d')} WHERE EXISTS (SELECT 1 FROM county WHERE x >= xmin AND x < xmax AND y >= ymin AND y < ymax))
        SELECT cell, date, round(pm25, 6) AS pm25 FROM (SELECT date, pm25, {q.cell_items('x', 'y', 8, 'cell')} FROM p)""",
)
def station_observations(spark, sf):
    """Readings in degrees to station days on the grid: duration, id, strict mean, projection, boundary, cell."""
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.expr("l_suppkey = s_suppkey"))
    readings = rows.selectExpr(
        "if(l_linenumber = 3, '1 HOUR', '24 HOUR') AS duration", "s_nationkey AS state", "1 AS county",
        "s_suppkey AS site", _degrees("s_suppkey").split(" AS lon, ")[0] + " AS lon",
        _degrees("s_suppkey").split(" AS lon, ")[1], "if(l_linenumber = 7, null, l_quantity) AS pm25",
        "cast(l_shipdate AS date) AS date",
    )
    out = observations.observations(readings, rectangle(bind(spark, sf, "county")))
    return out.select("cell", "date", F.round("pm25", 6).alias("pm25"))


@query(
    "inventories_from_degrees",
    f"""WITH s AS (SELECT c_custkey, c_acctbal, {_DEGREES.format(k='c_custkey')} FROM customer WHERE c_acctbal > 0),
        f AS (SELECT event_id, CAST(ts AS DATE) AS date, {_DEGREES.format(k='user_id')} FROM events)
        SELECT 'point' AS kind, c_custkey AS id, NULL::DATE AS date, cell FROM (SELECT c_custkey, {q.cell_items('x', 'y', 8, 'cell')} FROM {q.with_albers('s')})
        UNION ALL SELECT 'fire', event_id, date, cell FROM (SELECT event_id, date, {q.cell_items('x', 'y', 8, 'cell')}
        FROM {q.with_albers('f')} WHERE x BETWEEN -1800000 AND 1800000 AND y BETWEEN 400000 AND 3000000)""",
)
def inventories_from_degrees(spark, sf):
    """Facilities and fires given in degrees, with their cells."""
    lon, lat = _degrees("c_custkey").split(" AS lon, ")
    site = table(spark, sf, "customer").selectExpr(
        "c_custkey AS id", "if(c_acctbal > 0, c_acctbal, null) AS total_emissions", lon + " AS lon", lat
    )
    lon, lat = _degrees("user_id").split(" AS lon, ")
    fires = table(spark, sf, "events").selectExpr(
        "event_id AS id", "year(ts) AS yr", "dayofyear(ts) AS doy", lon + " AS lon", lat
    )
    points = inventories.facility_inventory(site).select(
        F.lit("point").alias("kind"), "id", F.lit(None).cast("date").alias("date"), "cell"
    )
    burnt = inventories.fire_inventory(fires, (-1.8e6, 1.8e6, 4e5, 3e6))
    return points.union(burnt.select(F.lit("fire"), "id", "date", "cell"))


@query(
    "clean_aerosol",
    f"""WITH {ctes('pix')}, t AS (SELECT date, tile_rank, row, col, avg(CASE WHEN (qa & 7) IN (1, 2) AND ((qa >> 5) & 7) IN (0, 3) THEN value END) AS v
        FROM pix GROUP BY 1, 2, 3, 4), m AS (SELECT date, row, col, arg_min(v, tile_rank) FILTER (WHERE v IS NOT NULL) AS v FROM t GROUP BY 1, 2, 3),
        p AS (SELECT date, v, (col + 0.5e0) * 926 - 100000 AS x, 900000 - (row + 0.5e0) * 926 AS y FROM m WHERE v IS NOT NULL)
        SELECT date, cell, round(v, 6) AS aod FROM (SELECT date, v, {q.cell_items('x', 'y', 8, 'cell')} FROM p)""",
)
def clean_aerosol(spark, sf):
    """P5: mask, average, mosaic, points, cells."""
    out = surfaces.clean_aerosol(
        bind(spark, sf, "pix"), (-100000.0, 900000.0, 926.0, 926.0), sinusoidal=False
    )
    return out.select("date", "cell", F.round("aod", 6).alias("aod"))


_LC = f"""lc AS (SELECT cell, nei_year AS nlcd_year, avg(total_emissions) AS impervious FROM
    (SELECT nei_year, total_emissions, {q.cell_items('x', 'y', 3, 'cell')} FROM site) GROUP BY ALL)"""


@query(
    "land_cover_years",
    f"""WITH {ctes('cv', 'site')}, {_LC}, k AS (SELECT DISTINCT cell, CAST(year(date) AS INT) AS year FROM (SELECT date, {q.cell_items('x', 'y', 3, 'cell')} FROM cv))
        SELECT k.cell, year, round(impervious, 4) AS impervious FROM k LEFT JOIN lc ON k.cell = lc.cell
        AND nlcd_year = CASE WHEN year * 2 <= 2008 + 2011 THEN 2008 ELSE 2011 END""",
)
def land_cover_years(spark, sf):
    """Closest vintage per cell and year, distinct pairs only."""
    obs = grid.add_cell(bind(spark, sf, "cv"), "x", "y", 3)
    cover = (
        grid.add_cell(bind(spark, sf, "site"), "x", "y", 3)
        .groupBy("cell", F.col("nei_year").alias("nlcd_year"))
        .agg(F.avg("total_emissions").alias("impervious"))
    )
    out = surfaces.land_cover_years(obs, cover, [2008, 2011, 2014, 2017], ["impervious"])
    return out.select("cell", "year", F.round("impervious", 4).alias("impervious"))


def _weather_rows(spark, sf):
    """Daily weather per weather cell, several rows per key; the last order wins."""
    cv = surfaces.add_weather_cell(bind(spark, sf, "cv"))
    return cv.select(
        "date", "seq", "weather_cell", F.col("pm25").alias("hpbl"),
        F.expr("if(seq % 5 = 0, null, se_oob)").alias("air_2m"),
    )


_WEATHER = f"""wx AS (SELECT weather_cell, date, arg_max_null(pm25, seq) AS hpbl, arg_max_null(CASE WHEN seq % 5 = 0 THEN NULL ELSE se_oob END, seq) AS air_2m
    FROM {q.with_weather_cell('cv', 'x', 'y')} GROUP BY ALL)"""
_XC, _YC = q.center_exprs("cell", 8)


@query(
    "weather_cells",
    f"""WITH {ctes('site', 'cv')} SELECT site_id, weather_cell FROM {q.with_weather_cell('site', 'x', 'y')}""",
)
def weather_cells(spark, sf):
    """The weather raster's cell under points of the equal-area plane."""
    return surfaces.add_weather_cell(bind(spark, sf, "site")).select("site_id", "weather_cell")


@query(
    "weather_days",
    f"""WITH {ctes('cv')}, {_WEATHER}, c8 AS (SELECT seq, date, {q.cell_items('x', 'y', 8, 'cell')} FROM cv),
        p8 AS (SELECT seq, date, {_XC} AS cx, {_YC} AS cy FROM c8),
        o AS (SELECT seq, weather_cell, CAST(unnest(generate_series(CAST(date AS TIMESTAMP), CAST(date AS TIMESTAMP) + to_days(CAST(seq % 3 AS INT)), INTERVAL 1 DAY)) AS DATE) AS date FROM {q.with_weather_cell('p8', 'cx', 'cy')})
        SELECT seq, weather_cell, o.date, hpbl, air_2m FROM o LEFT JOIN wx USING (weather_cell, date)""",
)
def weather_days(spark, sf):
    """Raster cell under each cell's centre, one look-up per cell and day."""
    obs = grid.add_cell(bind(spark, sf, "cv"), "x", "y", 8).select(
        "seq", "cell", F.col("date").alias("start_date"),
        F.date_add("date", (F.col("seq") % 3).cast("int")).alias("end_date"),
    )
    out = surfaces.weather_days(obs, _weather_rows(spark, sf), ["hpbl", "air_2m"])
    return out.select("seq", "weather_cell", "date", "hpbl", "air_2m")


@query("population_density")
def population_density(spark, sf):
    """Population of hexagons from polygons (checked by a property test)."""
    cells = grid.add_cell(bind(spark, sf, "site"), "x", "y", 3).select("cell").distinct()
    tracts = rectangle(bind(spark, sf, "county")).withColumn("population", F.lit(1e6))
    return surfaces.population_density(cells, tracts, 3)


_X2, _Y2 = q.center_exprs("cell", 2)


@query(
    "grid_cover",
    f"""WITH {ctes('county')}, c AS (SELECT {q.pack('a', 'b', 2)} AS cell FROM range(-40, 41) s(a), range(-40, 41) t(b)),
        p AS (SELECT cell, {_X2} AS hx, {_Y2} AS hy FROM c),
        s2 AS (SELECT DISTINCT cell FROM p, county WHERE {q.hexagon_meets_rectangle('hx', 'hy', 2)}),
        u2 AS (SELECT cell, {q.parent_items('cell', 2, 1, 'up')} FROM s2),
        s1 AS (SELECT up AS cell FROM u2 GROUP BY 1 HAVING count(*) = 7),
        u1 AS (SELECT cell, {q.parent_items('cell', 1, 0, 'up')} FROM s1),
        s0 AS (SELECT up AS cell FROM u1 GROUP BY 1 HAVING count(*) = 7)
        SELECT cell AS fine FROM u2 WHERE up NOT IN (SELECT cell FROM s1)
        UNION ALL SELECT cell FROM u1 WHERE up NOT IN (SELECT cell FROM s0) UNION ALL SELECT cell FROM s0""",
)
def grid_cover(spark, sf):
    """Compact cover of a boundary, from coarse cells down to the finest resolution and up again."""
    return surfaces.grid_cover(rectangle(bind(spark, sf, "county")), coarse=2, fine=8)


def _train_parts(spark, sf):
    obs = grid.add_cell(bind(spark, sf, "obs"), "x", "y", 8).select("cell", "date", "pm25")
    counties = rectangle(bind(spark, sf, "county")).withColumnRenamed("poly_id", "county_fips")
    roads = split_segments(bind(spark, sf, "road"), 50_000.0)
    site = grid.add_cell(bind(spark, sf, "site"), "x", "y", 8)
    sites = site.selectExpr("site_id", "nei_year", "x AS x1", "y AS y1", "x AS x2", "y AS y2")
    # Read three times below; without the table, the geometry would be worked out each time.
    placed = cut_lineage(tables.locations(obs, counties))
    spots = tables.road_distances(placed, roads)
    distances = tables.facility_distances(placed, sites)
    by_order = grid.add_cell(bind(spark, sf, "cv"), "x", "y", 8)
    population = (
        grid.add_cell(bind(spark, sf, "site"), "x", "y", 8)
        .transform(lambda d: grid.add_parent(d, "cell", 8, 5, "cell5"))
        .groupBy(F.col("cell5").alias("cell"))
        .agg(F.sum("population").alias("population_density"))
    )
    return dict(
        obs=obs,
        spots=spots,
        distances=distances,
        nearby=neighbor_exposure_rows(spark, sf),
        population=population,
        facilities=site,
        county_emissions=_inventory(spark, sf),
        weather=by_order.selectExpr("cell", "date", "seq", "se_oob AS hpbl", "se_inbag AS air_2m"),
        land_cover=site.selectExpr("cell", "cast(1995 + site_id % 7 AS INT) AS year", "seq", "total_emissions AS impervious"),
        aerosol=by_order.selectExpr("cell", "date", "seq", "pm25 / 150 AS aod"),
        fires=by_order.selectExpr("cell", "date", "seq", "pred_oob AS fire_pm25", "se_oob AS area"),
        weather_cols=["hpbl", "air_2m"],
        land_cols=["impervious"],
        near_res=3,
        vintages=VINTAGES,
    )


def training_rows(spark, sf):
    return tables.training_table(**_train_parts(spark, sf))


_X8, _Y8 = q.center_exprs("cell", 8)
_TRAIN = f"""{_EXPOSURE}, {_inventory_sql(False)}, {ctes('site', 'road', 'cv')},
    near AS (SELECT cell AS cell3, date, nearby_pm FROM x),
    ob AS (SELECT pm25, date, cell FROM (SELECT pm25, date, {q.cell_items('x', 'y', 8, 'cell')} FROM obs)),
    sp AS (SELECT cell, {_X8} AS x, {_Y8} AS y FROM (SELECT DISTINCT cell FROM ob)),
    pl AS (SELECT sp.*, poly_id AS county_fips FROM sp JOIN county ON x >= xmin AND x < xmax AND y >= ymin AND y < ymax),
    rd AS (SELECT cell, min(abs(x - x1)) AS s1100_dist FROM pl, road GROUP BY 1),
    nd AS (SELECT cell, nei_year, min(sqrt((t.x - p.x) * (t.x - p.x) + (t.y - p.y) * (t.y - p.y))) AS nei_dist FROM pl p, site t GROUP BY 1, 2),
    st AS (SELECT * FROM (SELECT site_id, seq, nei_year, total_emissions, population, {q.cell_items('x', 'y', 8, 'cell')} FROM site)),
    pp AS (SELECT cell5, sum(population) AS population_density FROM (SELECT population, {q.parent_items('cell', 8, 5, 'cell5')} FROM st) GROUP BY 1),
    fp AS (SELECT cell, nei_year, arg_max_null(total_emissions, seq) AS nei_point FROM st GROUP BY 1, 2),
    lc AS (SELECT cell, 1995 + site_id % 7 AS year, arg_max_null(total_emissions, seq) AS impervious FROM st GROUP BY 1, 2),
    oc AS (SELECT * FROM (SELECT seq, date, pm25, pred_oob, se_oob, se_inbag, {q.cell_items('x', 'y', 8, 'cell')} FROM cv)),
    du AS (SELECT cell, date, arg_max_null(se_oob, seq) AS hpbl, arg_max_null(se_inbag, seq) AS air_2m, arg_max_null(pm25 / 150, seq) AS aod,
      arg_max_null(pred_oob, seq) AS fire_pm25, arg_max_null(se_oob, seq) AS fire_area FROM oc GROUP BY 1, 2),
    tr AS (SELECT ob.*, {_VINTAGE_SQL} AS nei_year, CAST(year(date) AS INT) AS year, CAST(dayofyear(date) AS INT) AS doy,
      {q.parent_items('cell', 8, 5, 'cell5')}, {q.parent_items('cell', 8, 3, 'cell3')} FROM ob)"""


@query(
    "training_table",
    f"""WITH {_TRAIN}
        SELECT tr.cell, tr.date, tr.pm25, tr.year, tr.doy, tr.nei_year, pl.county_fips, round(pl.x, 1) AS x, round(s1100_dist, 3) AS s1100_dist,
        round(nei_dist, 3) AS nei_dist, round(nearby_pm, 4) AS nearby_pm, population_density, coalesce(nei_point, 0) AS nei_point,
        round(nonroad, 2) AS nei_nonroad, round(event, 2) AS nei_event, hpbl, air_2m, impervious,
        round(CASE WHEN aod > 2 THEN NULL ELSE aod END, 6) AS aod, round(coalesce(fire_pm25, 0), 6) AS fire_pm25, coalesce(fire_area, 0) AS fire_area
        FROM tr JOIN pl USING (cell) LEFT JOIN rd USING (cell) LEFT JOIN nd USING (cell, nei_year) LEFT JOIN near USING (cell3, date)
        LEFT JOIN pp USING (cell5) LEFT JOIN fp USING (cell, nei_year) LEFT JOIN inv ON inv.fips = pl.county_fips AND inv.nei_year = tr.nei_year
        LEFT JOIN lc ON lc.cell = tr.cell AND lc.year = tr.year LEFT JOIN du ON du.cell = tr.cell AND du.date = tr.date""",
)
def training_table(spark, sf):
    """All predictors, one row per observation."""
    t = training_rows(spark, sf)
    digits = {"x": 1, "s1100_dist": 3, "nei_dist": 3, "nearby_pm": 4, "nei_nonroad": 2, "nei_event": 2, "aod": 6, "fire_pm25": 6}
    names = (
        "cell date pm25 year doy nei_year county_fips x s1100_dist nei_dist nearby_pm population_density nei_point "
        "nei_nonroad nei_event hpbl air_2m impervious aod fire_pm25 fire_area"
    ).split()
    return t.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in names])


def _regions(spark, sf):
    """Merged ids over the coarse cells of the stations: all cells under one ancestor together."""
    cells = grid.add_cell(bind(spark, sf, "stn"), "x", "y", 3).select("cell").distinct()
    pair = grid.add_parent(cells, "cell", 3, 1, "up")
    ids = pair.groupBy("up").agg(F.array_sort(F.collect_set("cell")).alias("m"))
    return ids.select(F.array_join(F.transform("m", lambda c: c.cast("string")), "-").alias("region"))


def _prediction_cells(spark, sf, res):
    cells = regions.region_cells(_regions(spark, sf)).withColumn("cell", F.col("cell").cast("bigint"))
    counties = rectangle(bind(spark, sf, "county")).withColumnRenamed("poly_id", "county_fips")
    return tables.prediction_cells(cells, counties, region_res=3, res=res)


def grid_rows(spark, sf, res=4):
    return tables.prediction_table(
        _prediction_cells(spark, sf, res), neighbor_exposure_rows(spark, sf), _inventory(spark, sf),
        _weather_rows(spark, sf), ["hpbl", "air_2m"], vintages=VINTAGES,
    )


def _children_sql(coarse: int, fine: int) -> str:
    """Tables ``g<level>`` of all cells under the region cells ``c3``, level by level."""
    steps = [f"g{coarse} AS (SELECT cell3, cell3 AS cell FROM c3)"]
    for level in range(coarse, fine):
        a, b = f"({q.q_of('cell')})", f"({q.r_of('cell')})"
        down = (f"2 * {a} - {b}", f"{a} + 3 * {b}") if level % 2 else (f"3 * {a} + {b}", f"2 * {b} - {a}")
        cell = q.pack(f"{down[0]} + dq", f"{down[1]} + dr", level + 1)
        steps.append(f"g{level + 1} AS (SELECT cell3, {cell} AS cell FROM g{level}, ({q.disk(1)}))")
    return ", ".join(steps)


@query(
    "prediction_cells",
    f"""WITH {ctes('stn', 'county')},
        c3 AS (SELECT DISTINCT cell3 FROM (SELECT {q.cell_items('x', 'y', 3, 'cell3')} FROM stn)), {_children_sql(3, 8)},
        p8 AS (SELECT *, {_XC} AS px, {_YC} AS py FROM g8),
        s8 AS (SELECT * FROM {q.with_weather_cell('p8', 'px', 'py')})
        SELECT cell3, weather_cell, poly_id AS county_fips, count(*) AS n, min(cell) AS first_cell, max(cell) AS last_cell
        FROM s8 LEFT JOIN county ON px >= xmin AND px < xmax AND py >= ymin AND py < ymax GROUP BY ALL""",
)
def prediction_cells(spark, sf):
    """P3, spatial part at the finest resolution: all cells of all regions, summed per place."""
    cells = _prediction_cells(spark, sf, 8)
    return cells.groupBy("cell3", "weather_cell", "county_fips").agg(
        F.count(F.lit(1)).alias("n"), F.min("cell").alias("first_cell"), F.max("cell").alias("last_cell")
    )


_X4, _Y4 = q.center_exprs("cell", 4)
_PRED = f"""{_EXPOSURE}, {_inventory_sql(False)}, {ctes('stn', 'cv')}, {_WEATHER},
    near AS (SELECT cell AS cell3, date, nearby_pm FROM x),
    c3 AS (SELECT DISTINCT cell3 FROM (SELECT {q.cell_items('x', 'y', 3, 'cell3')} FROM stn)),
    c4 AS (SELECT cell3, {q.pack(f"2 * ({q.q_of('cell3')}) - ({q.r_of('cell3')}) + dq", f"({q.q_of('cell3')}) + 3 * ({q.r_of('cell3')}) + dr", 4)} AS cell FROM c3, ({q.disk(1)})),
    x4 AS (SELECT *, {_X4} AS px, {_Y4} AS py FROM c4), s4 AS (SELECT * FROM {q.with_weather_cell('x4', 'px', 'py')}),
    p4 AS (SELECT s4.*, poly_id AS county_fips FROM s4 LEFT JOIN county ON px >= xmin AND px < xmax AND py >= ymin AND py < ymax)"""


@query(
    "prediction_table",
    f"""WITH {_PRED} SELECT p4.cell, p.date, county_fips, p4.weather_cell, round(nearby_pm, 4) AS nearby_pm, round(event, 2) AS nei_event, hpbl, air_2m
        FROM p4 JOIN near p ON p4.cell3 = p.cell3 LEFT JOIN inv ON inv.fips = county_fips AND inv.nei_year = {_VINTAGE_SQL.replace('date', 'p.date')}
        LEFT JOIN wx ON wx.weather_cell = p4.weather_cell AND wx.date = p.date""",
)
def prediction_table(spark, sf):
    """Every fine cell of every region on every day."""
    out = grid_rows(spark, sf)
    return out.select(
        "cell", "date", "county_fips", "weather_cell", F.round("nearby_pm", 4).alias("nearby_pm"),
        F.round("nei_event", 2).alias("nei_event"), "hpbl", "air_2m",
    )


for _match in ("fanout", "cell_mean"):
    _right = (
        "SELECT cell, date, pm25 FROM c3" if _match == "fanout" else "SELECT cell, date, avg(pm25) AS pm25 FROM c3 GROUP BY 1, 2"
    )

    @query(
        f"evaluation_rows_{_match}",
        f"""WITH {ctes('cv')}, c3 AS (SELECT *, {q.cell_items('x', 'y', 1, 'cell')} FROM cv), o AS ({_right}),
            l AS (SELECT seq, cell, date, 'oob' AS oob, pred_oob AS pred, se_oob AS se FROM c3 UNION ALL SELECT seq, cell, date, 'inbag', pred_inbag, se_inbag FROM c3)
            SELECT oob, CAST(year(date) AS INT) AS year, count(*) AS n, round(sum(o.pm25), 3) AS total FROM l LEFT JOIN o USING (cell, date) GROUP BY 1, 2""",
    )
    def _evaluation(spark, sf, match=_match):
        """Rows joined to observations, fanning out or averaged first."""
        cv = grid.add_cell(bind(spark, sf, "cv"), "x", "y", 1).withColumn("year", F.year("date"))
        rows = reports.evaluation_rows(cv, cv, match)
        return rows.groupBy("oob", "year").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.sum("pm25"), 3).alias("total")
        )


_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def _train(spark, sf):
    return table(spark, sf, "lineitem").select(
        *_FEATURES, "l_suppkey", F.to_date("l_shipdate").alias("date"),
        F.year("l_shipdate").alias("year"), F.col("l_extendedprice").alias("price"),
    )


_SMALL = dict(groups=4, trees=2, depth=4, bins=16, parallelism=8)


@query("forest_errors_by_year")
def forest_errors_by_year(spark, sf):
    """K1-K5, P10: median out-of-bag and in-bag error per year."""
    _, predicted = modelling.fit_and_predict(_train(spark, sf), _FEATURES, "price", "l_suppkey", **_SMALL)
    errors = predicted.select(
        "year", F.abs(F.col("price") - F.col("pred_oob")).alias("oob"), F.abs(F.col("price") - F.col("pred_inbag")).alias("inbag")
    )
    return quantiles.medians(errors, ["year"], ["oob", "inbag"], "mae_")


@query("forest_importance")
def forest_importance(spark, sf):
    """K8, T5: impurity importance, both copies of a feature together."""
    rows = _train(spark, sf).withColumn("year", F.lit(0))
    forests = forest.cluster_forest(rows, _FEATURES, "price", "l_suppkey", **{**_SMALL, "groups": 2})
    return forest.impurity_importance(forests, 0, spark)


@query("feature_elimination")
def feature_elimination(spark, sf):
    """K9: error with ever fewer features."""
    rows = _train(spark, sf).withColumn("year", F.lit(0))
    return forest.backward_elimination(
        rows, _FEATURES, "price", "l_suppkey", 0, [2], **{**_SMALL, "groups": 2}
    )


@query(
    "tree_spread",
    """WITH g AS (SELECT l_suppkey, l_linenumber, avg(l_quantity) AS m, var_pop(l_quantity) AS w, count(l_quantity) AS k
          FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY 1, 2),
        v AS (SELECT l_suppkey, avg(m) AS pred, var_pop(m) AS between, avg(w / greatest(k - 1, 1)) AS noise, count(*) AS g FROM g GROUP BY 1)
        SELECT l_suppkey, round(pred, 6) AS pred, round(between, 6) AS between, round(noise, 6) AS noise,
        CASE WHEN g >= 2 THEN round(sqrt(greatest(between - noise, 0)), 4) END AS se FROM v""",
)
def tree_spread(spark, sf):
    """K2, K3: mean and standard error of single trees' predictions, by both variance components.

    Suppliers are the rows, line numbers the groups of trees, quantities the predictions."""
    out = forest.tree_estimates(table(spark, sf, "lineitem"), ["l_suppkey"], "l_linenumber", "l_quantity")
    return out.select(
        "l_suppkey", *[F.round(c, 6).alias(c) for c in ("pred", "between", "noise")], F.round("se", 4).alias("se")
    )


@query(
    "split_importance",
    """WITH n AS (SELECT p_size % 10 AS tree, p_partkey % 6 AS f, row_number() OVER (PARTITION BY p_size % 10 ORDER BY p_partkey) AS place,
          count(*) OVER (PARTITION BY p_size % 10) AS size FROM part),
        s AS (SELECT CAST(floor(log2(place)) AS INT) + 1 AS depth, f // 2 AS i FROM n WHERE 2 * place < size),
        c AS (SELECT depth, i, count(*) AS n, sum(count(*)) OVER (PARTITION BY depth) AS total FROM s WHERE depth <= 4 GROUP BY 1, 2),
        w AS (SELECT i, sum(n / total * pow(depth, -2) / (1 + 1e0 / 4 + 1e0 / 9 + 1e0 / 16)) AS score FROM c GROUP BY 1)
        SELECT variable, round(coalesce(score, 0), 9) AS var_imp
        FROM (VALUES (0, 'a'), (1, 'b'), (2, 'c'), (3, 'd')) AS t(i, variable) LEFT JOIN w USING (i)""",
)
def split_importance(spark, sf):
    """K8: depth-weighted counts of splits. Parts of a size are the nodes of a tree, in heap order."""
    tree = Window.partitionBy("tree")
    nodes = (
        table(spark, sf, "part")
        .select((F.col("p_size") % 10).alias("tree"), "p_partkey")
        .withColumn("node", F.row_number().over(tree.orderBy("p_partkey")) - 1)
        .withColumn("size", F.count(F.lit(1)).over(tree))
    )
    nodes = nodes.withColumns({"left": F.col("node") * 2 + 1, "right": F.col("node") * 2 + 2})
    splits = F.when(F.col("right") < F.col("size"), F.col("p_partkey") % 6).otherwise(-1)
    out = forest.split_importance(nodes.withColumn("feature", splits), ["a", "b", "c", "d"])
    return out.select("variable", F.round("var_imp", 9).alias("var_imp"))


@query(
    "sorted_snapshot_range",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders
       WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-05-31'""",
)
def sorted_snapshot_range(spark, sf):
    """A snapshot sorted by date, read back by a range through its table of file zones."""
    path = f"{use_checkpoints(spark)}/orders-{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date"), "o_totalprice")
    files.write_sorted(orders, ["o_orderdate"], path, partitions=24)
    return files.read_range(spark, path, "o_orderdate", F.lit("1996-03-01").cast("date"), F.lit("1996-05-31").cast("date"))


@query("scored_regions")
def scored_regions(spark, sf):
    """Every fine cell and day scored with its year's model."""
    train = training_rows(spark, sf).where("pm25 IS NOT NULL")
    features = ["nearby_pm", "x", "doy", "air_2m", "nei_event", "hpbl", "y"]
    forests = forest.cluster_forest(train, features, "pm25", "cell", **{**_SMALL, "groups": 2})
    scored = modelling.predictions(grid_rows(spark, sf), forests)
    return scored.groupBy("region", "year").agg(
        F.count(F.lit(1)).alias("n"), F.avg("pm_pred").alias("mean_pred"), F.avg("pm_se").alias("mean_se")
    )


@query(
    "resumed_scoring",
    f"""WITH {_PRED}, up AS (SELECT cell3, {q.parent_items('cell3', 3, 1, 'up')} FROM c3),
        ids AS (SELECT up, string_agg(CAST(cell3 AS VARCHAR), '-' ORDER BY cell3) AS region FROM up GROUP BY 1),
        days AS (SELECT region, cell3, date, CAST(year(date) AS INT) AS year FROM near JOIN up USING (cell3) JOIN ids USING (up)),
        runs AS (SELECT region, year, CAST(CASE WHEN year <= 1996 THEN 1 ELSE 2 END AS INT) AS run FROM days WHERE year BETWEEN 1995 AND 1998 GROUP BY ALL)
        SELECT region, year, run, count(*) AS n, count(DISTINCT cell) AS n_cells, count(*) AS n_scored
        FROM days JOIN runs USING (region, year) JOIN p4 USING (cell3) GROUP BY ALL""",
)
def resumed_scoring(spark, sf):
    """Two runs of the scoring job over one output; the second does what the first left.

    Rows per region and year as written, with the run that wrote them. The models are small here."""
    out = f"{use_checkpoints(spark)}/scores-{uuid.uuid4().hex}"
    train = training_rows(spark, sf).where("pm25 IS NOT NULL AND year BETWEEN 1995 AND 1998")
    features = ["nearby_pm", "doy", "air_2m", "nei_event", "hpbl"]
    forests = forest.cluster_forest(train, features, "pm25", "cell", **{**_SMALL, "groups": 2})
    cells = regions.region_cells(_regions(spark, sf)).withColumn("cell", F.col("cell").cast("bigint"))
    counties = rectangle(bind(spark, sf, "county")).withColumnRenamed("poly_id", "county_fips")
    nearby = cut_lineage(neighbor_exposure_rows(spark, sf))
    inventory, weather = _inventory(spark, sf), _weather_rows(spark, sf)
    days = nearby.select("cell", F.year("date").alias("year")).distinct().where("year BETWEEN 1995 AND 1998")
    wanted = cells.join(days, "cell").select("region", "year")

    def grid_of(left):
        return tables.pending_grid(
            left, cells, counties, nearby, inventory, weather, ["hpbl", "air_2m"], res=4, vintages=VINTAGES
        )

    first = modelling.score_regions(spark, wanted.where("year <= 1996"), grid_of, forests, out)
    second = modelling.score_regions(spark, wanted, grid_of, forests, out)
    runs = first.withColumn("run", F.lit(1)).union(second.withColumn("run", F.lit(2)))
    return spark.read.parquet(out).join(runs, ["region", "year"]).groupBy("region", "year", "run").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("cell").alias("n_cells"), F.count("pm_pred").alias("n_scored")
    )


@query("merged_regions")
def merged_regions(spark, sf):
    """L1: merge to a threshold (checked against the one-at-a-time process in a test)."""
    cells = grid.add_cell(bind(spark, sf, "site"), "x", "y", 3).groupBy("cell").agg(F.sum(F.abs("total_emissions")).alias("population"))
    named = cells.withColumn("region", F.col("cell").cast("string"))
    edges = grid.region_edges(named, "cell", "region", 3)
    return regions.merge_to_threshold(named.drop("cell"), edges, threshold=8000.0)


@query("safe_regions")
def safe_regions(spark, sf):
    """Cover, population, and merging."""
    cells = grid.add_cell(bind(spark, sf, "site"), "x", "y", 2).select("cell").distinct()
    shapes = rectangle(bind(spark, sf, "county"))
    tracts = shapes.withColumn("population", (F.col("poly_id").cast("int") % 7 + 1) * 10000.0)
    return reports.safe_regions(cells, shapes, tracts, 2, 9000.0)

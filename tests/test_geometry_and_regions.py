"""Grid, polygon, nearest-feature and region properties against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from airgrid.operators import grid, nearest, neighbors, polygons, regions
from airgrid.plans import surfaces


def points_table(spark, n, seed, span=2_000_000.0):
    rnd = random.Random(seed)
    rows = [(i, rnd.uniform(-span, span), rnd.uniform(300_000, 300_000 + span)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id int, x double, y double")


@pytest.mark.parametrize("res", [8, 5, 2])
def test_cell_is_the_nearest_centre(spark, res):
    _, points = points_table(spark, 300, 1)
    cells = grid.add_cell(points, "x", "y", res)
    around = grid.explode_disk(cells, "cell", res, 1)
    x, y = grid.center(F.col("neighbor"), res)
    away = (x - F.col("x")) ** 2 + (y - F.col("y")) ** 2
    best = around.groupBy("id", "cell").agg(F.min_by("neighbor", away).alias("best"))
    assert best.where("best <> cell").count() == 0


def test_children_and_ancestors(spark):
    _, points = points_table(spark, 50, 2)
    coarse = grid.add_cell(points, "x", "y", 2).select("cell").distinct()
    fine = grid.explode_children(coarse, "cell", 2, 6, "fine")
    assert fine.select("fine").distinct().count() == coarse.count() * 7**4
    assert grid.add_parent(fine, "fine", 6, 2, "up").where("up <> cell").count() == 0
    step = grid.add_parent(grid.add_parent(fine, "fine", 6, 5, "a"), "a", 5, 2, "b")
    assert step.where("b <> cell").count() == 0
    stray = fine.where("fine % 5 <> 0").select("fine")
    small = grid.compact(stray.union(stray), "fine", 6)
    again = grid.uncompact(small, "fine", 6)
    assert again.exceptAll(stray).count() == 0 and stray.exceptAll(again).count() == 0
    assert grid.compact(fine.select("fine"), "fine", 6).exceptAll(grid.compact(coarse, "cell", 2)).count() == 0


def test_paths_number_descendants_in_one_range(spark):
    _, points = points_table(spark, 40, 2)
    for res in (0, 3, 8):
        cells = grid.add_cell(points, "x", "y", res).select("cell").distinct()
        told = grid.add_path(cells, "cell", res, "base", "path")
        assert told.where((F.col("path") < 0) | (F.col("path") >= 7**res)).count() == 0
        assert told.where(grid.cell_at(F.col("base"), F.col("path"), res) != F.col("cell")).count() == 0
        for up in range(0, res, 3):
            to = grid.add_parent(told, "cell", res, up, "above").withColumn("_p", F.floor(F.col("path") / 7 ** (res - up)))
            again = grid.add_path(to, "above", up, "b2", "p2")
            assert again.where("b2 <> base OR p2 <> _p").count() == 0


def test_compacting_over_more_levels_than_one_step(spark):
    base = spark.sql("SELECT 0 AS x, 0 AS y").select(grid.cell_of(F.col("x"), F.col("y"), 1).alias("cell"))
    fine = grid.explode_children(base, "cell", 1, 8, "fine").select("fine")
    assert [r.fine for r in grid.compact(fine, "fine", 8).collect()] == [base.head().cell]
    path = grid.add_path(fine, "fine", 8, "base", "path")
    gap = path.where("path % 823543 NOT IN (0, 5000, 700000)").select("fine")
    small = grid.compact(gap.union(gap.limit(3)), "fine", 8)
    by_level = {r.res: r["count"] for r in small.groupBy(grid.resolution(F.col("fine")).alias("res")).count().collect()}
    assert sum(n * 7 ** (8 - res) for res, n in by_level.items()) == 7**7 - 3
    assert max(by_level.values()) <= 18 and grid.uncompact(small, "fine", 8).exceptAll(gap).count() == 0
    assert grid.compact(fine.limit(0), "fine", 8).count() == 0


def test_tiles_carry_their_own_edges_only(spark):
    """Many-cornered rings with a hole, corners on tile corners and edges along tile borders."""
    rnd = random.Random(9)
    ragged = star(500.0, 500.0, 400, 1)
    shapes = [
        ("a", [(500.0 + (x - 500) / 1000, 500.0 + (y - 500) / 1000) for x, y in ragged]),
        ("b", [(1000.0, 0.0), (1600.0, 0.0), (1600.0, 600.0), (1000.0, 600.0)]),
        ("b", [(1100.0, 100.0), (1100.0, 500.0), (1500.0, 500.0), (1500.0, 100.0)]),
        ("c", [(0.0, -900.0), (900.0, 0.0), (0.0, 0.0)]),
        ("d", [(2000.0, 0.0), (2300.0, 300.0), (2600.0, 0.0), (2300.0, -300.0)]),
    ]
    table = spark.createDataFrame([(k, [{"x": x, "y": y} for x, y in r]) for k, r in shapes], "poly_id string, ring array<struct<x:double,y:double>>")
    places = [(rnd.uniform(-50, 2700), rnd.uniform(-950, 950)) for _ in range(2500)]
    places += [(100.0 * i, 100.0 * j) for i in range(28) for j in range(-9, 10)]  # tile corners
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], "id long, x double, y double")
    edges = {k: [] for k, _ in shapes}
    for k, r in shapes:
        edges[k] += list(zip(r, r[1:] + r[:1]))

    def holds(k, x, y):
        odd = False
        for (ax, ay), (bx, by) in edges[k]:
            if (ay <= y) != (by <= y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
        return odd

    want = {i: min((k for k in edges if holds(k, x, y)), default=None) for i, (x, y) in enumerate(places)}
    for tile in (100.0, 37.0, 5000.0):
        got = {r.id: r.poly_id for r in polygons.spatial_join_pip(points, table, tile=tile).collect()}
        assert got == want
    tiles = polygons.polygon_tiles(table, 100.0).where("poly_id = 'a'")
    assert tiles.agg(F.sum(F.size("edges"))).first()[0] < 3 * 400 and tiles.agg(F.max(F.size("edges"))).first()[0] < 120


def test_missing_point_has_no_cell(spark):
    row = spark.sql("SELECT CAST(NULL AS DOUBLE) AS x, 1D AS y")
    assert grid.add_cell(row, "x", "y", 8).head().cell is None


def test_public_id_bits(spark):
    ids = spark.sql("SELECT '832a93fffffffff' AS t").withColumn("h", grid.h3_from_text(F.col("t")))
    got = ids.select(grid.h3_to_text(grid.h3_parent(F.col("h"), 2)), grid.h3_base_cell(F.col("h"))).head()
    assert tuple(got) == ("822a97fffffffff", 21)
    kids = grid.h3_children(ids, "h", 3, 4, "k")
    assert kids.count() == 7 and kids.where(grid.h3_parent(F.col("k"), 3) != F.col("h")).count() == 0
    pentagon = spark.sql("SELECT 4 AS one").select(F.lit((1 << 59) | (4 << 45) | ((1 << 45) - 1)).alias("h"))
    assert grid.h3_children(pentagon, "h", 0, 1, "k").count() == 6


def test_neighbour_mean_of_a_constant_and_of_nothing(spark):
    _, points = points_table(spark, 40, 3)
    obs = grid.add_cell(points, "x", "y", 3).select("cell", F.lit("2020-01-01").cast("date").alias("date"), F.lit(5.0).alias("pm25")).distinct()
    out = neighbors.idw_neighbors(obs, 3)
    assert out.where("abs(nearby - 5) > 1e-9").count() == 0
    assert neighbors.idw_neighbors(obs.withColumn("pm25", F.lit(None).cast("double")), 3).count() == 0


def star(cx, cy, n, seed):
    rnd = random.Random(seed)
    return [
        (cx + rnd.uniform(100_000, 400_000) * math.cos(2 * math.pi * k / n), cy + rnd.uniform(100_000, 400_000) * math.sin(2 * math.pi * k / n))
        for k in range(n)
    ]


def inside(ring, x, y):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 <= y) != (y2 <= y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def test_point_in_polygon_against_brute_force(spark):
    rings = {i: star(-800_000 + 900_000 * i, 1_000_000, 30, i) for i in range(3)}
    rings[3] = [(x + 50_000, y) for x, y in rings[0]]
    shapes = spark.createDataFrame([(i, [{"x": x, "y": y} for x, y in r]) for i, r in rings.items()], "poly_id int, ring array<struct<x:double,y:double>>")
    rows, points = points_table(spark, 1500, 4)
    rows += [(9000 + i, *rings[0][i]) for i in range(5)]
    points = spark.createDataFrame(rows, "id int, x double, y double")
    for tile in (30_000.0, 500_000.0):
        got = {r.id: r.poly_id for r in polygons.spatial_join_pip(points, shapes, tile=tile).collect()}
        want = {i: min((p for p, r in rings.items() if inside(r, x, y)), default=None) for i, x, y in rows}
        assert got == want


def test_cells_touching_and_population(spark):
    ring = [(-300_000.0, 700_000.0), (500_000.0, 600_000.0), (450_000.0, 1_500_000.0), (-200_000.0, 1_400_000.0)]
    shape = spark.createDataFrame([(1, [{"x": x, "y": y} for x, y in ring], 1e6)], "poly_id int, ring array<struct<x:double,y:double>>, population double")
    box = spark.sql("SELECT -900000D AS xmin, 1100000D AS xmax, 0D AS ymin, 2100000D AS ymax")
    cells = grid.cells_over_box(box, "xmin", "xmax", "ymin", "ymax", 4).select("cell")
    hexes = cells.withColumn("ring", grid.boundary(F.col("cell"), 4))
    shared = polygons.areal_interpolate(shape, hexes, "population", "cell", tile=200_000.0).where("population > 1e-6")
    assert shared.agg(F.sum("population")).head()[0] == pytest.approx(1e6, rel=1e-9)
    touching = polygons.cells_touching(cells, shape, "cell", 4, tile=150_000.0)
    assert touching.exceptAll(shared.select("cell")).count() == 0
    assert shared.select("cell").exceptAll(touching).count() == 0
    density = surfaces.population_density(touching, shape, 4).agg(F.sum(F.col("population_density") * F.col("area"))).head()[0]
    assert density == pytest.approx(1e6, rel=1e-9)


def test_rings_cut_to_tiles_keep_their_area(spark):
    ring = "poly_id int, ring array<struct<x:double,y:double>>, value double"
    # Spikes around a centre: rings that never cross themselves.
    spiky = lambda cx, cy, n: [(cx + (150_000 + k * 7919 % 200_000) * math.cos(2 * math.pi * k / n), cy + (150_000 + k * 7919 % 200_000) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    rings = [spiky(100_000, 900_000, 1_500), spiky(-400_000, 1_200_000, 9), [(0.0, 0.0), (50_000.0, 0.0), (50_000.0, 50_000.0)]]
    rows = [(i, [{"x": x, "y": y} for x, y in r], 1e3) for i, r in enumerate(rings)]
    shapes = spark.createDataFrame(rows + [(7, None, 1.0), (8, [], 1.0)], ring)
    extent, corners = polygons._reach(shapes, "ring")
    assert corners == 1_500
    parts = polygons.cut_to_tiles(shapes, "ring", 50_000.0, extent, corners, 64)
    parts = parts.withColumn("area", polygons.ring_area(F.col("ring"))).collect()
    for i, r in enumerate(rings):
        area = sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(r, r[1:] + r[:1])) / 2
        assert sum(p.area for p in parts if p.poly_id == i) == pytest.approx(area, rel=1e-9)
    assert {p.poly_id for p in parts} == {0, 1, 2}
    for p in parts:
        assert len(p.ring) <= 64
        assert all(p.tx * 5e4 <= c.x <= (p.tx + 1) * 5e4 and p.ty * 5e4 <= c.y <= (p.ty + 1) * 5e4 for c in p.ring)
    # Shares do not depend on how the rings were cut: one tile around everything cuts none.
    box = spark.sql("SELECT -900000D AS xmin, 1100000D AS xmax, 0D AS ymin, 2100000D AS ymax")
    cells = grid.cells_over_box(box, "xmin", "xmax", "ymin", "ymax", 4).select("cell")
    hexes = cells.withColumn("ring", grid.boundary(F.col("cell"), 4))
    moved = lambda df: df.withColumn("ring", F.transform("ring", lambda p: F.struct((p["x"] + 2e6).alias("x"), (p["y"] + 1e5).alias("y"))))
    whole = polygons.areal_interpolate(moved(shapes), moved(hexes), "value", "cell", tile=1e8, max_corners=10_000)
    cut = polygons.areal_interpolate(shapes, hexes, "value", "cell", tile=50_000.0)
    want = {r.cell: r.value for r in whole.collect()}
    got = {r.cell: r.value for r in cut.collect()}
    assert set(got) == set(want) and len(got) == cells.count()
    for c in got:
        assert (got[c] or 0) == pytest.approx(want[c] or 0, abs=1e-5)
    assert sum(v or 0 for v in got.values()) == pytest.approx(3e3, rel=1e-9)


@pytest.mark.parametrize("leaf_bits", [0, 3, 6])
def test_nearest_against_brute_force(spark, leaf_bits):
    rnd = random.Random(5)
    rows, points = points_table(spark, 200, 6)
    feats = []
    for i in range(120):
        dense = i < 60
        x, y = (rnd.gauss(1e5, 500), rnd.gauss(9e5, 500)) if dense else (rnd.uniform(-2e6, 2e6), rnd.uniform(3e5, 2.3e6))
        feats.append((i, i % 2, x, y, x + rnd.choice([0, 30_000]), y))
    lost = [(500, 0, None, 1.0, 2.0, 3.0), (501, None, 1.0, 1.0, 1.0, 1.0)]
    features = spark.createDataFrame(feats + lost, "feature_id int, g int, x1 double, y1 double, x2 double, y2 double")
    asked = points.withColumn("g", F.col("id") % 3)
    got = {r.id: (r.distance, r.feature_id) for r in nearest.nearest_join(asked, features, ["g"], leaf_bits=leaf_bits).collect()}

    def dist(x, y, f):
        _, _, x1, y1, x2, y2 = f
        return math.hypot(max(x1 - x, 0, x - x2), y - y1)

    for i, x, y in rows:
        best = min(((dist(x, y, f), f[0]) for f in feats if f[1] == i % 3), default=None)
        if best is None:
            assert got[i] == (None, None)
        else:
            assert got[i][0] == pytest.approx(best[0], abs=1e-6) and got[i][1] == best[1]


def test_crowded_features_are_measured_by_leaves(spark):
    rnd = random.Random(9)
    feats = [(i, rnd.uniform(0, 500), rnd.uniform(0, 500)) for i in range(20_000)]
    feats += [(20_000 + i, rnd.uniform(-4e6, 4e6), rnd.uniform(-4e6, 4e6)) for i in range(500)]
    spots = [(i, rnd.uniform(0, 500), rnd.uniform(0, 500)) for i in range(300)] + [(300 + i, 1e9 * i, -5e6) for i in range(3)]
    features = spark.createDataFrame(feats, "feature_id int, x1 double, y1 double").selectExpr("*", "x1 AS x2", "y1 AS y2")
    points = spark.createDataFrame(spots, "id int, x double, y double")
    got = {r.id: r for r in nearest.nearest_join(points, features).collect()}
    for i, x, y in spots:
        best = min((math.hypot(x - a, y - b), f) for f, a, b in feats)
        assert (got[i].distance, got[i].feature_id) == (pytest.approx(best[0], rel=1e-12), best[1])
    # All in one place, yet a point looks into a few leaves of 64.
    shapes, bits = nearest._ordered(features.withColumnRenamed("feature_id", "_fid"), [])
    sizes = shapes.groupBy(F.shiftright("_at", 6)).count()
    assert shapes.count() == len(feats) and sizes.agg(F.max("count")).first()[0] <= 64
    visits = nearest._descend(points, shapes, [], "x", "y", bits, 6)
    assert visits.count() <= 10 * len(spots)


def test_nearest_of_nothing(spark):
    none = spark.createDataFrame([], "feature_id int, x1 double, y1 double, x2 double, y2 double")
    points = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 1.0)], "id int, x double, y double")
    assert {(r.id, r.distance, r.feature_id) for r in nearest.nearest_join(points, none).collect()} == {(1, None, None), (2, None, None)}


def one_at_a_time(sizes, edges, threshold, order):
    """The plain sequential process."""
    rows = [(k, sizes[k], {k}) for k in sorted(sizes, key=order)]
    links = {frozenset(e) for e in edges}

    def beside(a, b):
        return any(frozenset((m, n)) in links for m in a for n in b)

    while True:
        small = [i for i, r in enumerate(rows) if r[1] < threshold and any(beside(r[2], o[2]) for o in rows if o is not r)]
        if not small:
            return {(r[0], r[1]) for r in rows}
        low = rows[min(small, key=lambda i: rows[i][1])]
        rest = [r for r in rows if r is not low]
        target = min((r for r in rest if beside(low[2], r[2])), key=lambda r: r[1])
        rows = [r for r in rest if r is not target] + [(f"{low[0]}-{target[0]}", low[1] + target[1], low[2] | target[2])]


def test_merge_equals_the_one_at_a_time_process(spark):
    rnd = random.Random(11)
    names = [f"r{x}_{y}" for x in range(6) for y in range(5)] + ["alone"]
    sizes = {n: float(rnd.choice([0, 0, 1, 2, 3, 5, 8, 20])) for n in names}
    sizes["alone"] = 1.0
    edges = [(f"r{x}_{y}", f"r{x + dx}_{y + dy}") for x in range(6) for y in range(5) for dx, dy in ((1, 0), (0, 1)) if x + dx < 6 and y + dy < 5]
    both = edges + [(b, a) for a, b in edges]
    cells = spark.createDataFrame(list(sizes.items()), "region string, population double")
    rank = {r.region: r.h for r in cells.select("region", F.xxhash64("region").alias("h")).collect()}
    out = regions.merge_to_threshold(cells, spark.createDataFrame(both, "a string, b string"), threshold=10.0)
    got = {(r.region, r.population) for r in out.collect()}
    assert got == one_at_a_time(sizes, edges, 10.0, rank.get)
    assert [r.region for r in out.where("unmet").collect()] == ["alone"]
    assert regions.region_cells(out).count() == len(names)


def test_shared_areas_of_whole_tiles_holes_and_slanted_targets(spark):
    schema = "poly_id int, ring array<struct<x:double,y:double>>, value double"
    box = lambda a, b, c, d: [{"x": x, "y": y} for x, y in ((a, b), (c, b), (c, d), (a, d))]
    outer, hole = box(0.0, 0.0, 100.0, 100.0), box(40.0, 40.0, 60.0, 60.0)[::-1]
    lost = [(2, None, 5.0), (3, [], 5.0), (4, [{"x": 1.0, "y": None}, *outer[1:]], 5.0)]
    src = spark.createDataFrame([(1, outer, 960.0), (1, hole, 960.0), *lost], schema)
    slanted = [{"x": x, "y": y} for x, y in ((10.0, 10.0), (30.0, 10.0), (40.0, 30.0), (20.0, 30.0))]
    rings = {0: outer, 1: box(30.0, 30.0, 70.0, 70.0), 2: slanted, 3: box(-5.0, -5.0, 5.0, 5.0), 4: box(45.0, 45.0, 55.0, 55.0), 5: box(200.0, 0.0, 210.0, 5.0), 6: None}
    dst = spark.createDataFrame([(k, r) for k, r in rings.items()], "cell int, ring array<struct<x:double,y:double>>")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("interpolation", "")
    found = polygons.areal_interpolate(src, dst, "value", "cell", tile=10.0)
    # Nothing is measured beforehand, and rings are cut and clipped in bundles, not corner by corner.
    assert jobs.getJobIdsForGroup("interpolation") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for tile in (10.0, 7.0, 1000.0):
        got = {r.cell: r.value for r in polygons.areal_interpolate(src, dst, "value", "cell", tile=tile).collect()}
        want = {0: 960.0, 1: 120.0, 2: 40.0, 3: 2.5}
        assert {k: v for k, v in got.items() if k in want} == pytest.approx(want, rel=1e-12)
        assert (got[4] or 0) == pytest.approx(0, abs=1e-9) and got[5] is None and got[6] is None
    assert found.count() == 7


def test_rings_of_one_small_file_are_dealt_over_tasks(spark):
    ring = F.expr("array(named_struct('x', 0D, 'y', 0D), named_struct('x', 9D, 'y', 0D), named_struct('x', 9D, 'y', 9D))")
    targets = spark.range(1000).select(F.col("id").alias("cell"), ring.alias("ring")).coalesce(1)
    src = spark.range(1).select(F.col("id").alias("poly_id"), ring.alias("ring"), F.lit(2.0).alias("value")).coalesce(1)
    dealt = polygons._dealt(targets)
    sizes = [r.n for r in dealt.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 4 * spark.sparkContext.defaultParallelism and max(sizes) < 3 * min(sizes)
    found = polygons.areal_interpolate(src, targets, "value", "cell", tile=4.0)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Repartition") >= 2
    assert {round(r.value, 9) for r in found.collect()} == {2.0}

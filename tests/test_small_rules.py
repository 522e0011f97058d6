"""Edge rules of columns, aggregates, joins and summaries on tiny tables."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from airgrid.functions import aggregates as agg, calendar as cal, projection, quality, scalars as sc
from airgrid.operators import grid, joins, metrics, neighbors, quantiles, raster, reshape, rollup
from airgrid.plans import inventories, surfaces
from airgrid.sources import files


def one(df):
    return df.head()[0]


def test_text_and_number_rules(spark):
    row = spark.sql("SELECT '123456' AS a, CAST(NULL AS STRING) AS n, '$ 1,250.5' AS p, 0.0D AS z, 12345.678D AS v, -0.00123456D AS w")
    got = row.select(
        sc.pad_left(F.col("a"), 5), sc.paste("-", F.col("a"), F.col("n")), sc.lenient_number(F.col("p")),
        sc.significant(F.col("z"), 4), sc.significant(F.col("v"), 4), sc.significant(F.col("w"), 3),
        sc.not_in(F.col("n"), ["x"]), sc.inverse_square_weight(F.col("z")),
    ).head()
    assert tuple(got) == ("123456", "123456-NA", 1250.5, 0.0, 12350.0, -0.00123, True, 100.0)


def test_dates(spark):
    rows = spark.createDataFrame([(2019, 366), (2020, 366), (2020, 1)], "y int, d int")
    got = [r[0] for r in rows.select(cal.date_of_year_day(F.col("y"), F.col("d"))).collect()]
    assert got == [None, dt.date(2020, 12, 31), dt.date(2020, 1, 1)]
    days = spark.sql("SELECT explode(sequence(DATE '2020-01-01', DATE '2020-12-31')) AS d")
    holidays = [r.d.isoformat()[5:] for r in days.where(cal.is_major_holiday(F.col("d"))).orderBy("d").collect()]
    assert holidays == ["01-01", "01-20", "05-25", "07-04", "09-07", "11-26", "12-25"]
    assert one(days.where("d = '2020-12-31'").select(cal.week_block(F.col("d")))) == 53


def test_quality_bits_both_readings(spark):
    flags = spark.createDataFrame([(v,) for v in (0, 1, 2, 3, 97, 65535, 1 << 13)], "qa int")
    keep = lambda order: [r[0] for r in flags.select(quality.quality_keep(F.col("qa"), order)).collect()]
    assert keep("documented") == [False, True, True, False, True, False, False]
    assert keep("as_written") == [False, False, False, False, False, False, True]


def test_strict_and_weighted_aggregates(spark):
    rows = spark.createDataFrame([("a", 1.0, 1.0), ("a", None, 9.0), ("b", 2.0, 1.0), ("c", None, 2.0)], "k string, v double, w double")
    got = {
        r.k: (r.m, r.s, r.w)
        for r in rows.groupBy("k").agg(
            agg.strict_mean(F.col("v")).alias("m"), agg.strict_sum(F.col("v")).alias("s"),
            agg.weighted_mean(F.col("v"), F.col("w")).alias("w"),
        ).collect()
    }
    assert got == {"a": (None, None, 1.0), "b": (2.0, 2.0, 2.0), "c": (None, None, None)}


def test_constant_group_has_no_r_squared(spark):
    rows = spark.createDataFrame([(1.0, 2.0)] * 3, "o double, p double")
    assert one(rows.agg(agg.r_squared(F.col("o"), F.col("p")))) is None
    assert one(rows.agg(agg.origin_slope(F.col("o"), F.col("p")))) == 2.0


def test_update_join_last_wins_even_when_missing(spark):
    left = spark.createDataFrame([(1, 10), (2, 20), (2, 21)], "k int, id int")
    right = spark.createDataFrame([(2, 5.0, 1), (2, None, 2), (3, 7.0, 3)], "k int, v double, seq int")
    got = {r.id: r.v for r in joins.update_join(left, right, ["k"], ["v"]).collect()}
    assert got == {10: None, 20: None, 21: None}
    first = {r.id: r.v for r in joins.update_join(left, right, ["k"], ["v"], tie="first").collect()}
    assert first == {10: None, 20: 5.0, 21: 5.0}
    with pytest.raises(ValueError):
        joins.update_join(left, right.withColumn("seq", F.lit(1)), ["k"], ["v"], validate=True)


def test_interval_and_vintage_edges(spark):
    spans = spark.sql("SELECT 1 AS k, DATE '2020-02-28' AS a, DATE '2020-03-01' AS b UNION ALL SELECT 2, DATE '2020-02-02', DATE '2020-02-01'")
    assert [r.date.day for r in joins.expand_interval(spans, "a", "b").orderBy("date").collect()] == [28, 29, 1]
    years = spark.range(2000, 2021).select(F.col("id").cast("int").alias("y"))
    pick = joins.nearest_vintage(F.col("y"), [2008, 2011, 2014, 2017])
    by_rule = {r.y: r.v for r in years.select("y", pick.alias("v")).collect()}
    assert all(by_rule[y] == (2008 if y < 2010 else 2011 if y < 2013 else 2014 if y < 2016 else 2017) for y in by_rule)


def test_raster_cell_edges(spark):
    f = raster.RasterFrame(2, 3, 0.0, 3.0, 0.0, 2.0)
    points = spark.createDataFrame([(0.0, 2.0), (3.0, 0.0), (3.1, 1.0), (1.5, 1.0)], "x double, y double")
    assert [r[0] for r in points.select(raster.raster_cell(F.col("x"), F.col("y"), f)).collect()] == [1, 6, None, 5]


def test_missing_county_years(spark):
    emis = spark.createDataFrame([("1", 2008, "event", 5.0), ("1", 2011, "event", 6.0)], "fips string, nei_year int, eis string, total double")
    counties = spark.createDataFrame([("00001",), ("00002",)], "fips string")
    plain = inventories.county_inventory(emis, counties)
    assert plain.count() == 3 and plain.where("nei_year IS NULL").count() == 1
    full = inventories.county_inventory(emis, counties, complete=True)
    assert full.count() == 4
    assert {(r.fips, r.event) for r in full.where("nei_year = 2008").collect()} == {("00001", None), ("00002", None)}


def test_wide_by_refuses_duplicates(spark):
    rows = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0)], "k int, n string, v double")
    with pytest.raises(Exception, match="more than one"):
        reshape.wide_by(rows, ["k"], "n", "v", ["a"]).collect()


def test_exact_quantiles_with_ties_and_hot_group(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.col("id") * 7919 % 5003).cast("double")).alias("v"),
        F.when(F.col("id") % 4 > 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"),
    ).union(spark.sql("SELECT CAST(NULL AS DOUBLE), 'hot' UNION ALL SELECT double('NaN'), NULL UNION ALL SELECT 3.0D, NULL"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.k: [r[f"q{i}"] for i in range(6)] for r in quantiles.exact_quantiles(rows, ["k"], ["v"], probs).collect()}
    want = {
        r.k: r.p for r in rows.where("v IS NOT NULL AND NOT isnan(v)").groupBy("k").agg(F.percentile("v", probs).alias("p")).collect()
    }
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_quantiles_of_a_large_group_are_narrowed(spark):
    """One group of a million distinct values, one of a few, and one NULL group with infinities."""
    rows = spark.range(1_000_000).select(
        F.lit("large").alias("k"), (F.col("id") * 7919 % 1_000_003 - 500_000).cast("double").alias("v")
    )
    rows = rows.union(spark.range(5).select(F.lit("few"), F.col("id").cast("double")))
    rows = rows.union(spark.range(9000).select(F.lit(None).cast("string"), F.exp(F.col("id") / 13)))
    rows = rows.union(spark.range(3000).select(F.lit(None).cast("string"), F.lit(float("inf"))))
    probs, bound = [0.0, 0.25, 0.5, 0.999, 1.0], 2000
    got = quantiles.exact_quantiles(rows, ["k"], ["v"], probs, bound).collect()
    want = {r.k: r.p for r in rows.groupBy("k").agg(F.percentile("v", probs).alias("p")).collect()}
    assert {r.k: [r[f"q{i}"] for i in range(5)] for r in got} == {k: pytest.approx(v) for k, v in want.items()}
    weighted = rows.groupBy("k", "v").agg(F.count(F.lit(1)).alias("_w")).withColumnRenamed("v", "_v")
    large = weighted.groupBy("k").agg(F.sum("_w").alias("n")).where("n > 5")
    parts = quantiles.narrowed_groups(weighted, large, ["k"], probs, bound).groupBy("k", "_part").count()
    assert 5 <= parts.count() <= 20 and parts.agg(F.max("count")).first()[0] <= bound


def test_box_stats(spark):
    rows = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "v double").withColumn("g", F.lit(1))
    r = quantiles.box_stats(rows, ["g"], "v").head()
    assert (r.q25, r["median"], r.q75, r.low_whisker, r.high_whisker, r.outliers) == (2, 3, 4, 1, 4, 1)


def test_missing_error_has_no_median(spark):
    rows = spark.createDataFrame([("a", 1.0, 2.0, True), ("a", None, 1.0, None), ("b", 1.0, 4.0, False)], "g string, pm25 double, pred double, ci_covered boolean")
    got = {r.g: r.mae for r in metrics.accuracy_metrics(rows, ["g"]).collect()}
    assert got == {"a": None, "b": 3.0}


def test_classes_and_lowest(spark):
    rows = spark.createDataFrame([(1, 0.0), (2, 20000.0), (3, 30000.0), (4, -5.0)], "id int, v double")
    counts = {r["class"]: r.n for r in rollup.class_counts(rows, "v", [0, 20000, 30000]).collect()}
    assert counts == {0: 1, 1: 2, None: 1}
    assert rollup.lowest_row(rows.where("v >= 0"), "v", "id").head().id == 1


def test_projection_round_trips(spark):
    rows = spark.sql("SELECT -120D + 5 * (id % 10) AS lon, 25D + 2 * (id % 12) AS lat FROM range(60)")
    x, y = projection.albers(F.col("lon"), F.col("lat"))
    back = rows.withColumns({"x": x, "y": y})
    lon, lat = projection.albers_inverse(F.col("x"), F.col("y"))
    worst = back.select(F.max(F.abs(lon - F.col("lon")) + F.abs(lat - F.col("lat")))).head()[0]
    assert worst < 1e-8
    sx, sy = projection.sinusoidal(F.col("lon"), F.col("lat"))
    flat = rows.withColumns({"x": sx, "y": sy})
    lon, lat = projection.sinusoidal_inverse(F.col("x"), F.col("y"))
    assert flat.select(F.max(F.abs(lon - F.col("lon")) + F.abs(lat - F.col("lat")))).head()[0] < 1e-9
    origin = spark.sql("SELECT -107D AS lon, 50D AS lat")
    lx, ly = projection.lambert(F.col("lon"), F.col("lat"))
    got = origin.select(lx, ly).head()
    assert math.isclose(got[0], 5632642.22547, abs_tol=1e-6) and math.isclose(got[1], 4612545.65137, abs_tol=1e-3)


def test_weather_cell_of_known_places(spark):
    places = spark.createDataFrame([(-96.0, 37.0, 61978), (-118.0, 34.0, 65405), (-80.0, 40.0, 54340)], "lon double, lat double, want long")
    x, y = projection.albers(F.col("lon"), F.col("lat"))
    got = surfaces.add_weather_cell(places.withColumns({"x": x, "y": y})).collect()
    assert [r.weather_cell for r in got] == [r.want for r in got]


def test_rings_are_projected(spark):
    ring = spark.sql("SELECT array(named_struct('lon', -96D, 'lat', 23D), named_struct('lon', -90D, 'lat', 40D)) AS ring")
    x, y = projection.albers(F.lit(-90.0), F.lit(40.0))
    row = ring.select(projection.ring_albers(F.col("ring")).alias("r"), x.alias("x"), y.alias("y")).head()
    assert abs(row.r[0].x) < 1e-6 and abs(row.r[0].y) < 1e-6
    assert (row.r[1].x, row.r[1].y) == pytest.approx((row.x, row.y))


def test_numbers_years_and_comments_in_text(spark):
    texts = ["12.5 each", "$1,200 per", "3.5 (est)", "1,234,567.8", "-.5e2x", "e-mail", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(sc.lenient_number(F.col("t"))).collect()]
    assert got == [12.5, 1200.0, 3.5, 1234567.8, -50.0, None, None, None]
    names = ["daily_88101_2004.csv", "/a/1999/x_2003_12345", "no_88101", "2011", "a2005b.csv.gz"]
    rows = spark.createDataFrame([(t,) for t in names], "t string")
    assert [r[0] for r in rows.select(sc.name_year(F.col("t"))).collect()] == [2004, 2003, None, 2011, 2005]
    assert one(rows.where("t = '2011'").select(sc.name_year(F.col("t"), r"(\d{2})$"))) == 11
    lines = ['"Plant #4, north",7', "a,1 # b", "#", 'x "y # z', "no mark  "]
    rows = spark.createDataFrame([(t,) for t in lines], "value string")
    assert [r.value for r in files.clean_lines(rows).collect()] == [lines[0], "a,1", lines[3], "no mark"]


def test_only_whole_header_lines_are_headers(spark):
    lines = spark.createDataFrame([("id,v",), ("idaho,3",), ('"id", v',), ("id,4",)], "value string")
    got = files.parse_lines(lines, "id string, v double").collect()
    assert sorted(tuple(r) for r in got) == [("id", 4.0), ("idaho", 3.0)]


def test_nan_is_missing(spark):
    rows = spark.sql("SELECT 1 AS k, DATE '2020-01-01' AS d, explode(array(double('NaN'), 2.0D)) AS v")
    assert one(neighbors.cell_day_mean(rows, "k", "d", "v").select("v")) == 2.0
    assert one(rows.agg(agg.strict_mean(F.col("v")))) is None
    centre = grid.add_cell(spark.sql("SELECT 0D AS x, 0D AS y, DATE '2020-01-01' AS date, explode(array(double('NaN'), 2.0D)) AS pm25"), "x", "y", 3)
    near = neighbors.idw_neighbors(centre, 3, k=1).collect()
    assert len(near) == 7 and all(r.nearby == 2.0 for r in near)


def test_equal_order_never_mixes_rows(spark):
    left = spark.createDataFrame([(1,)], "k int")
    right = spark.createDataFrame([(1, i, -i, 5) for i in range(40)], "k int, a int, b int, seq int").repartition(8)
    row = joins.update_join(left, right, ["k"], ["a", "b"]).head()
    assert row.a == -row.b

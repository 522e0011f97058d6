"""Files, work lists, forests and scoring on small inputs."""

import pytest
from pyspark.sql import functions as F

from airgrid.operators import forest
from airgrid.plans import modelling, reports
from airgrid.sources import files, lookups, worklog


def test_csv_sources(spark, tmp_path):
    (tmp_path / "daily_2004.csv").write_text("# made by hand\nid,v\na,1.5\nb,x\n")
    (tmp_path / "daily_2005.csv").write_text("id,v\nc,3\n")
    paths = [str(tmp_path / "daily_2004.csv"), str(tmp_path / "daily_2005.csv")]
    read = files.with_file_year(files.read_csv(spark, paths, "id string, v double", comment="#"))
    assert sorted((r.id, r.v, r.year) for r in read.collect()) == [("a", 1.5, 2004), ("b", None, 2004), ("c", 3.0, 2005)]
    good, bad = files.split_rejects(files.read_csv(spark, paths, "id string, v double", "#", reject=True).cache())
    assert good.count() == 2 and bad.count() == 1
    lenient = files.read_text_columns(spark, paths, ["id", "v"], ["v"])
    assert {r.id: r.v for r in lenient.collect()} == {"a": 1.5, "b": None, "c": 3.0}
    (tmp_path / "tail.csv").write_text("id,v\nd,4 # late\n#only\ne,5\n")
    lines = files.cut_comments(spark, str(tmp_path / "tail.csv"))
    assert sorted(files.parse_lines(lines, "id string, v double").collect()) == [("d", 4.0), ("e", 5.0)]
    (tmp_path / "wide.csv").write_text("id,w\nz,9\n")
    both = files.read_many(spark, {paths[1]: "id string, v double", str(tmp_path / "wide.csv"): "id string, w double"})
    assert sorted((r.id, r.v, r.w) for r in both.collect()) == [("c", 3.0, None), ("z", None, 9.0)]


def test_snapshots(spark, tmp_path):
    df = spark.range(100).select((F.col("id") * 37 % 100).alias("cell"), "id")
    files.write_sorted(df, ["cell"], str(tmp_path / "sorted"), 2)
    back = files.read_snapshot(spark, str(tmp_path / "sorted"))
    assert back.count() == 100
    parts = back.select(F.spark_partition_id().alias("p"), "cell").groupBy("p").agg(F.min("cell").alias("a"), F.max("cell").alias("b"))
    spans = sorted((r.a, r.b) for r in parts.collect())
    assert all(one[1] < two[0] for one, two in zip(spans, spans[1:]))


def test_tiles_and_vintages(spark):
    assert len(lookups.SATELLITE_TILES) == 14 and lookups.SATELLITE_TILES[0] == "h08v04"
    years = {r.year: r.vintage for r in lookups.vintage_years(spark, lookups.EMISSION_VINTAGES).collect()}
    assert len(years) == 21 and years[2009] == 2008 and years[2016] == 2017


def train_rows(spark):
    return spark.range(1200).select(
        (F.col("id") % 40).alias("cell"),
        F.date_add(F.lit("2019-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("date"),
        F.when(F.col("id") % 10 > 0, F.col("id") % 17).cast("double").alias("a"),
        (F.col("id") * 31 % 23).cast("double").alias("b"),
    ).withColumns(
        {
            "year": F.year("date"),
            "pm25": F.coalesce(F.col("a"), F.lit(40.0)) * 2 + F.col("b") / 10 + (F.col("cell") % 5),
        }
    )


def test_forest_out_of_bag_and_scoring(spark, tmp_path):
    train = train_rows(spark).cache()
    forests, predicted = modelling.fit_and_predict(train, ["a", "b"], groups=3, trees=2, depth=5, bins=16)
    rows = predicted.cache()
    assert sorted(forests.models) == [2019, 2020] and rows.count() == train.count()
    assert rows.where("se_inbag < 0 OR se_oob < 0").count() == 0
    # A row is out of bag exactly when some group did not see its cluster.
    seen = [forest.kept_by_group(F.col("cell"), g, 224) for g in range(3)]
    always = seen[0] & seen[1] & seen[2]
    assert rows.where(always != F.col("pred_oob").isNull()).count() == 0
    error = rows.agg(F.avg(F.abs(F.col("pm25") - F.col("pred_oob"))), F.avg(F.abs(F.col("pm25") - F.col("pred_inbag")))).head()
    assert error[0] >= error[1] and error[1] < 6
    # Missing values carry information: they have a value of their own here.
    assert train.where("a IS NULL").count() > 0
    path = str(tmp_path / "models")
    forests.save(path)
    again = forest.YearForests.load(path)
    assert (again.features, again.cluster, again.seed) == (["a", "b"], "cell", 224)
    first = forests.score(train).groupBy("year").agg(F.sum("pred").alias("s"))
    second = again.score(train).groupBy("year").agg(F.sum("pred").alias("s"))
    assert {r.year: round(r.s, 6) for r in first.collect()} == {r.year: round(r.s, 6) for r in second.collect()}
    importance = {r.variable: r.var_imp for r in forest.split_importance(forest.saved_nodes(spark, path, 2019, 3), ["a", "b"]).collect()}
    assert abs(sum(importance.values()) - 1) < 1e-9 and importance["a"] > importance["b"]

    grid_rows = train.select(F.concat(F.lit("r"), F.col("cell") % 2).alias("region"), "cell", "date", "year", "a", "b")
    out, keys = str(tmp_path / "pred"), "region string, year int"
    built = []

    def grid_of(left):
        built.append(sorted((r.region, r.year) for r in left.collect()))
        return grid_rows.join(left, ["region", "year"], "left_semi")

    assert worklog.finished(spark, out, ["region", "year"], keys).count() == 0
    modelling.score_regions(spark, grid_rows.where("region = 'r0'"), grid_of, forests, out)
    done = worklog.finished(spark, out, ["region", "year"], keys)
    assert sorted((r.region, r.year) for r in done.collect()) == [("r0", 2019), ("r0", 2020)]
    left = worklog.unfinished(grid_rows, done, ["region", "year"])
    assert left.where("region = 'r0'").count() == 0 and left.count() == grid_rows.where("region = 'r1'").count()
    before = {f for f in spark.read.parquet(out).inputFiles()}
    modelling.score_regions(spark, grid_rows, grid_of, forests, out)
    assert spark.read.parquet(out).count() == train.count()
    assert before <= set(spark.read.parquet(out).inputFiles())
    assert built == [[("r0", 2019), ("r0", 2020)], [("r1", 2019), ("r1", 2020)]]
    # Only the manifest is read to find what is finished, and nothing is built when all is.
    names = worklog.finished(spark, out, ["region", "year"], keys).inputFiles()
    assert names and all("/_finished/" in name for name in names)
    assert modelling.score_regions(spark, grid_rows, grid_of, forests, out).count() == 0 and len(built) == 2
    assert modelling.score_regions(spark, grid_rows, grid_of, forests, out, force=True).count() == 4
    assert spark.read.parquet(out).count() == train.count()
    # Output whose job did not end has no entry and is written again.
    half = str(tmp_path / "half")
    spark.createDataFrame([("r0", 2019, 1.0)], "region string, year int, pm_pred double").write.partitionBy("region", "year").parquet(half)
    assert worklog.finished(spark, half, ["region", "year"], keys).count() == 0
    # Years without a model stay, without a prediction, and are refused when regions are written.
    later = grid_rows.limit(5).withColumn("year", F.lit(2050))
    assert [r.pred for r in forests.score(grid_rows.limit(3).unionByName(later)).where("year = 2050").collect()] == [None] * 5
    with pytest.raises(ValueError, match="2050"):
        modelling.score_regions(spark, later, grid_of, forests, out)


def test_tree_estimates_take_off_the_scatter_within_groups(spark):
    rows = [("a", 0, 1.0), ("a", 0, 3.0), ("a", 1, 6.0), ("a", 1, 8.0), ("b", 0, 1.0), ("b", 0, 9.0), ("b", 1, 5.0), ("c", 0, 2.0), ("a", 1, None)]
    got = {r.k: r for r in forest.tree_estimates(spark.createDataFrame(rows, "k string, g int, v double"), ["k"], "g", "v").collect()}
    assert (got["a"].pred, got["a"].between, got["a"].noise, got["a"].se) == (4.5, 6.25, 1.0, pytest.approx(5.25**0.5))
    assert (got["b"].between, got["b"].se, got["c"].se, got["c"].pred) == (0.0, 0.0, None, 2.0)


def test_ranges_open_only_the_files_they_need(spark, tmp_path):
    path = str(tmp_path / "sorted")
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), "id").union(spark.sql("SELECT NULL, -1"))
    files.write_sorted(rows, ["k"], path, partitions=20)
    assert spark.read.parquet(path).count() == 5001
    some = files.read_range(spark, path, "k", F.lit(1000), F.lit(1300))
    assert some.exceptAll(rows.where("k BETWEEN 1000 AND 1300")).count() == 0 and some.count() == rows.where("k BETWEEN 1000 AND 1300").count()
    assert 1 <= len(some.inputFiles()) <= 4 and len(spark.read.parquet(path).inputFiles()) >= 18
    assert files.read_range(spark, path, "k", F.lit(9000), F.lit(9001)).count() == 0


def test_two_ways_to_match_observations(spark):
    predicted = spark.sql("SELECT 2019 AS year, 1 AS cell, DATE '2019-01-01' AS date, 1D AS pred_oob, 1D AS se_oob, 2D AS pred_inbag, 1D AS se_inbag")
    predicted = predicted.union(predicted)
    obs = spark.sql("SELECT 1 AS cell, DATE '2019-01-01' AS date, explode(array(1D, 3D)) AS pm25")
    assert reports.evaluation_rows(predicted, obs).where("oob = 'oob'").count() == 4
    mean = reports.evaluation_rows(predicted, obs, "cell_mean").where("oob = 'oob'")
    assert [r.pm25 for r in mean.collect()] == [2.0, 2.0]


def test_report_tables(spark):
    rows = reports.evaluation_rows(
        spark.sql("SELECT 2019 AS year, id % 3 AS cell, date_add(DATE '2019-01-01', int(id)) AS date, id * 1D AS pred_oob, 1D AS se_oob, id + 1D AS pred_inbag, 2D AS se_inbag FROM range(30)"),
        spark.sql("SELECT id % 3 AS cell, date_add(DATE '2019-01-01', int(id)) AS date, id + 0.5D AS pm25 FROM range(30)"),
    )
    report = reports.accuracy_report(rows)
    assert {r.oob: r.mae for r in report["overall"].collect()} == {"oob": 0.5, "inbag": 0.5}
    assert report["by_time"].count() == 10 and report["by_year"].count() == 1


def test_regions_with_long_names_are_written_and_resumed(spark, tmp_path):
    train = train_rows(spark).where("year = 2019").cache()
    forests = forest.cluster_forest(train, ["a", "b"], "pm25", "cell", groups=2, trees=1, depth=2, bins=8)
    # As many cells as there are under an ancestor two levels up, and one whose name is a number.
    merged = "-".join(str(864691128455135232 + k) for k in range(49))
    region = F.when(F.col("cell") % 2 == 0, F.lit(merged)).otherwise(F.lit("0864691128455135232"))
    rows = train.select(region.alias("region"), "cell", "date", "year", "a", "b")
    out = str(tmp_path / "long")
    grid_of = lambda left: rows.join(left, ["region", "year"], "left_semi")
    assert modelling.score_regions(spark, rows.where("cell % 2 = 0"), grid_of, forests, out).count() == 1
    assert modelling.score_regions(spark, rows, grid_of, forests, out).count() == 1
    back = spark.read.parquet(out)
    want = {r.region: r["count"] for r in rows.groupBy("region").count().collect()}
    assert {r.region: r["count"] for r in back.groupBy("region").count().collect()} == want
    one = back.where(F.col(modelling.FOLDER) == F.sha2(F.lit(merged), 256))
    assert one.count() == want[merged] and one.where(F.col(modelling.FOLDER) != modelling.folder_key()).count() == 0
    assert modelling.score_regions(spark, rows, grid_of, forests, out).count() == 0


def test_a_fit_reads_the_rows_of_its_year_only(spark, monkeypatch):
    opened = []

    class Learner(forest.RandomForestRegressor):
        def fit(self, rows):
            years = [r.year for r in rows.select("year").distinct().collect()]
            opened.append((years, rows.select(F.input_file_name().alias("f")).distinct().collect()))
            return super().fit(rows)

    monkeypatch.setattr(forest, "RandomForestRegressor", Learner)
    train = train_rows(spark)
    forests = forest.cluster_forest(train, ["a", "b"], "pm25", "cell", groups=2, trees=1, depth=2, bins=8)
    assert sorted(forests.models) == [2019, 2020] and len(opened) == 4
    for years, names in opened:
        assert len(years) == 1 and names and all(f"/year={years[0]}/" in r.f for r in names)
    assert forests.score(train).where("pred IS NULL").count() == 0

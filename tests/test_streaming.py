"""Daily means as a stream against the batch means."""

import datetime as dt

from pyspark.sql import functions as F

from airgrid.operators.neighbors import cell_day_mean
from airgrid.streaming import daily

ROWS = "cell long, time timestamp, pm25 double"
MEANS = "cell long, date date, pm25 double, n long"


def at(day, hour=0):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=day, hours=hour)


def run(spark, where, late):
    arriving = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(f"{where}/in")
    means = daily.daily_means(arriving, "cell", "time", "pm25", late)
    daily.keep_updated(means, f"{where}/out", f"{where}/state", availableNow=True).awaitTermination()
    return daily.latest(spark, f"{where}/out", MEANS, ["cell", "date"])


def test_stream_equals_batch_and_goes_on_after_a_stop(spark, tmp_path):
    where = str(tmp_path)
    assert daily.latest(spark, f"{where}/out", MEANS, ["cell", "date"]).count() == 0
    parts = [
        [(1, at(0, 1), 2.0), (1, at(0, 23), None), (2, at(1), 5.0), (3, at(0), float("nan"))],
        [(1, at(0, 5), 6.0), (2, at(3), 7.0), (2, None, 100.0), (None, at(2), 1.0)],
        [(1, at(0, 7), 1.0), (1, at(0, 7), 1.0), (2, at(3, 23), 9.0)],
    ]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(f"{where}/in")
        got = run(spark, where, "30 days")  # each run goes on from the one before
        seen = spark.createDataFrame([r for part in parts[: i + 1] for r in part], ROWS).where("time IS NOT NULL")
        want = cell_day_mean(seen.withColumn("date", F.to_date("time")), "cell", "date", "pm25")
        key = lambda r: repr((r.cell, r.date, r.pm25))
        assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    assert {(r.cell, r.n) for r in got.where("date = '2020-01-01'").collect()} == {(1, 4), (3, 0)}
    # Without new files nothing changes.
    assert run(spark, where, "30 days").count() == got.count()


def test_closed_days_take_no_more_readings(spark, tmp_path):
    where = str(tmp_path)
    for rows in ([(1, at(0), 2.0)], [(1, at(20), 4.0)], [(1, at(0), 50.0), (1, at(19), 6.0)]):
        spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(f"{where}/in")
        got = run(spark, where, "5 days")
    assert {(r.date.day, r.pm25) for r in got.collect()} == {(1, 2.0), (21, 4.0), (20, 6.0)}

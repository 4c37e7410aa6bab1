"""Streams of disordered files give what the batch gives."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hazeline import series
from hazeline.operators.features import TRAIN, add_features
from hazeline.series import Layout
from hazeline.streaming import features as streaming
from hazeline.streaming import ingest

SCHEMA = "city string, timestamp timestamp, aqi int, pm2_5 double, pm10 double, no2 double, so2 double, o3 double, co double"
START = dt.datetime(2024, 1, 1)


def hours(city, n):
    return [(city, START + dt.timedelta(hours=i), (i * 37) % 101, *[float((i * 7 + k) % 53) for k in range(6)]) for i in range(n)]


LAYOUT = Layout(block_rows=128)


class Arrivals:
    """A folder in which parts arrive one file at a time, and the stream that reads it."""

    def __init__(self, spark, root, lateness="2 hours", idle="6 hours"):
        self.spark, self.root, self.times = spark, str(root), (lateness, idle)

    def add(self, *parts):
        for part in parts:
            self.spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/in")

    def run(self):
        stream = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.root}/in")
        paths = (f"{self.root}/{name}" for name in ("out", "late", "log"))
        query = streaming.feature_stream(stream, *paths, TRAIN, LAYOUT, *self.times)
        query.awaitTermination()
        return query

    def features(self):
        return self.spark.read.parquet(f"{self.root}/out").drop("batch_id")

    def late(self):
        return {(r.city, r.timestamp) for r in self.spark.read.parquet(f"{self.root}/late").collect()}


def whole(spark, rows):
    return series.drop_bookkeeping(add_features(series.number_rows(spark.createDataFrame(rows, SCHEMA), LAYOUT), TRAIN, LAYOUT))


def assert_same(got, wanted, count):
    names = sorted(wanted.columns)
    mine, theirs = (df.select(names).orderBy("city", "timestamp").collect() for df in (got, wanted))
    assert len(mine) == len(theirs) == count
    for a, b in zip(mine, theirs):
        for name in names:
            assert a[name] == (pytest.approx(b[name], abs=1e-9) if isinstance(b[name], float) else b[name]), name


def test_disordered_batches_equal_the_whole_over_a_restart(spark, tmp_path):
    rows = hours("a", 120) + hours("b", 40)
    rng = random.Random(3)
    # every row is displaced by less than the lateness of three hours
    rows.sort(key=lambda r: (r[1] + dt.timedelta(minutes=rng.randrange(170)), r[0]))
    arrivals = Arrivals(spark, tmp_path, "3 hours")
    arrivals.add(rows[:50], rows[50:51])
    arrivals.run()
    arrivals.add(rows[51:110], rows[110:], [("end", START + dt.timedelta(days=9), 1, *[0.0] * 6)])
    arrivals.run()
    assert_same(arrivals.features(), whole(spark, rows), 160)
    assert arrivals.late() == set()


def test_rows_beyond_the_lateness_are_kept_apart(spark, tmp_path):
    rows = hours("a", 30)
    unplaced = (None, START, 1, *[0.0] * 6), ("a", None, 1, *[0.0] * 6)
    arrivals = Arrivals(spark, tmp_path)
    # the watermark is far beyond the late row, which Spark alone would drop
    arrivals.add(rows[:5] + rows[6:20], [rows[5], *unplaced], rows[20:])
    arrivals.run()
    assert arrivals.features().count() == 27
    assert arrivals.late() == {("a", rows[5][1]), (None, START), ("a", None)}


def test_a_timer_releases_an_idle_city(spark, tmp_path):
    arrivals = Arrivals(spark, tmp_path)
    arrivals.add(hours("idle", 10), hours("busy", 12))
    arrivals.run()
    count = lambda city: arrivals.features().where(F.col("city") == city).count()
    assert (count("idle"), count("busy")) == (8, 10)
    # the idle city sends nothing, yet its last rows leave as the other one goes on
    arrivals.add(hours("busy", 17)[12:])
    query = arrivals.run()
    assert (count("idle"), count("busy")) == (10, 15)
    assert_same(arrivals.features().where("city = 'idle'"), whole(spark, hours("idle", 10)), 10)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 2
    # after the timer its context is still there
    arrivals.add(hours("idle", 30)[10:])
    arrivals.run()
    assert_same(arrivals.features().where("city = 'idle'"), whole(spark, hours("idle", 28)), 28)


def test_an_empty_stream_gives_nothing(spark, tmp_path):
    arrivals = Arrivals(spark, tmp_path)
    arrivals.add([])
    arrivals.run()


def test_earliest_of_hour_whatever_the_order(spark):
    rows = [("a", START + dt.timedelta(minutes=m), m) for m in (50, 5, 70, 61, 5)] + [("a", None, 1)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "city string, timestamp timestamp, aqi int")
        assert sorted(r.aqi for r in ingest.once_per_hour(df).collect()) == [5, 61]
    assert ingest.once_per_hour(df.where(F.lit(False))).count() == 0

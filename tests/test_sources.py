"""Payload files with malformed records, restarts, and scans of the newest partitions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hazeline.schemas import POLLUTANTS
from hazeline.session import scratch_path
from hazeline.sources import payload, tables
from hazeline.streaming import ingest

START = dt.datetime(2024, 1, 1)
SCHEMA = "city string, timestamp timestamp, aqi int, " + ", ".join(f"{p} double" for p in POLLUTANTS)


def hours(spark, first, last, cities=("a",)):
    rows = [(c, START + dt.timedelta(hours=h), h % 300, *[float(h + k) for k in range(6)]) for c in cities for h in range(first, last)]
    return spark.createDataFrame(rows, SCHEMA)


def broken(spark, folder, *records):
    spark.createDataFrame([(r,) for r in records], "value string").coalesce(1).write.mode("append").text(folder)


def test_malformed_records_are_kept_apart_and_none_counts_twice(spark, tmp_path):
    folder, out, rejects, log = (f"{tmp_path}/{n}" for n in ("in", "out", "rejects", "log"))

    def run():
        ingest.ingest_payloads(spark, folder, out, rejects, log, files_per_batch=1)
        return spark.read.parquet(out), spark.read.parquet(rejects)

    payload.write_payloads(hours(spark, 0, 30), folder)
    broken(spark, folder, '{"city": "a", "list": [{"main"', "no json at all")
    kept, bad = run()
    assert kept.count() == 30 and {r.record for r in bad.collect()} == {'{"city": "a", "list": [{"main"', "no json at all"}
    # nothing new: nothing is added
    kept, bad = run()
    assert (kept.count(), bad.count()) == (30, 2)
    payload.write_payloads(hours(spark, 30, 50, ("a", "b")), folder)
    broken(spark, folder, "{]")
    kept, bad = run()
    assert (kept.count(), bad.count()) == (70, 3)
    # the stream gives what the batch gives, and what a failed batch leaves behind is not read
    names = ["city", "timestamp", "aqi", *POLLUTANTS]
    batch = payload.to_readings(payload.read_payloads(spark, folder)).select(names)
    assert kept.select(names).exceptAll(batch).isEmpty() and batch.exceptAll(kept.select(names)).isEmpty()
    hours(spark, 90, 95).drop("city").coalesce(1).write.parquet(f"{out}/city=a/dt=2024-01-04/stray")
    assert spark.read.parquet(out).count() == 70


def test_payload_files_are_rejected_in_batch(spark, tmp_path):
    broken(spark, f"{tmp_path}/in", '{"city": "a"', '{"city": "b", "list": []}')
    raw = payload.json_reader(spark.read, f"{tmp_path}/in")
    assert [r.record for r in payload.rejected(raw).collect()] == ['{"city": "a"']
    assert payload.to_readings(payload.read_payloads(spark, f"{tmp_path}/in")).count() == 0


@pytest.fixture(scope="module")
def history(spark):
    path = scratch_path(spark, "test-history")
    rows = hours(spark, 0, 240, ("a", "b")).unionByName(hours(spark, 240, 244, ("b",)))
    tables.append_readings(rows.withColumn("aqi", F.col("aqi").cast("long")), path)
    return path


def test_newest_history_reads_the_newest_partitions_only(spark, history):
    got = tables.newest_history(spark, history, 50)
    rows = got.collect()
    assert len(rows) == 50 and rows == sorted(rows, key=lambda r: (r.timestamp, r.city))
    assert rows[-1].timestamp == START + dt.timedelta(hours=243) and rows[0].timestamp == START + dt.timedelta(hours=217)
    assert dict(got.dtypes)["aqi"] == "int" and got.columns == ["city", *tables.SERVED]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "TakeOrderedAndProject" in plan
    # 4 rows of the last day and 48 of the one before, of eleven days
    assert len({f.split("dt=")[1][:10] for f in got.inputFiles()}) == 11 and ">= 2024-01-10" in plan


def test_newest_history_of_one_city_and_of_few_rows(spark, history):
    rows = tables.newest_history(spark, history, 30, "a").collect()
    assert {r.city for r in rows} == {"a"} and [r.timestamp.day for r in rows[:7]] == [9] * 6 + [10]
    assert tables.newest_history(spark, history, 10_000).count() == 484
    assert tables.newest_history(spark, history, 5, "nowhere").count() == 0


def test_times_come_from_either_column(spark, tmp_path):
    (tmp_path / "rows.csv").write_text("city,timestamp,dt,aqi\na,2024-01-01 05:00:00,7,1\na,,3600,2\na,,,3\n")
    got = tables.read_csv(spark, str(tmp_path), ("city", "timestamp", "dt", "aqi")).orderBy("aqi").collect()
    assert [r.timestamp for r in got] == [dt.datetime(2024, 1, 1, 5), dt.datetime(1970, 1, 1, 1), None]
    with pytest.raises(ValueError):
        tables.with_time(spark.range(1))

"""Sources, sinks and ingest jobs, fed from the ``events`` table."""

from pyspark.sql import functions as F

from catalog.fixture import composite_sql, readings, samples, with_tables
from catalog.registry import query, r, rounded
from hazeline.schemas import POLLUTANTS
from hazeline.session import scratch_path
from hazeline.sources import payload, tables
from hazeline.streaming import ingest

SHOWN = ("city", "timestamp", "aqi", *POLLUTANTS)
_SHOWN = ", ".join(SHOWN)


@query("S1 S2", with_tables(
    f"SELECT city, date_trunc('second', timestamp) AS timestamp, {composite_sql()} AS aqi, "
    f"{', '.join(POLLUTANTS)} FROM samples", "samples"))
def payload_readings(spark, sf_dir):
    """Payload documents parsed, flattened and scored."""
    documents = payload.as_documents(samples(spark, sf_dir))
    return payload.to_readings(payload.parse_payloads(documents, "payload").drop("payload")).select(*SHOWN)


_FILES = with_tables(
    f"SELECT city, date_trunc('second', timestamp) AS timestamp, {composite_sql()} AS aqi, {', '.join(POLLUTANTS)} FROM samples",
    "samples")


@query("S1 S2", _FILES)
def payload_files(spark, sf_dir):
    """The same from JSON files, one malformed record among them."""
    path = scratch_path(spark, "payloads")
    payload.write_payloads(samples(spark, sf_dir), path)
    spark.createDataFrame([('{"city": "city_0", "list": [{"main"',)], "value string").write.mode("append").text(path)
    return payload.to_readings(payload.read_payloads(spark, path)).select(*SHOWN)


@query("R1 S1 S3", _FILES)
def streamed_payloads(spark, sf_dir):
    """The same from a stream of JSON files that is stopped and started again between two deliveries."""
    path, rows = scratch_path(spark, "arrivals"), samples(spark, sf_dir)
    first = F.col("event_id") < rows.agg(F.avg("event_id")).first()[0]
    for part in (rows.where(first), rows.where(~first)):
        payload.write_payloads(part, f"{path}/in")
        ingest.ingest_payloads(spark, f"{path}/in", f"{path}/out", f"{path}/rejects", f"{path}/log")
    return spark.read.parquet(f"{path}/out").select(*SHOWN)


@query("S5 L1", with_tables(
    f"SELECT {_SHOWN} FROM (SELECT * FROM readings ORDER BY timestamp DESC, city LIMIT 500) ORDER BY timestamp, city", "readings"))
def newest_history(spark, sf_dir):
    """The newest 500 rows, from the few newest partitions that hold them."""
    path = scratch_path(spark, "history")
    tables.append_readings(readings(spark, sf_dir), path)
    return tables.newest_history(spark, path)


@query("S7", with_tables(
    f"SELECT city, date_trunc('second', timestamp) AS timestamp, {', '.join(POLLUTANTS)} FROM samples", "samples"))
def epoch_rows(spark, sf_dir):
    """CSV rows whose time stands in one column or, where that is empty, as seconds in another."""
    path, columns = scratch_path(spark, "csv"), ("city", "timestamp", "dt", *POLLUTANTS)
    stamp = F.date_trunc("second", "timestamp")
    rows = samples(spark, sf_dir).withColumn("dt", F.unix_seconds("timestamp"))
    rows = rows.withColumn("timestamp", F.when(F.col("pm2_5").isNull(), stamp))
    rows.select(*columns).write.option("header", True).csv(path)
    return tables.read_csv(spark, path, columns)


@query("S3", with_tables(f"SELECT {_SHOWN}, timestamp::DATE AS dt FROM readings", "readings"))
def appended_history(spark, sf_dir):
    """Readings appended to a table split by city and day, and read again."""
    path = scratch_path(spark, "history")
    tables.append_readings(readings(spark, sf_dir), path)
    return tables.read_history(spark, path).select(*SHOWN, "dt")


@query("S6 S8 X6", with_tables(
    f"SELECT {_SHOWN}, 'CSV file' AS source, false AS is_live FROM readings", "readings"))
def first_source(spark, sf_dir):
    """The warehouse table is not there, so rows come from the CSV file."""
    path = scratch_path(spark, "csv")
    readings(spark, sf_dir).select(*SHOWN).write.option("header", True).csv(f"{path}/rows")
    found = tables.first_available([
        ("Warehouse", lambda: tables.read_history(spark, f"{path}/none")),
        ("CSV file", lambda: tables.read_csv(spark, f"{path}/rows", SHOWN)),
    ])
    return tables.with_live_flag(found).select(*SHOWN, "source", "is_live")


@query("S4 S8 X6", with_tables(
    f"SELECT {_SHOWN}, 'Warehouse history' AS source, true AS is_live FROM readings", "readings"))
def live_source(spark, sf_dir):
    """The warehouse table is there, so the CSV file is not looked at."""
    path = scratch_path(spark, "live")
    tables.append_readings(readings(spark, sf_dir), path)
    found = tables.first_available([
        ("Warehouse history", lambda: tables.read_history(spark, path)),
        ("CSV file", lambda: tables.read_csv(spark, f"{path}/none", SHOWN)),
    ])
    return tables.with_live_flag(found).select(*SHOWN, "source", "is_live")


_EARLIEST = f"""SELECT city, timestamp, {', '.join(POLLUTANTS)} FROM samples
    QUALIFY row_number() OVER (PARTITION BY city, date_trunc('hour', timestamp) ORDER BY timestamp,
    {', '.join(p + ' NULLS FIRST' for p in POLLUTANTS)}) = 1"""


@query("R2", with_tables(_EARLIEST, "samples"))
def earliest_of_hour(spark, sf_dir):
    return ingest.once_per_hour(samples(spark, sf_dir).drop("event_id"))


@query("R2", with_tables(
    f"""SELECT * FROM ({_EARLIEST}) WHERE date_trunc('hour', timestamp) + INTERVAL 1 HOUR
        <= (SELECT max(timestamp) FROM samples) - INTERVAL 2 HOUR""", "samples"))
def streamed_earliest_of_hour(spark, sf_dir):
    """The same from a stream of files, which gives the hours that are closed."""
    rows, path = samples(spark, sf_dir).drop("event_id"), scratch_path(spark, "earliest")
    rows.write.parquet(f"{path}-arrivals")
    stream = spark.readStream.schema(rows.schema).parquet(f"{path}-arrivals")
    ingest.append_stream(ingest.once_per_hour(stream), path, f"{path}-log").awaitTermination()
    return spark.read.parquet(path).select("city", "timestamp", *POLLUTANTS)


@query("R3", with_tables(
    "SELECT city, date_trunc('hour', timestamp) AS timestamp, " + ", ".join(r(f"avg({p})", p) for p in POLLUTANTS)
    + ", count(*) AS samples FROM samples GROUP BY 1, 2", "samples"))
def hourly_pollutant_means(spark, sf_dir):
    means = ingest.hourly_means(samples(spark, sf_dir))
    return rounded(means.select("city", "timestamp", *POLLUTANTS, F.col("samples")))

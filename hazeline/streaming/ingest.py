"""Hourly ingest, duplicate suppression and roll-up as streaming jobs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazeline.functions.aqi import with_aqi
from hazeline.schemas import CITY, POLLUTANTS, TIME
from hazeline.sources import payload

LATENESS = "2 hours"


def raw_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New payload files as documents, malformed records among them."""
    return payload.json_reader(spark.readStream.option("maxFilesPerTrigger", files_per_batch), folder)


def payload_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New payload files as scored readings; same transformation as the batch."""
    return payload.to_readings(payload.accepted(raw_stream(spark, folder, files_per_batch)))


def ingest_payloads(spark: SparkSession, folder: str, path: str, rejects: str, checkpoint: str, files_per_batch: int = 1000) -> None:
    """Append the readings of new payload files to a table, and malformed records to another.

    Both are file streams into file tables, whose log names the files of each finished
    batch. So a restart from the checkpoint goes on after the last one, and what a failed
    batch left behind is not read: every record counts exactly once.
    """
    kept = append_stream(payload_stream(spark, folder, files_per_batch), path, f"{checkpoint}/readings")
    other = append_plain(payload.rejected(raw_stream(spark, folder, files_per_batch)), rejects, f"{checkpoint}/rejects")
    for running in (kept, other):
        running.awaitTermination()


def once_per_hour(readings: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The earliest row of each city and hour, whatever order rows arrive in.

    Works on batches and streams; a stream emits an hour once it is closed. Of rows
    of one time the least in the order of the other columns stays. Rows without a
    time belong to no hour. Rows combine before the shuffle, so a hot city costs
    one row per task and hour.
    """
    timed = readings.withWatermark(TIME, lateness) if readings.isStreaming else readings
    rest = [c for c in readings.columns if c not in (CITY, TIME)]
    first = F.min(F.struct(TIME, *rest)).alias("_row")
    return timed.groupBy(CITY, F.window(TIME, "1 hour")).agg(first).select(CITY, "_row.*").select(*readings.columns)


def hourly_means(readings: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Tumbling hourly mean of each pollutant, scored again.

    Works on batches and streams; a stream emits an hour once it is closed. Values
    combine before the shuffle, so a hot city costs one row per task and hour.
    """
    timed = readings.withWatermark(TIME, lateness) if readings.isStreaming else readings
    hour = F.window(TIME, "1 hour")
    means = [F.avg(c).alias(c) for c in POLLUTANTS if c in readings.columns]
    rolled = timed.groupBy(CITY, hour).agg(*means, F.count("*").alias("samples"))
    return with_aqi(rolled.withColumn(TIME, F.col("window.start")).drop("window"))


def append_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop; append to a table partitioned like batch."""
    return append_plain(df.withColumn("dt", F.to_date(TIME)), path, checkpoint, (CITY, "dt"))


def append_plain(df: DataFrame, path: str, checkpoint: str, by=()) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*by)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

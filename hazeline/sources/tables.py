"""Reading and appending the readings table."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazeline.operators.projection import select_present
from hazeline.schemas import CITY, READINGS, TIME

SERVED = (TIME, "aqi", "pm2_5", "pm10", "no2", "so2", "o3", "co")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The whole history. Left unsorted: windows sort, output may."""
    return spark.read.parquet(path)


def newest_history(spark: SparkSession, path: str, n: int = 500, city: str | None = None) -> DataFrame:
    """The newest ``n`` rows with a time, oldest first: city and the eight served columns.

    The table is split by city and day. Row counts by day, which come from file footers
    alone, tell how many of the newest days hold ``n`` rows; only those partitions are read,
    and of these only the ``n`` newest rows are sorted. Equal times are ordered by city.
    """
    table = spark.read.parquet(path)
    if city is not None:
        table = table.where(F.col(CITY) == city)
    days = table.where(F.col("dt").isNotNull()).groupBy("dt").count()
    newest_first = Window.orderBy(F.col("dt").desc())  # one row per day
    newer = F.coalesce(F.sum("count").over(newest_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    oldest = days.withColumn("newer", newer).where(F.col("newer") < n).agg(F.min("dt")).first()[0]
    recent = table.where(F.col("dt") >= F.lit(oldest))
    types = {field.name: field.dataType for field in READINGS}
    served = recent.select([F.col(c).cast(types[c]).alias(c) for c in (CITY, *SERVED)])
    return served.orderBy(F.col(TIME).desc(), CITY).limit(n).orderBy(TIME, CITY)


def append_readings(df: DataFrame, path: str) -> None:
    """Append, partitioned by city and day so that later scans prune."""
    df.withColumn("dt", F.to_date(TIME)).write.mode("append").partitionBy("city", "dt").parquet(path)


def read_csv(spark: SparkSession, path: str, columns) -> DataFrame:
    """CSV with a header and typed columns, no inference pass over the data."""
    types = {field.name: field.dataType.simpleString() for field in READINGS}
    types["dt"] = "bigint"
    schema = ", ".join(f"`{c}` {types[c]}" for c in columns)
    df = spark.read.option("header", True).schema(schema).csv(path)
    return select_present(with_time(df), ("city", *SERVED))


def with_time(df: DataFrame) -> DataFrame:
    """The timestamp column, else the epoch-seconds one."""
    options = []
    if TIME in df.columns:
        text = dict(df.dtypes)[TIME] == "string"
        options.append(F.try_to_timestamp(TIME) if text else F.col(TIME).cast("timestamp"))
    if "dt" in df.columns:
        options.append(F.timestamp_seconds("dt"))
    if not options:
        raise ValueError("readings need a timestamp or an epoch-seconds dt column")
    return df.withColumn(TIME, F.coalesce(*options))


def first_available(candidates) -> DataFrame:
    """The first source that can be read, labelled with where rows came from.

    ``candidates`` are ``(label, reader)`` pairs; a reader returns a DataFrame.
    """
    failure = None
    for label, reader in candidates:
        try:
            df = reader()
            df.schema  # resolves the path
        except AnalysisException as error:
            failure = error
            continue
        return df.withColumn("source", F.lit(label))
    raise failure or ValueError("no sources given")


def with_live_flag(df: DataFrame, mark: str = "Warehouse") -> DataFrame:
    return df.withColumn("is_live", F.col("source").contains(mark))

"""Data-quality checks as small aggregate reports."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.schemas import POLLUTANTS, TIME


def negative_counts(df: DataFrame, columns=POLLUTANTS, by=("city",)) -> DataFrame:
    """Negative readings per pollutant; a sound table has none."""
    return df.groupBy(*by).agg(*[F.count_if(F.col(c) < 0).alias(f"{c}_negative") for c in columns])


def index_range(df: DataFrame, by=("city",)) -> DataFrame:
    """Lowest and highest index and how many leave 0..500."""
    value = F.col("aqi")
    return df.groupBy(*by).agg(
        F.min(value).alias("min_aqi"),
        F.max(value).alias("max_aqi"),
        F.count_if(~value.between(0, 500)).alias("out_of_range"),
    )


def freshness(df: DataFrame, as_of: Column, stale_hours: float = 24.0, by=("city",), time: str = TIME) -> DataFrame:
    """Newest reading per city, its age in hours and whether it is fresh."""
    age = (F.unix_seconds(as_of) - F.unix_seconds(F.col("newest").cast("timestamp"))) / 3600.0
    return (
        df.groupBy(*by)
        .agg(F.max(time).alias("newest"))
        .withColumn("age_hours", age)
        .withColumn("fresh", F.col("age_hours") < stale_hours)
    )

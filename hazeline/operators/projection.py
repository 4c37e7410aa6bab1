"""Projections, filters and gates on readings and features."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions.calendar import add_days
from hazeline.schemas import CITY, CORE_COLUMNS, TIME


def stamp_ingest(df: DataFrame, city: str, as_of: Column | None = None) -> DataFrame:
    """Constant city and a batch-constant ingest time cut to the second."""
    moment = F.current_timestamp() if as_of is None else as_of
    return df.withColumns({CITY: F.lit(city), TIME: F.date_trunc("second", moment)})


def select_present(df: DataFrame, columns=CORE_COLUMNS) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select([name for name in columns if name in df.columns])


def drop_incomplete(df: DataFrame, columns=None) -> DataFrame:
    """Rows complete in the given columns, or in all of them."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def align_features(df: DataFrame, features, keep=()) -> DataFrame:
    """Exactly the model's inputs, in its order; absent ones become 0.0."""
    def column(name):
        return F.col(name).cast("double") if name in df.columns else F.lit(0.0)

    return df.select(*keep, *[column(name).alias(name) for name in features])


def zero_if_absent(df: DataFrame, name: str) -> Column:
    """A column, 0.0 for missing values or when the table lacks it."""
    return F.coalesce(F.col(name), F.lit(0.0)) if name in df.columns else F.lit(0.0)


def within_days(start: Column, days: int = 1, time: str = TIME) -> Column:
    """Half-open range predicate ``[start, start + days)``."""
    return (F.col(time) >= start) & (F.col(time) < add_days(start, F.lit(days)))


def history_report(df: DataFrame, needed: int = 80, key: str = CITY) -> DataFrame:
    """Rows per city, whether they suffice and how many are still to come."""
    rows = F.col("rows")
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("rows"))
        .withColumn("ready", rows >= needed)
        .withColumn("remaining", F.greatest(F.lit(needed) - rows, F.lit(0)))
    )


def with_enough_history(df: DataFrame, needed: int = 80, key: str = CITY) -> DataFrame:
    """Rows of the cities that hold at least ``needed`` rows.

    What is joined is the short cities. With none, the usual case, the adaptive
    plan drops the join; a long city never meets a match, so it can be split.
    """
    short = df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") < needed).select(key)
    return df.join(short, key, "left_anti")


def drop_report(df: DataFrame, columns, key: str = CITY) -> DataFrame:
    """Rows before, dropped and kept by :func:`drop_incomplete`, per city."""
    incomplete = F.lit(False)
    for name in columns:
        incomplete = incomplete | F.col(name).isNull()
    return df.groupBy(key).agg(
        F.count("*").alias("rows_before"),
        F.count_if(incomplete).alias("rows_dropped"),
        F.count_if(~incomplete).alias("rows_after"),
    )

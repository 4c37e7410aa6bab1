"""Named queries with the inventory items they cover and their DuckDB oracle."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    covers: str
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function under its own name."""

    def add(function):
        def run(spark, sf_dir):
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, sf_dir)

        if function.__name__ in QUERIES:
            raise ValueError(f"{function.__name__} is registered twice")
        QUERIES[function.__name__] = Query(run, covers, sql)
        return function

    return add


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to a fixed number of places, as the oracles give them."""
    return df.select(
        [F.round(n, places).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes]
    )


def r(expression: str, name: str | None = None) -> str:
    """SQL for a rounded double without a negative zero."""
    return f"round({expression}, 6) + 0.0 AS {name or expression}"

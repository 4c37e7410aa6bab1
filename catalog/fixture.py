"""Readings derived from the ``events`` table, in Spark and in SQL.

``samples`` keeps one row per event: the event type decides which pollutant its
value measures, and CO comes from the JSON property. ``readings`` rolls samples up
to one row per city and hour with ``max``, so no summation order matters.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline import series
from hazeline.functions.aqi import with_aqi
from hazeline.operators.cleaning import clean_series
from hazeline.operators.features import build_features
from hazeline.schemas import CITY, MEASURES, POLLUTANTS, TIME
from hazeline.series import Layout

CITIES = 4

# Small blocks make the test data cross block edges; real runs use the default.
HOURLY = Layout(block_rows=256)
SAMPLED = Layout(ties=("event_id",), block_rows=1024)

#: Which event type measures which pollutant.
SENSORS = {"pm2_5": "view", "pm10": "click", "no2": "purchase", "so2": "signup", "o3": "error"}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def samples(spark: SparkSession, sf_dir: str, cities: int = CITIES) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    carbon = F.get_json_object("props", "$.k").cast("double") * 150.0
    return events(spark, sf_dir).select(
        "event_id",
        F.concat(F.lit("city_"), (F.col("user_id") % cities).cast("string")).alias(CITY),
        F.col("ts").cast("timestamp").alias(TIME),
        *[F.when(kind == sensor, value).alias(name) for name, sensor in SENSORS.items()],
        carbon.alias("co"),
    )


def scored_samples(spark, sf_dir, cities: int = CITIES) -> DataFrame:
    return with_aqi(samples(spark, sf_dir, cities))


def readings(spark: SparkSession, sf_dir: str, cities: int = CITIES) -> DataFrame:
    rows = samples(spark, sf_dir, cities)
    hourly = rows.groupBy(CITY, F.date_trunc("hour", TIME).alias(TIME)).agg(
        *[F.max(name).alias(name) for name in POLLUTANTS]
    )
    return with_aqi(hourly).select(CITY, TIME, "aqi", *POLLUTANTS)


def cleaned(spark, sf_dir, cities: int = CITIES, layout: Layout = HOURLY) -> DataFrame:
    return clean_series(readings(spark, sf_dir, cities), layout)


def features(spark, sf_dir, spec, cities: int = CITIES, layout: Layout = HOURLY) -> DataFrame:
    return build_features(cleaned(spark, sf_dir, cities, layout), spec, layout)


def replay(spark, sf_dir) -> DataFrame:
    """The newest 72 hours of each city in the shape of a forecast."""
    newest = series.last_rows(readings(spark, sf_dir), 72)
    order = series.Window.partitionBy(CITY).orderBy(TIME)
    return newest.select(
        CITY, F.row_number().over(order).alias("horizon"), TIME, F.col("aqi").cast("double").alias("aqi")
    )


# --- the same in SQL --------------------------------------------------------


# Fixed values of the published index: per pollutant the divisors, the score outside all
# brackets, the reciprocal of the published precision, and the brackets as rows of
# concentration low and high, index low and high.
_PUBLISHED = {
    "pm2_5": ((), 500, 10, [
        (0.0, 12.0, 0, 50),
        (12.1, 35.4, 51, 100),
        (35.5, 55.4, 101, 150),
        (55.5, 150.4, 151, 200),
        (150.5, 250.4, 201, 300),
        (250.5, 350.4, 301, 400),
        (350.5, 500.4, 401, 500),
    ]),
    "pm10": ((), 500, 1, [
        (0, 54, 0, 50),
        (55, 154, 51, 100),
        (155, 254, 101, 150),
        (255, 354, 151, 200),
        (355, 424, 201, 300),
        (425, 504, 301, 400),
        (505, 604, 401, 500),
    ]),
    "no2": ((1.88,), 500, 1, [
        (0, 53, 0, 50),
        (54, 100, 51, 100),
        (101, 360, 101, 150),
        (361, 649, 151, 200),
        (650, 1249, 201, 300),
        (1250, 1649, 301, 400),
        (1650, 2049, 401, 500),
    ]),
    "o3": ((1.96,), 300, 1, [
        (0, 54, 0, 50),
        (55, 70, 51, 100),
        (71, 85, 101, 150),
        (86, 105, 151, 200),
        (106, 200, 201, 300),
    ]),
    "so2": ((2.62,), 500, 1, [
        (0, 35, 0, 50),
        (36, 75, 51, 100),
        (76, 185, 101, 150),
        (186, 304, 151, 200),
        (305, 604, 201, 300),
        (605, 804, 301, 400),
        (805, 1004, 401, 500),
    ]),
    "co": ((1000.0, 1.145), 500, 10, [
        (0, 4.4, 0, 50),
        (4.5, 9.4, 51, 100),
        (9.5, 12.4, 101, 150),
        (12.5, 15.4, 151, 200),
        (15.5, 30.4, 201, 300),
        (30.5, 40.4, 301, 400),
        (40.5, 50.4, 401, 500),
    ]),
}


def sub_index_sql(pollutant: str, value: str, contiguous: bool = False) -> str:
    divisors, outside, unit, brackets = _PUBLISHED[pollutant]
    amount = f"({value})"
    for divisor in divisors:
        amount = f"({amount} / '{divisor}'::DOUBLE)"
    if contiguous:
        amount = f"(floor(round({amount} * {unit}, 6)) / {unit}.0::DOUBLE)"
    arms = []
    for low, high, index_low, index_high in brackets:
        low, high = float(low), float(high)
        slope = (index_high - index_low) / (high - low)
        arms.append(
            f"WHEN {amount} BETWEEN '{low}'::DOUBLE AND '{high}'::DOUBLE THEN "
            f"CAST(round_even('{slope}'::DOUBLE * ({amount} - '{low}'::DOUBLE) + {index_low}, 0) AS INTEGER)"
        )
    return f"CASE WHEN {value} IS NULL THEN NULL {' '.join(arms)} ELSE {outside} END"


def composite_sql(contiguous: bool = False) -> str:
    scores = ", ".join(sub_index_sql(p, p, contiguous) for p in POLLUTANTS)
    return f"coalesce(greatest({scores}), 0)"


def _filled(column: str) -> str:
    before = "(PARTITION BY city ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    after = "(PARTITION BY city ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    known = f"CASE WHEN {column} IS NOT NULL THEN"
    return f"""
      last_value({column} IGNORE NULLS) OVER {before} AS v0_{column},
      max({known} n END) OVER {before} AS n0_{column},
      max({known} epoch_us(timestamp) END) OVER {before} AS t0_{column},
      first_value({column} IGNORE NULLS) OVER {after} AS v1_{column},
      min({known} epoch_us(timestamp) END) OVER {after} AS t1_{column}"""


def _between(column: str) -> str:
    share = f"(epoch_us(timestamp) - t0_{column})::DOUBLE / (t1_{column} - t0_{column})"
    return f"""CASE WHEN {column} IS NOT NULL THEN {column}
      WHEN v0_{column} IS NULL OR n - n0_{column} > 3 THEN NULL
      WHEN v1_{column} IS NULL THEN v0_{column}
      ELSE v0_{column} + (v1_{column} - v0_{column}) * {share} END AS {column}"""


def _capped(column: str) -> str:
    clipped = f"least(greatest({column}, q1_{column} - 3.0 * (q3_{column} - q1_{column})), " \
              f"q3_{column} + 3.0 * (q3_{column} - q1_{column}))"
    return f"greatest({clipped}, 0.0) AS {column}" if column != "aqi" else f"{clipped} AS {column}"


_SENSOR_SQL = ", ".join(f"CASE WHEN event_type = '{s}' THEN value END AS {p}" for p, s in SENSORS.items())

TABLES = {
    "samples": f"""SELECT event_id, concat('city_', cast(user_id % {CITIES} AS varchar)) AS city,
        ts AS timestamp, {_SENSOR_SQL},
        cast(json_extract_string(props, '$.k') AS DOUBLE) * 150.0::DOUBLE AS co FROM events""",
    "scored": f"SELECT *, {composite_sql()} AS aqi FROM samples",
    "hourly": "SELECT city, date_trunc('hour', timestamp) AS timestamp, "
              + ", ".join(f"max({p}) AS {p}" for p in POLLUTANTS) + " FROM samples GROUP BY 1, 2",
    "readings": f"SELECT *, {composite_sql()} AS aqi FROM hourly",
    "marked": "SELECT *, " + ", ".join(_filled(c) for c in MEASURES)
              + " FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY timestamp) AS n FROM readings)",
    "filled": "SELECT city, timestamp, " + ", ".join(_between(c) for c in MEASURES) + " FROM marked",
    "kept": "SELECT * FROM filled WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in MEASURES),
    "quartile_row": "SELECT city, "
                    + ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}"
                                for c in MEASURES) + " FROM kept GROUP BY city",
    "cleaned": "SELECT city, timestamp, " + ", ".join(_capped(c) for c in MEASURES)
               + " FROM kept JOIN quartile_row USING (city)",
    "replay": """SELECT city, row_number() OVER (PARTITION BY city ORDER BY timestamp) AS horizon, timestamp,
        aqi::DOUBLE AS aqi FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) AS back
        FROM readings) WHERE back <= 72""",
}


def with_tables(body: str, *names: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """``body`` behind the definitions it needs; ``names`` are expanded in order."""
    order = list(TABLES)
    needs = {
        "scored": ["samples"], "hourly": ["samples"], "readings": ["hourly"], "marked": ["readings"],
        "filled": ["marked"], "kept": ["filled"], "quartile_row": ["kept"], "cleaned": ["quartile_row"],
        "replay": ["readings"],
    }
    wanted, queue = set(), list(names)
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            queue += needs.get(name, [])
    parts = [f"{n} AS ({TABLES[n]})" for n in order if n in wanted]
    parts += [f"{n} AS ({text})" for n, text in (extra or {}).items()]
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {body}"
